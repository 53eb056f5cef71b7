"""Hashes of words and word shingles of many texts at once."""

from __future__ import annotations

import numpy as np
import xxhash

from etlkit.llm.worker_tables import worker_table

SHINGLE_WORDS = 5
# Word hashes kept per Python worker; the table is emptied when full.
KEPT_WORDS = 500_000

# Byte tables: A-Z in lower case; the same with ASCII punctuation as white space.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
PLAIN = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in LOWER)
# Lower case, and all white space as spaces.
_SPACED = bytes(32 if b in b" \t\n\r\x0b\x0c" else b for b in LOWER)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SHORT = np.uint64(0xD6E8FEB86659FD93)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found




def words(text: str | None, table: bytes = LOWER) -> list[bytes]:
    """Runs of anything but ASCII white space, after replacing bytes by ``table``."""
    return text.encode().translate(table).split() if text else []


def spaced(text: str | None) -> bytes:
    """The words of a text in lower case with one space between them, the same for equal words only."""
    data = text.encode().translate(_SPACED).strip(b" ") if text else b""
    return b" ".join(data.split()) if b"  " in data else data


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(29))
    return values * np.uint64(0x94D049BB133111EB)


def word_hashes(texts: list[str | None], table: bytes = LOWER) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, text by text; borders: text i has [borders[i], borders[i + 1]))."""
    known = worker_table("words", _Words)
    if len(known) > KEPT_WORDS:
        known.clear()
    get, parts, lengths = known.__getitem__, [], [0]
    for text in texts:
        own = words(text, table)
        lengths.append(len(own))
        parts.append(np.fromiter(map(get, own), np.uint64, len(own)))
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return flat, np.cumsum(lengths)


# Parts of XXH3's secret as it mixes them into inputs of up to 3, 8 and 16 bytes, and its factors.
_FLIPS = [np.uint64(x) for x in (0x87275A9B, 0xC73AB174C5ECD5A2, 0x6782737BEA4239B9, 0xAF56BC3B0996523A)]
_PRIMES = [np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x9FB21C651E98DF25, 0x165667919E3779F9)]
_LOW = np.uint64(0xFFFFFFFF)


def _bits(n: int) -> np.uint64:
    return np.uint64(n)


def _rotated(values: np.ndarray, n: int) -> np.ndarray:
    return (values << _bits(n)) | (values >> _bits(64 - n))


def _folded(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The two halves of the products of 128 bits, by exclusive or."""
    a, b, c, d = x & _LOW, x >> _bits(32), y & _LOW, y >> _bits(32)
    low, cross, other = a * c, b * c, a * d
    middle = (low >> _bits(32)) + (cross & _LOW) + other
    high = (cross >> _bits(32)) + (middle >> _bits(32)) + b * d
    return high ^ ((middle << _bits(32)) | (low & _LOW))


def _short_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """XXH3 of the parts of ``data`` that have at most 16 bytes; eight more bytes must follow each."""
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    first, n = eight[starts].astype(np.uint64), sizes.astype(np.uint64)
    out = np.zeros(len(starts), np.uint64)

    some = np.flatnonzero(sizes <= 3)
    x, size = first[some], n[some]
    byte, eights = _bits(255), _bits(8)
    middle, last = x >> (eights * (size >> _bits(1))) & byte, x >> (eights * (size - _bits(1))) & byte
    x = ((x & byte) << _bits(16) | middle << _bits(24) | last | size << eights) ^ _FLIPS[0]
    x = (x ^ (x >> _bits(33))) * _PRIMES[0]
    x = (x ^ (x >> _bits(29))) * _PRIMES[1]
    out[some] = x ^ (x >> _bits(32))

    some = np.flatnonzero((sizes > 3) & (sizes <= 8))
    x, size = first[some], n[some]
    x = ((x >> (eights * (size - _bits(4))) & _LOW) + (x << _bits(32))) ^ _FLIPS[1]
    x = (x ^ _rotated(x, 49) ^ _rotated(x, 24)) * _PRIMES[2]
    x = (x ^ ((x >> _bits(35)) + size)) * _PRIMES[2]
    out[some] = x ^ (x >> _bits(28))

    some = np.flatnonzero((sizes > 8) & (sizes <= 16))
    x = first[some] ^ _FLIPS[2]
    y = eight[starts[some] + sizes[some] - 8].astype(np.uint64) ^ _FLIPS[3]
    x = n[some] + x.byteswap() + y + _folded(x, y)
    x = (x ^ (x >> _bits(37))) * _PRIMES[3]
    out[some] = x ^ (x >> _bits(32))
    return out


def all_word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """``word_hashes`` of many texts at once: words of up to 16 bytes are hashed where they lie."""
    parts = [text.encode().translate(_SPACED) if text else b"" for text in texts]
    data = np.frombuffer(b" ".join([b"", *parts, b"       "]), np.uint8)
    inside = np.concatenate((data != 32, [False]))
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    sizes = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1 - starts
    flat = _short_hashes(data, starts, sizes)
    for i in np.flatnonzero(sizes > 16).tolist():
        flat[i] = xxhash.xxh3_64_intdigest(data[starts[i]:starts[i] + sizes[i]])
    return flat, np.searchsorted(starts, np.cumsum([1, *(len(part) + 1 for part in parts)]))


def shingle_hashes(flat: np.ndarray, borders: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, in the layout of ``word_hashes``.

    A text with fewer words has one shingle, its whole sequence; without words none.
    """
    lengths = np.diff(borders)
    total = np.zeros(max(0, len(flat) - size + 1), np.uint64)
    for i in range(size):
        total = total * _FACTOR + flat[i:i + len(total)]
    counts = np.where(lengths >= size, lengths - size + 1, np.minimum(lengths, 1))
    ends = np.cumsum(counts)
    starts = np.repeat(borders[:-1], counts) + np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)
    out = np.zeros(len(starts), np.uint64)
    long = np.repeat(lengths >= size, counts)
    out[long] = total[starts[long]]
    for i in np.flatnonzero((lengths > 0) & (lengths < size)).tolist():
        value = int(lengths[i]) * int(_SHORT)
        for word in flat[borders[i]:borders[i + 1]].tolist():
            value = value * int(_FACTOR) + word
        out[ends[i] - 1] = value & 0xFFFFFFFFFFFFFFFF
    return mix(out), np.r_[0, ends]


def shingle_set(text: str | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct shingle hashes of one text, sorted."""
    return np.unique(shingle_hashes(*word_hashes([text]), size)[0])


def seeds(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of ``n`` hash functions ``value * factor + offset``."""
    numbers = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) + np.uint64(seed << 32))
    return numbers[:n] | np.uint64(1), numbers[n:]
