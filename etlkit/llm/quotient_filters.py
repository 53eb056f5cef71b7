"""Counting quotient filters over packed word ids, without loss.

Up to four ids of ``bits`` bits each are packed into two halves and permuted by a Feistel
network, which is invertible and spreads them evenly. The top bits of the permuted value name the
filter (its prefix), the next ones are the quotient, the rest is the remainder and is kept in
full. So a filter gives back exactly what was counted.

A filter's entries are sorted. Quotients are kept as run lengths in unary, about two bits an
entry; remainders as bytes; counters take a byte each and eight more from 256 on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from etlkit.llm.shingles import mix

_ROUNDS = 4


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _turned(half: np.ndarray, turn: int, width: int) -> np.ndarray:
    return mix(half + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) & _mask(width)


def permuted(ids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The halves, of ``2 * bits`` bits each, of the rows of ``ids`` (four columns, 0 where shorter)."""
    shift, width = np.uint64(bits), 2 * bits
    left, right = ids[:, 0] << shift | ids[:, 1], ids[:, 2] << shift | ids[:, 3]
    for turn in range(_ROUNDS):
        left, right = right, left ^ _turned(right, turn, width)
    return left, right


def restored(left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    """The ids that ``permuted`` was given."""
    shift, width = np.uint64(bits), 2 * bits
    for turn in reversed(range(_ROUNDS)):
        left, right = right ^ _turned(left, turn, width), left
    return np.stack([left >> shift, left & _mask(bits), right >> shift, right & _mask(bits)], axis=1)


@dataclass
class Entries:
    """Permuted values with their counts."""

    left: np.ndarray
    right: np.ndarray
    counts: np.ndarray

    def take(self, at) -> Entries:
        return Entries(self.left[at], self.right[at], self.counts[at])


def merged(parts: list[Entries], bits: int, used: int) -> Entries:
    """The entries of ``parts``, which share their first ``used`` bits, sorted, equal ones summed."""
    left, right = (np.concatenate([getattr(p, half) for p in parts]) for half in ("left", "right"))
    counts = np.concatenate([p.counts for p in parts])
    if 4 * bits - used <= 64:
        shift = np.uint64(2 * bits)
        # Sorted parts are runs to a stable sort, which merges them.
        order = np.argsort((left & _mask(2 * bits - used)) << shift | right, kind="stable")
    else:
        order = np.lexsort((right, left))
    left, right, counts = left[order], right[order], counts[order]
    if not len(left):
        return Entries(left, right, counts)
    first = np.r_[True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])]
    return Entries(left[first], right[first], np.add.reduceat(counts, np.flatnonzero(first)))


def split(entries: Entries, bits: int, used: int, taken: int) -> list[tuple[int, Entries]]:
    """(value of the next ``taken`` bits after ``used``, its entries), in their order."""
    fan = (entries.left >> np.uint64(2 * bits - used - taken) & _mask(taken)).astype(np.uint16)
    order = np.argsort(fan, kind="stable")
    borders = np.searchsorted(fan[order], np.arange((1 << taken) + 1))
    return [(i, entries.take(order[a:b])) for i, (a, b) in enumerate(zip(borders[:-1], borders[1:])) if b > a]


def _to_bytes(values: np.ndarray, width: int) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _from_bytes(data: bytes, width: int, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width).reshape(n, width)
    return out.view("<u8").reshape(-1).astype(np.uint64)


def _widths(n: int, bits: int, used: int) -> tuple[int, int]:
    """Bits of the quotient and of the left half's remainder."""
    width = 2 * bits - used
    quotient = min(width, max(0, n.bit_length() - 1))
    return quotient, width - quotient


def _put_remainders(left: np.ndarray, right: np.ndarray, rest: int, width: int) -> bytes:
    """Both halves' remainders, of ``rest`` and ``width`` bits, as one number each if 64 bits hold it."""
    if rest + width <= 64 and width < 64:
        return _to_bytes(left << np.uint64(width) | right, (rest + width + 7) // 8)
    return _to_bytes(left, (rest + 7) // 8) + _to_bytes(right, (width + 7) // 8)


def _get_remainders(data: bytes, n: int, rest: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    if rest + width <= 64 and width < 64:
        both = _from_bytes(data, (rest + width + 7) // 8, n)
        return both >> np.uint64(width), both & _mask(width)
    size = (rest + 7) // 8
    return _from_bytes(data, size, n), _from_bytes(data[n * size:], (width + 7) // 8, n)


def packed(entries: Entries, bits: int, used: int) -> dict:
    """One filter: sorted distinct entries that share their first ``used`` bits."""
    n = len(entries.left)
    quotient, rest = _widths(n, bits, used)
    low = entries.left & _mask(2 * bits - used)
    runs = np.zeros(n + (1 << quotient), bool)
    runs[(low >> np.uint64(rest)).astype(np.int64) + np.arange(n)] = True
    short = np.minimum(entries.counts - 1, 255).astype(np.uint8)
    return {
        "entries": n, "runs": np.packbits(runs).tobytes(),
        "remainders": _put_remainders(low & _mask(rest), entries.right, rest, 2 * bits),
        "counters": short.tobytes() + entries.counts[short == 255].astype("<u8").tobytes()}


def unpacked(row: dict, prefix: int, bits: int, used: int) -> Entries:
    """What ``packed`` was given; ``prefix`` is the value of the first ``used`` bits."""
    n = row["entries"]
    _, rest = _widths(n, bits, used)
    runs = np.unpackbits(np.frombuffer(row["runs"], np.uint8))
    quotients = (np.flatnonzero(runs) - np.arange(n)).astype(np.uint64)
    left, right = _get_remainders(row["remainders"], n, rest, 2 * bits)
    low = quotients << np.uint64(rest) | left
    counts = np.frombuffer(row["counters"], np.uint8, n).astype(np.int64) + 1
    counts[counts == 256] = np.frombuffer(row["counters"], "<u8", offset=n)
    return Entries(low | np.uint64(prefix << (2 * bits - used)), right, counts)
