"""Counts per text that quality rules look at."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from etlkit.llm.common import pick, slices

# Words of a window that counts as repeated when it occurs again in the text.
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

# Per byte: whether it begins a character that is not ASCII white space; whether it is a symbol.
_STARTS = np.array([b & 0xC0 != 0x80 and b not in b" \t\n\r\v\f" for b in range(256)])
_SYMBOL = np.array([b in SYMBOLS for b in range(256)])


class _Numbers(dict):
    def __missing__(self, key: bytes) -> int:
        self[key] = number = len(self)
        return number


def _paired(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Numbers that are equal where both parts are."""
    return np.unique(first * (int(second.max()) + 1) + second, return_inverse=True)[1]


def repeated_words(words: list[list[bytes]], window: int = WINDOW) -> np.ndarray:
    """Per text, the words that lie in a window of ``window`` words found twice or more in it.

    Windows are compared exactly: equal words get equal numbers, then runs of 2, 4, ... words do.
    ``window`` is a power of two.
    """
    lengths = np.array([len(w) for w in words], np.int64)
    total, number = int(lengths.sum()), _Numbers()
    if total < window:
        return np.zeros(len(words), np.int64)
    runs = np.fromiter((number[w] for own in words for w in own), np.int64, total)
    size = 1
    while size < window:
        runs = _paired(runs[:-size], runs[size:])
        size *= 2
    owner = np.repeat(np.arange(len(words)), lengths)
    inside = np.flatnonzero(owner[:len(runs)] == owner[window - 1:])
    _, kind, times = np.unique(
        owner[inside] * (int(runs.max()) + 1) + runs[inside], return_inverse=True, return_counts=True)
    begins = inside[times[kind] > 1]
    change = np.bincount(begins, minlength=total + 1) - np.bincount(begins + window, minlength=total + 1)
    return np.bincount(owner[np.cumsum(change[:total]) > 0], minlength=len(words))


def text_counts(texts: list[str | None]) -> dict[str, np.ndarray]:
    """The counts of ``COUNTS`` for each text; null counts as empty."""
    data = [(t or "").encode() for t in texts]
    words = [d.split() for d in data]
    borders = np.cumsum([0, *map(len, data)])
    flat = np.frombuffer(b"".join(data), np.uint8)

    def sums(table: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(table[flat])][borders])

    lines = [[x for x in d.split(b"\n") if x.strip()] for d in data]
    return {
        "n_words": np.array([len(w) for w in words], np.int64),
        "word_chars": sums(_STARTS), "n_symbols": sums(_SYMBOL),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
        "n_repeat_words": repeated_words(words),
    }


def with_counts(docs: DataFrame, text: str = "text", **carried: str) -> DataFrame:
    """The ``carried`` columns (new name = old name) with the counts of ``text``, no text among them."""
    rows = pick(docs, **carried, __text=text)
    out = rows.drop("__text").schema
    for name in COUNTS:
        out = out.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__text"):
            counts = text_counts(part["__text"].to_pylist())
            kept = [part[name] for name in carried]
            yield pa.record_batch([*kept, *(pa.array(counts[n], pa.int64()) for n in COUNTS)], [*carried, *COUNTS])

    return rows.mapInArrow(run, out)
