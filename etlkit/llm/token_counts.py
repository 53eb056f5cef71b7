"""Token counts by merging whole batches of pre-tokens rank by rank.

New pre-tokens of a batch lie one after the other in flat arrays. Each round finds, for all
of them at once, the adjacent pair of lowest rank (leftmost of equals), replaces it by the
merged symbol and drops pre-tokens without a pair left. What survives is counted: one token
per piece, one per byte for characters outside the vocabulary.

Cases: a null or empty text has no tokens; strings that look like special tokens are plain
text, as the library has it; texts of any length are counted whole.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from etlkit.llm.common import pick, text_slices
from etlkit.llm.pieces import SPACE, read_pieces
from etlkit.llm.worker_tables import worker_table

TOKEN_LIMIT = 4096
# Pre-tokens kept per Python worker with their counts; the table is emptied when full.
KEPT = 600_000
# Symbols merged together.
BATCH_SYMBOLS = 1 << 18
# A round merges once in each pre-token, so a longer one is merged by a heap instead.
LONGEST = 256

_NONE = np.iinfo(np.int64).max
_RUNS = re.compile(" *[^ ]+| +")


class PieceCounter:
    def __init__(self, path: str):
        pieces = read_pieces(path)
        known = {piece: i for i, (piece, _) in enumerate(pieces)}
        if any(SPACE in piece.lstrip(SPACE) for piece in known):
            raise ValueError("a piece goes on over a space")
        self.symbols = dict(known)
        for char in sorted({c for piece in known for c in piece}):
            self.symbols.setdefault(char, len(self.symbols))
        # Tokens that a symbol makes; further symbols stand for characters of 1 to 4 bytes.
        costs = [1] * len(pieces) + [len(s.encode()) for s in list(self.symbols)[len(pieces):]]
        self.other = len(costs) - 1
        self.costs = np.array([*costs, 1, 2, 3, 4], np.int64)
        self.base = len(self.costs)
        order = {score: rank for rank, score in enumerate(sorted({s for _, s in pieces}, reverse=True))}
        pairs = sorted(
            (self.symbols[piece[:cut]] * self.base + self.symbols[piece[cut:]], order[score], known[piece])
            for piece, score in pieces for cut in range(1, len(piece))
            if piece[:cut] in self.symbols and piece[cut:] in self.symbols)
        self.keys, self.ranks, self.merged = (np.array(c, np.int64) for c in zip(*pairs))
        self.kept: dict[str, int] = {}

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair in ``keys``, or -1."""
        wanted = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, at, -1)

    def _symbols(self, text: str) -> list[int]:
        get, other = self.symbols.get, self.other
        return [s if (s := get(c)) is not None else other + len(c.encode()) for c in text]

    def _merge(self, sequences: list[list[int]]) -> np.ndarray:
        """Tokens of each sequence of symbols."""
        counts = np.zeros(len(sequences), np.int64)
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        symbols = np.fromiter(chain.from_iterable(sequences), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(sequences)), lengths)
        pair = np.full(len(symbols), -1)  # of each symbol with the next one of its sequence
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        pair[inner] = self._pairs(symbols[inner], symbols[inner + 1])
        while len(symbols):
            place = np.arange(len(symbols))
            key = np.where(pair >= 0, (self.ranks[pair] << 32) | place, _NONE)
            begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(key, begins)
            done = lowest == _NONE
            at = lowest[~done] & 0xFFFFFFFF
            symbols[at] = self.merged[pair[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            if done.any():
                finished = np.repeat(done, np.diff(np.r_[begins, len(symbols)]))
                counts += np.bincount(owner[finished], self.costs[symbols[finished]], len(counts)).astype(np.int64)
                keep &= ~finished
            moved = np.cumsum(keep) - 1
            symbols, owner, pair = symbols[keep], owner[keep], pair[keep]
            at = moved[at]
            for left in (at, at[at > 0] - 1):
                left = left[left + 1 < len(symbols)]
                same = owner[left] == owner[left + 1] if len(left) else np.zeros(0, bool)
                pair[left] = np.where(same, self._pairs(symbols[left], symbols[left + 1]), -1)
            if len(symbols):
                pair[-1] = -1
        return counts

    def _merge_long(self, symbols: list[int]) -> int:
        """The same for one long sequence: pairs in a heap by rank, then place."""
        after = [*range(1, len(symbols)), -1]
        before = [*range(-1, len(symbols) - 1)]
        values, heap = np.array(symbols), []
        pairs = self._pairs(values[:-1], values[1:])
        for i in np.flatnonzero(pairs >= 0).tolist():
            heap.append((int(self.ranks[pairs[i]]), i, symbols[i], symbols[i + 1], int(self.merged[pairs[i]])))
        heapq.heapify(heap)
        keys = {}
        while heap:
            _, i, left, right, merged = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j < 0 or symbols[j] != right:
                continue
            symbols[i], symbols[j] = merged, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0:
                    two = symbols[a], symbols[b]
                    if two not in keys:
                        keys[two] = int(self._pairs(np.array([two[0]]), np.array([two[1]]))[0])
                    if (k := keys[two]) >= 0:
                        heapq.heappush(heap, (int(self.ranks[k]), a, *two, int(self.merged[k])))
        return int(self.costs[[s for s in symbols if s >= 0]].sum())

    def _learn(self, words: list[str]) -> dict[str, int]:
        found, batch, held = {}, [], 0
        for word in words:
            symbols = self._symbols(SPACE + word.replace(" ", SPACE))
            if len(symbols) > LONGEST:
                found[word] = self._merge_long(symbols)
                continue
            batch.append((word, symbols))
            held += len(symbols)
            if held > BATCH_SYMBOLS:
                found.update(zip([w for w, _ in batch], self._merge([s for _, s in batch]).tolist()))
                batch, held = [], 0
        if batch:
            found.update(zip([w for w, _ in batch], self._merge([s for _, s in batch]).tolist()))
        return found

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text. Nothing merges over the start of a run of spaces, so a text
        is cut there; a pre-token is kept without its first space."""
        cut = []
        for text in texts:
            text = text.replace(SPACE, " ")
            if not text:
                cut.append([])
            elif "  " in text or text[0] == " " or text[-1] == " ":
                cut.append([run[1:] for run in _RUNS.findall(" " + text)])
            else:
                cut.append(text.split(" "))
        flat = list(chain.from_iterable(cut))
        counts = list(map(self.kept.get, flat))
        new = {w for w, n in zip(flat, counts) if n is None}
        if new:
            found = self._learn(sorted(new))
            counts = [found[w] if n is None else n for w, n in zip(flat, counts)]
            if len(self.kept) + len(found) > KEPT:
                self.kept.clear()
            self.kept.update((w, n) for w, n in found.items() if len(w) <= LONGEST)
        totals = np.concatenate([[0], np.cumsum(np.array(counts, np.int64))])
        ends = np.cumsum([len(words) for words in cut])
        return np.diff(totals[np.r_[0, ends]]).tolist()


def counter(path: str) -> PieceCounter:
    """One counter per Python worker."""
    return worker_table(f"pieces:{path}", lambda: PieceCounter(path))


def token_count(text: Column, path: str) -> Column:
    """Tokens of a text column as the library counts them; null counts as empty."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(list(chain.from_iterable(map(counter(path).count, text_slices(texts)))), dtype="int64")

    return count.asNondeterministic()(text)


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                 limit: int = TOKEN_LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row, repeated rows included."""
    rows = pick(docs, doc_id=doc_id, text=text)
    return rows.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(F.col("text"), path).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
