"""Benchmark passages in documents by greedy string tiling.

Words are compared in lower case and without ASCII punctuation. Document and test item are
joined on shared runs of ``SEED`` words. For each pair that could reach the wanted coverage,
the longest common runs of words not yet marked are marked in both, again and again, until
no run of ``SEED`` words is left; running Karp-Rabin hashes find them. The marked runs
(tiles) need not be in the same order in both, so reordered passages are found, and the
share of the item's words in tiles decides.

The items are the stated query set: they are taken in blocks of bounded size, one block after the
other, and a block is sent to all tasks, so a document is neither shuffled nor compared with
other documents, and neither the driver nor a task holds more than a block.

Cases: a null or empty text or item matches nothing; an item of fewer than ``SEED`` words is its
own seed and found where all of it stands; repeated items and items without an id are reported
each; of equally long matches the one that begins first in the item, then in the text, is marked
first; texts of any length are searched whole; empty tables of documents or items give no match;
other columns are carried along.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from etlkit.llm.common import pick, slices, text_slices, word_count, written
from etlkit.llm.shingles import PLAIN, mix, word_hashes
from etlkit.operators.reuse import staged

SEED = 5
# Least share of an item's words that tiles cover.
COVERAGE = 0.5
# Words of test items in one block, on average; about 40 bytes each in every task.
BLOCK_WORDS = 1_000_000

_FACTOR = 0x9E3779B97F4A7C15
_FOUND = ("array<struct<item_id: long, item_words: long, covered: long, "
          "tiles: array<struct<doc_start: long, item_start: long, length: long>>>>")


def running_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``size`` values.

    All at once from prefix sums: with S[i] the sum of values[j] * f**j over j < i, a run's
    hash is (S[i + size] - S[i]) * f**-i, the factor being odd and so invertible mod 2**64.
    """
    if len(values) < size:
        return np.zeros(0, np.uint64)
    powers = _powers(_FACTOR, len(values))
    inverse = _powers(pow(_FACTOR, -1, 1 << 64), len(values) - size + 1)
    sums = np.r_[np.uint64(0), np.cumsum(values * powers, dtype=np.uint64)]
    return mix((sums[size:] - sums[:-size]) * inverse)


def _powers(factor: int, n: int) -> np.ndarray:
    table = np.full(n, factor, np.uint64)
    table[:1] = 1
    return np.multiply.accumulate(table)


def _longest_runs(doc: np.ndarray, item: np.ndarray, size: int):
    """(length, item start, doc start) of common runs of ``size`` or more, extended both ways.

    A run of the document is paired with the first run of the item that equals it. Marked
    words differ from all others, so no run holds one.
    """
    own, theirs = running_hashes(item, size), running_hashes(doc, size)
    keys, first = np.unique(own, return_index=True)
    if not len(keys) or not len(theirs):
        return []
    at = np.minimum(np.searchsorted(keys, theirs), len(keys) - 1)
    hits = np.flatnonzero(keys[at] == theirs)
    places = first[at[hits]]
    turns = np.flatnonzero(np.r_[True, (np.diff(hits) != 1) | (np.diff(places) != 1)]) if len(hits) else []
    found = []
    for t in turns:
        d, i = int(hits[t]), int(places[t])
        while d and i and doc[d - 1] == item[i - 1]:
            d, i = d - 1, i - 1
        length = 0
        span = min(len(doc) - d, len(item) - i)
        differ = np.flatnonzero(doc[d:d + span] != item[i:i + span])
        length = int(differ[0]) if len(differ) else span
        if length >= size:
            found.append((length, i, d))
    return found


def tiles(doc: np.ndarray, item: np.ndarray, least: int = SEED) -> list[tuple[int, int, int]]:
    """(doc start, item start, length) of the greedy tiling of two sequences of word hashes."""
    doc, item = doc.copy(), item.copy()
    # Marked words get values of their own, different in both, and words never have them.
    marks, out = np.uint64(0), []
    size = max(least, min(len(item), len(doc)))
    while size >= least:
        runs = sorted(set(_longest_runs(doc, item, size)), key=lambda r: (-r[0], r[1], r[2]))
        marked = 0
        for length, i, d in runs:
            own, theirs = item[i:i + length], doc[d:d + length]
            if not np.array_equal(own, theirs):
                continue  # part of it was marked meanwhile; what is left is found again
            out.append((d, i, length))
            item[i:i + length] = marks + np.arange(length, dtype=np.uint64)
            doc[d:d + length] = marks + np.uint64(1 << 40) + np.arange(length, dtype=np.uint64)
            marks += np.uint64(length)
            marked += 1
        if not marked:
            size = size // 2 if size // 2 > least else (least if size > least else 0)
    return sorted(out)


@dataclass
class Block:
    """Some test items: their words, one after the other, and their seeds with places."""

    ids: list
    words: np.ndarray
    borders: np.ndarray
    seeds: np.ndarray
    starts: np.ndarray
    places: np.ndarray
    # Length -> (hashes of the items that are so short, ascending; their numbers).
    short: dict[int, tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, rows: list) -> Block:
        words, borders = word_hashes([t for _, t in rows], PLAIN)
        owner = np.repeat(np.arange(len(rows)), np.diff(borders))
        seeds = running_hashes(words, SEED)
        inside = owner[:len(seeds)] == owner[SEED - 1:] if len(seeds) else np.zeros(0, bool)
        places = np.flatnonzero(inside)
        order = places[np.argsort(seeds[places], kind="stable")]
        keys, starts = np.unique(seeds[order], return_index=True)
        lengths, short = np.diff(borders), {}
        for length in range(1, SEED):
            items = np.flatnonzero(lengths == length)
            if len(items):
                hashes = running_hashes(words, length)[borders[items]]
                by_hash = np.argsort(hashes, kind="stable")
                short[length] = hashes[by_hash], items[by_hash]
        return cls([i for i, _ in rows], words, borders, keys, np.r_[starts, len(order)], order, short)

    def _candidates(self, seeds: np.ndarray, coverage: float) -> list[int]:
        """Items whose words could be covered far enough by the given seeds (their numbers)."""
        runs = [self.places[self.starts[s]:self.starts[s + 1]] for s in seeds]
        covered = np.unique((np.concatenate(runs)[:, None] + np.arange(SEED)).ravel())
        items, counts = np.unique(np.searchsorted(self.borders, covered, "right") - 1, return_counts=True)
        return items[counts >= coverage * np.diff(self.borders)[items]].tolist()

    def _whole(self, words: np.ndarray, borders: np.ndarray, length: int, hashes: np.ndarray, items: np.ndarray,
               found: list[list[dict]]) -> None:
        """Add the items of ``length`` words at the first place of each text that holds them."""
        own = running_hashes(words, length)
        hits = np.flatnonzero(np.isin(own, hashes))
        owner = np.searchsorted(borders, hits, "right") - 1
        within = hits + length <= borders[owner + 1]
        hits, owner = hits[within], owner[within]
        _, first = np.unique(np.stack([owner.astype(np.uint64), own[hits]], axis=1), axis=0, return_index=True)
        for hit, text in zip(hits[first].tolist(), owner[first].tolist()):
            a, b = np.searchsorted(hashes, own[hit], "left"), np.searchsorted(hashes, own[hit], "right")
            tile = {"doc_start": hit - int(borders[text]), "item_start": 0, "length": length}
            found[text] += [{"item_id": self.ids[i], "item_words": length, "covered": length, "tiles": [tile]}
                            for i in items[a:b].tolist()]

    def search(self, texts: list[str], coverage: float) -> list[list[dict]]:
        """For each text, the items that its tiles cover far enough."""
        found: list[list[dict]] = [[] for _ in texts]
        words, borders = word_hashes(texts, PLAIN)
        for length, (hashes, items) in self.short.items():
            self._whole(words, borders, length, hashes, items, found)
        own = running_hashes(words, SEED)
        if not len(own) or not len(self.seeds):
            return found
        at = np.minimum(np.searchsorted(self.seeds, own), len(self.seeds) - 1)
        hits = np.flatnonzero(self.seeds[at] == own)
        owner = np.searchsorted(borders, hits, "right") - 1
        within = hits + SEED <= borders[owner + 1]
        hits, owner = hits[within], owner[within]
        for text in np.unique(owner).tolist():
            doc = words[borders[text]:borders[text + 1]]
            for i in self._candidates(np.unique(at[hits[owner == text]]), coverage):
                item = self.words[self.borders[i]:self.borders[i + 1]]
                cut = tiles(doc, item)
                covered = sum(length for _, _, length in cut)
                if covered >= coverage * len(item):
                    found[text].append({
                        "item_id": self.ids[i], "item_words": len(item), "covered": covered,
                        "tiles": [dict(zip(("doc_start", "item_start", "length"), t)) for t in cut]})
        return found


def _search(text: Column, block: Block, coverage: float) -> Column:
    @F.pandas_udf(_FOUND)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([f for part in text_slices(texts) for f in block.search(part, coverage)], dtype=object)

    return search.asNondeterministic()(text)


def blocks(items: DataFrame, item_id: str = "item_id", text: str = "text",
           block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The test items in blocks of about ``block_words`` words, dealt by the text's hash."""
    rows = pick(items, item_id=item_id, text=text).withColumn("item_id", F.col("item_id").cast("long"))
    total = rows.agg(F.sum(word_count("text")).alias("n")).first()["n"] or 0
    n = max(1, math.ceil(total / block_words))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    for block in range(n):
        yield Block.of([tuple(r) for r in dealt.filter(F.col("block") == block).select("item_id", "text")
                        .orderBy("item_id", "text").collect()])


def _one_by_one(parts: Iterator[DataFrame]) -> DataFrame:
    """The union of ``parts``, each written before the next one is made; a single one is left lazy."""
    done, last = [], next(parts)
    for part in parts:
        done.append(staged(last, "matches"))
        last = part
    return reduce(DataFrame.unionAll, [*done, last])


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document and covered item, with the coverage and the tiles. Runs a job per block
    but the last."""
    rows = pick(docs, doc_id=doc_id, text=text)

    def covered(block: Block) -> DataFrame:
        found = rows.select("doc_id", _search(F.col("text"), block, coverage).alias("found"))
        return found.filter(F.size("found") > 0).select("doc_id", F.explode("found").alias("f")).select(
            "doc_id", "f.item_id", "f.item_words", "f.covered",
            (F.col("f.covered") / F.col("f.item_words")).alias("coverage"), "f.tiles")

    return _one_by_one(covered(block) for block in blocks(items, block_words=block_words))


def clean(docs: DataFrame, items: DataFrame, text: str = "text", coverage: float = COVERAGE,
          block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents in which no item is covered far enough. Runs a job per block but the last.

    Rows pass through Python in slices of a few megabytes, so none wait for others in the JVM.
    """
    def without(block: Block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, text):
                found = block.search([t or "" for t in part[text].to_pylist()], coverage)
                yield part.filter(pa.array([not f for f in found], pa.bool_()))

        return run

    schema, left = docs.schema, docs
    for number, block in enumerate(blocks(items, block_words=block_words)):
        left = (written(left, "clean") if number else left).mapInArrow(without(block), schema)
    return left
