"""Phrase collocations per language.

Texts are cut at punctuation and line ends into pieces, pieces into words, and all runs of two
to four words within pieces are counted. A run can only be frequent if its words are, so words
are counted first and frequent ones get ids. Tasks count runs of ids per block of texts in
counting quotient filters (``quotient_filters``), and filters are merged across blocks.

- Blocks of texts are written once, as numbers of their own distinct words. Only these words
  are shuffled to be counted, and the ids of the frequent ones come back to the blocks by a join.
- A block gives one filter per prefix. A merge takes those of 256 blocks or so under one
  prefix and, while there are more blocks, gives filters of longer prefixes. So a merge holds
  about as many entries as a block, however many blocks there are, and no key is hot.
- Cuts, parts and longer phrases are joined on the ids.

Cases: a null text is empty; a null language is ``und``; ties go by the earlier cut, and rank by
count and then by the phrase; repeated rows count as often as they occur; texts of any length
are read whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from etlkit.llm import quotient_filters as filters
from etlkit.llm.common import pick, slices
from etlkit.llm.shingles import LOWER
from etlkit.llm.worker_tables import forget_tables, give_back
from etlkit.operators.reuse import staged
from etlkit.operators.sizing import broadcast_if_small

LEAST_COUNT = 30
TOP = 2000
# Percent of a phrase's occurrences that lie in one longer phrase, which makes it a part only.
PART_PERCENT = 80
SCALE = 2_000_000
MOST_WORDS = 4
UNDETERMINED = "und"
# A block ends after so much text.
BLOCK_BYTES = 8 << 20
# A block's filters differ in so many bits, and two to their power of blocks are merged at once.
FAN_BITS = 8

_BREAK = b"."
_PIECES = bytes(46 if b in b".,;:!?\n\v\f\r" else LOWER[b] for b in range(256))
_BLOCK = "block long, words array<struct<lang: string, word: string, n: long>>, numbers binary"
_FILTER = "prefix long, block long, entries long, runs binary, remainders binary, counters binary"
_FILTER_SCHEMA = pa.schema([
    ("prefix", pa.int64()), ("block", pa.int64()), ("entries", pa.int64()), ("runs", pa.binary()),
    ("remainders", pa.binary()), ("counters", pa.binary())])


class _Words(dict):
    """The numbers of one language's words in a block, from 1; 0 is a break."""

    def __init__(self, lang: str, found: list[tuple[str, bytes]]):
        super().__init__({_BREAK: 0})
        self.lang, self.found = lang, found

    def __missing__(self, word: bytes) -> int:
        self.found.append((self.lang, word))
        self[word] = number = len(self.found)
        return number


class _Block:
    def __init__(self):
        self.found, self.languages, self.parts, self.bytes = [], {}, [], 0

    def add(self, lang: str, text: str) -> None:
        data = text.encode()
        tokens = data.translate(_PIECES).replace(b".", b" . ").split()
        if tokens:
            number = self.languages.setdefault(lang, None) or _Words(lang, self.found)
            self.languages[lang] = number
            tokens.append(_BREAK)
            self.parts.append(np.fromiter(map(number.__getitem__, tokens), np.uint32, len(tokens)))
        self.bytes += len(data)

    def row(self, block: int) -> pa.RecordBatch:
        numbers = np.concatenate(self.parts)
        times = np.bincount(numbers, minlength=len(self.found) + 1)[1:].tolist()
        words = [{"lang": lang, "word": w.decode(), "n": n} for (lang, w), n in zip(self.found, times)]
        kind = pa.list_(pa.struct([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]))
        return pa.record_batch({
            "block": pa.array([block], pa.int64()), "words": pa.array([words], kind),
            "numbers": pa.array([_planes(numbers)], pa.binary())})


def _planes(numbers: np.ndarray) -> bytes:
    """All lowest bytes, then the next ones: numbers are small, so files and shuffles shrink the rest."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def blocks(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Texts as blocks: their distinct words per language with counts, and the sequence of the
    words' numbers, from 1; 0 ends a piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block = _Block(), TaskContext.get().partitionId() << 33
        for part in slices(batches, "text"):
            for lang, text in zip(part["lang"].to_pylist(), part["text"].to_pylist()):
                now.add(UNDETERMINED if lang is None else lang, text or "")
                if now.bytes > BLOCK_BYTES:
                    if now.parts:
                        yield now.row(block)
                    now, block = _Block(), block + 1
        if now.parts:
            yield now.row(block)
        del now
        forget_tables()

    return pick(docs, text=text, lang=lang).mapInArrow(run, _BLOCK)


def numbered(words: DataFrame) -> DataFrame:
    """``words`` with dense ids from 1: places within the tasks that write them, plus the rows of
    the tasks before."""
    placed = staged(words.withColumn("at", F.monotonically_increasing_id()), "frequent")
    task = F.shiftright("at", 33)
    sizes = placed.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("size"))  # a row per task
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    sizes = staged(sizes.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0))), "sizes")
    return placed.join(broadcast_if_small(sizes), task == F.col("task")).select(
        *words.columns, (F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1).alias("id"))


def block_entries(ids: np.ndarray, bits: int) -> filters.Entries:
    """Runs of two to four ids in a block with their counts; 0 ends a piece.

    Pairs are numbered first; a longer run is two pairs, so each kind is one sort of whole numbers.
    """
    low, high = np.uint64(0xFFFFFFFF), np.uint64(32)
    parts = []

    def add(counts: np.ndarray, *columns: np.ndarray) -> None:
        """One kind of run at a time: all of them as rows would take several times the block."""
        rows = np.zeros((len(counts), MOST_WORDS), np.uint64)
        for i, column in enumerate(columns):
            rows[:, i] = column
        parts.append((*filters.permuted(rows, bits), counts.astype(np.int64)))

    at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
    kinds, kind, times = np.unique(ids[at] << high | ids[at + 1], return_inverse=True, return_counts=True)
    pair = np.full(len(ids) + 2, -1, np.int64)
    pair[at] = kind
    del kind
    add(times, kinds >> high, kinds & low)
    for length in (3, 4):
        at = at[pair[at + length - 2] >= 0]
        found, times = np.unique(pair[at].astype(np.uint64) << high | pair[at + length - 2].astype(np.uint64), return_counts=True)
        a, b = kinds[(found >> high).astype(np.int64)], kinds[(found & low).astype(np.int64)]
        add(times, a >> high, a & low, *((b & low,) if length == 3 else (b >> high, b & low)))
    return filters.Entries(*map(np.concatenate, zip(*parts)))


def _filters(entries: filters.Entries, block: int, prefix: int, bits: int, used: int, taken: int) -> list[dict]:
    """A filter for each value of the ``taken`` bits after the first ``used``, which are ``prefix``."""
    rows, now = [], used + taken
    for value, own in filters.split(entries, bits, used, taken):
        row = filters.packed(filters.merged([own], bits, now), bits, now)
        rows.append({"prefix": prefix << taken | value, "block": block, **row})
    return rows


def _counted(bits: int, taken: int):
    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        if not block.num_rows:
            return _FILTER_SCHEMA.empty_table()
        row = block.to_pylist()[0]
        numbers = _numbers(row["numbers"])
        ids = np.zeros(int(numbers.max(initial=0)) + 1, np.uint64)
        ids[found["number"].to_numpy()] = found["id"].to_numpy().astype(np.uint64)
        entries = block_entries(ids[numbers], bits)
        del numbers, ids
        made = pa.Table.from_pylist(_filters(entries, row["block"], 0, bits, 0, taken), _FILTER_SCHEMA)
        del entries
        give_back()
        return made

    return run


def _read(group: pa.Table, bits: int, used: int) -> filters.Entries:
    return filters.merged([filters.unpacked(r, r["prefix"], bits, used) for r in group.to_pylist()], bits, used)


def _merge(bits: int, used: int, taken: int):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        prefix, deal = (k.as_py() for k in key)
        rows = _filters(_read(group, bits, used), deal, prefix, bits, used, taken)
        return pa.Table.from_pylist(rows, _FILTER_SCHEMA)

    return run


def _finish(bits: int, used: int, least: int):
    def run(group: pa.Table) -> pa.Table:
        entries = _read(group, bits, used)
        entries = entries.take(entries.counts >= least)
        ids = filters.restored(entries.left, entries.right, bits).astype(np.int64)
        rows = [[i for i in own if i] for own in ids.tolist()]
        return pa.table({"ids": pa.array(rows, pa.list_(pa.int64())), "a": pa.array(entries.counts, pa.int64())})

    return run


def frequent_runs(texts: DataFrame, ids: DataFrame, n_ids: int, least: int = LEAST_COUNT,
                  fan_bits: int = FAN_BITS) -> DataFrame:
    """``ids, a``: runs of two to four of the numbered words that occur ``least`` times or more.

    ``texts`` are blocks; ``ids`` has ``of`` (a block), ``number, id``. A merge shuffles each filter once, and
    the number of merges grows with the logarithm, to the base 2 ** ``fan_bits``, of the number of blocks.
    """
    bits = max(16, n_ids.bit_length())
    rows = texts.select("block", "numbers").groupBy("block").cogroup(ids.groupBy("of")).applyInArrow(
        _counted(bits, fan_bits), _FILTER)
    many, used = texts.count(), fan_bits
    while many > 1 << fan_bits:
        many = math.ceil(many / (1 << fan_bits))
        deal = F.pmod(F.xxhash64("block", F.lit(used)), F.lit(many)).alias("deal")
        rows = rows.groupBy("prefix", deal).applyInArrow(_merge(bits, used, fan_bits), _FILTER)
        used += fan_bits
    return rows.groupBy("prefix").applyInArrow(_finish(bits, used, least), "ids array<long>, a long")


def _scored(runs: DataFrame) -> DataFrame:
    """``ids, a, l, r, score`` of runs of two words and more, by their lowest-scoring cut.

    ``runs`` has ``ids, a`` and holds single words as well.
    """
    longer = runs.filter(F.size("ids") > 1)
    cuts = longer.select("ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k")).select(
        "ids", "a", "k", F.expr("slice(ids, 1, k)").alias("first"), F.expr("slice(ids, k + 1, size(ids))").alias("rest"))
    cuts = cuts.join(runs.select(F.col("ids").alias("first"), F.col("a").alias("l")), "first")
    cuts = cuts.join(runs.select(F.col("ids").alias("rest"), F.col("a").alias("r")), "rest")
    wide = "CAST({} AS DECIMAL(38, 0))"
    score = F.expr(f"{wide.format('a')} * {SCALE} DIV ({wide.format('l')} + {wide.format('r')})").cast("long")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("ids", "a").agg(lowest).select("ids", "a", "cut.l", "cut.r", "cut.score")


def _whole(scored: DataFrame) -> DataFrame:
    """The rows that are not mostly part of one longer run."""
    parts = ("flatten(transform(sequence(2, size(ids) - 1), k -> "
             "transform(sequence(1, size(ids) - k + 1), i -> slice(ids, i, k))))")
    inner = scored.filter(F.size("ids") > 2).select(F.explode(F.expr(parts)).alias("ids"), F.col("a").alias("outer"))
    outer = inner.groupBy("ids").agg(F.max("outer").alias("outer"))
    joined = scored.join(outer, "ids", "left")
    part = F.col("outer").cast("decimal(38,0)") * 100 >= F.col("a").cast("decimal(38,0)") * PART_PERCENT
    return joined.filter(~F.coalesce(part, F.lit(False))).drop("outer")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT,
                 top: int = TOP, fan_bits: int = FAN_BITS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases. Runs jobs."""
    texts = staged(blocks(docs, text, lang), "blocks")
    words = texts.select("block", F.posexplode("words").alias("at", "w")).select(
        "block", (F.col("at") + 1).alias("number"), "w.lang", "w.word", "w.n")
    totals = staged(words.groupBy("lang", "word").agg(F.sum("n").alias("a")), "totals")
    known = staged(numbered(totals.filter(F.col("a") >= least)), "known")
    ids = words.join(known.select("lang", "word", "id"), ["lang", "word"]).select(
        F.col("block").alias("of"), "number", "id")
    runs = frequent_runs(texts, ids, known.count(), least, fan_bits)
    runs = staged(runs.union(known.select(F.array("id"), "a")), "runs")

    found = staged(_whole(staged(_scored(runs), "scored")), "phrases")
    spelled = found.select("ids", F.posexplode("ids").alias("at", "id")).join(known.select("id", "lang", "word"), "id")
    spelled = spelled.groupBy("ids").agg(
        F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"])).alias("phrase"),
        F.first("lang").alias("lang"))
    sizes = totals.groupBy("lang").agg(F.sum("a").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.join(spelled, "ids").withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.filter(F.col("rank") <= top).join(sizes, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
