"""Near-duplicate documents by a multi-index Hamming join of b-bit MinHash signatures.

A document's set holds its distinct five-word shingles. Its signature keeps ``BITS`` bits of
each of ``HASHES`` minima. Two documents that are just as alike as is asked differ in more positions
than the signature distance (``distance_for``: 31 at 85%) with a chance of about one in a hundred
thousand. Signatures are cut into ``CHUNKS`` chunks; two within the distance have a chunk with at
most ``distance // CHUNKS`` (one at 85%) differing positions, so they agree on one of the keys made
of a chunk with so many positions left out. All pairs within the distance share a key; those that
matter for the groups are confirmed on the full sets.

Groups, not pairs, are wanted, so no group is expanded into all its pairs. Equal sets form a
class and only its first row goes on. In each star round every row is compared, over all keys
it shares, with one row per key, and confirmed against the one nearest by signature. When a
round adds no link, rows whose keys are still shared with other components are compared in
full, where they also share one of the rarest shingles that two sets alike must share: after
that no link between two components is left out. There a set also brings the parity of its
shingles in each of ``PARITIES`` places. Two sets differ in at least as many shingles as their
parities differ, so pairs that are near but cannot be linked do not leave the join.

Cases: a null or empty text, or one without words, has an empty set and is linked with nothing;
fewer than five words make one shingle; rows of the same id are separate rows of a group; a
null id is the last choice for naming a group; other columns are carried along, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from etlkit.llm.common import slices, written
from etlkit.llm.components import connected_components
from etlkit.llm.shingles import all_word_hashes, seeds, shingle_hashes, shingle_set, word_hashes
from etlkit.llm.worker_tables import forget_tables
from etlkit.operators.reuse import staged
from etlkit.operators.sizing import broadcast_if_small

HASHES, BITS = 96, 8
CHUNKS, CHUNK = 16, 6
# Chance that a pair just as alike as is asked lies beyond the signature distance.
MISSED = 1.2e-5
# Linked: 100 * intersection >= PERCENT * union.
PERCENT = 85
# Star rounds before what is left is compared in full.
ROUNDS = 3
# Up to so many first shingles of a set, each carries those before it, so that two sets meet
# once, at the first one they share; longer sets meet at each, which only costs more.
CARRIED = 64
# Counters of shingles, as a power of two.
COUNTER_BITS = 21
# Counters that are sent together.
COUNTERS = 4096
# Places in which the shingles of a set are counted as even or odd.
PARITIES = 512

_FACTORS, _OFFSETS = seeds(HASHES, 6)
_LONGS = [f"s{i}" for i in range(HASHES * BITS // 64)]
_ODD = [f"o{i}" for i in range(PARITIES // 64)]
_FIRST = ", ".join(["shingle long, row long, label long, after long, n_shingles long, before array<long>", *(f"{o} long" for o in _ODD)])
_SIGNED = ", ".join(["row long", "n_shingles long", "print binary", *(f"{s} long" for s in _LONGS)])


def distance_for(percent: int) -> int:
    """Positions in which signatures of sets ``percent`` alike differ at most, but for ``MISSED``.

    Each position differs with the chance that the minima differ and their kept bits do too.
    """
    differs = (1 - percent / 100) * (1 - 0.5**BITS)
    beyond, at = 1.0, -1
    while beyond > MISSED and at < HASHES:
        at += 1
        beyond -= math.comb(HASHES, at) * differs**at * (1 - differs)**(HASHES - at)
    if at // CHUNKS >= CHUNK:
        raise ValueError(f"sets {percent}% alike may differ in all positions of every chunk")
    return at


def signatures(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """One row of HASHES bytes per text; every text must have a value."""
    minima = np.empty((len(borders) - 1, HASHES), np.uint64)
    for i in range(HASHES):
        minima[:, i] = np.minimum.reduceat(values * _FACTORS[i] + _OFFSETS[i], borders[:-1])
    # The low bits of a factor's product are weak: the kept bits come from a further mix.
    return ((minima * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.uint8)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        values, borders = shingle_hashes(*word_hashes(batch["text"].to_pylist()))
        sets = [np.unique(values[b:e]) for b, e in zip(borders[:-1].tolist(), borders[1:].tolist())]
        sizes = np.array([len(s) for s in sets], np.int64)
        prints = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        full = np.flatnonzero(sizes)
        longs = np.zeros((len(sets), len(_LONGS)), np.int64)
        if len(full):
            signed = signatures(np.concatenate([sets[i] for i in full]), np.r_[0, np.cumsum(sizes[full])])
            longs[full] = signed.view(np.int64)
        yield pa.record_batch({"row": batch["row"], "n_shingles": sizes, "print": pa.array(prints, pa.binary()),
                               **{s: np.ascontiguousarray(longs[:, i]) for i, s in enumerate(_LONGS)}})
    forget_tables()


def _index(errors: int):
    """Keys of each signature: every chunk with each choice of ``errors`` positions left out."""
    kept = list(combinations(range(CHUNK), CHUNK - errors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            longs = np.stack([batch[s].to_numpy() for s in _LONGS], axis=1)
            signed = np.ascontiguousarray(longs).view(np.uint8).astype(np.int64).reshape(-1, CHUNKS, CHUNK)
            for chunk in range(CHUNKS):
                for choice, places in enumerate(kept):
                    key = np.full(len(signed), chunk * len(kept) + choice, np.int64)
                    for place in places:
                        key = key << BITS | signed[:, chunk, place]
                    yield pa.record_batch({"key": key, "row": batch["row"]})

    return run


def distance(a: str, b: str) -> Column:
    """Positions in which two signatures differ: bytes of the difference that are not zero."""

    def positions(name: str) -> Column:
        x = F.col(f"{a}.{name}").bitwiseXOR(F.col(f"{b}.{name}"))
        for shift in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        return F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))

    return reduce(lambda p, q: p + q, map(positions, _LONGS))


def parities(own: np.ndarray) -> np.ndarray:
    """For each place, whether the set has an odd number of shingles there, as bits of longs."""
    counts = np.bincount((own >> np.uint64(20) & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def differing(a: str, b: str) -> Column:
    """Shingles at least that only one of two sets has, from their parities."""
    return reduce(lambda p, q: p + q, [F.bit_count(F.col(f"{a}.{o}").bitwiseXOR(F.col(f"{b}.{o}"))) for o in _ODD])


def alike(first: np.ndarray, second: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets are linked."""
    low, high = sorted((len(first), len(second)))
    if 100 * low < percent * high:
        return False
    common = len(np.intersect1d(first, second, assume_unique=True))
    return 100 * common >= percent * (low + high - common)


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = None, None
        for batch in slices(batches, "text_b"):
            found = []
            for a, b, text_a, text_b in zip(*(batch[c].to_pylist() for c in ("a", "b", "text_a", "text_b"))):
                if a != known:
                    known, held = a, shingle_set(text_a)
                if alike(held, shingle_set(text_b), percent):
                    found.append((a, b))
            yield pa.record_batch({"a": pa.array([a for a, _ in found], pa.int64()),
                                   "b": pa.array([b for _, b in found], pa.int64())})

    return run


def _counter(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def _count_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << COUNTER_BITS, np.int64)
    for batch in slices(batches, "text"):
        values, _ = shingle_hashes(*all_word_hashes(batch["text"].to_pylist()))
        total += np.bincount(_counter(values), minlength=len(total))
    yield _blocks({block: part for block, part in enumerate(total.reshape(-1, COUNTERS)) if part.any()})


def _blocks(counts: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.record_batch({"block": pa.array(counts, pa.int64()), "counts": pa.array([c.tobytes() for c in counts.values()], pa.binary())})


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = {}
    for batch in batches:
        for block, counts in zip(batch["block"].to_pylist(), batch["counts"].to_pylist()):
            total[block] = total.get(block, 0) + np.frombuffer(counts, np.int64)
    yield _blocks(total)


def shingle_counts(texts: DataFrame) -> np.ndarray:
    """How often shingles occur, in a table of fixed size by their hash. Runs a job; a task
    sends its counters in blocks, which are summed. Counters that two shingles share only make the
    order of shingles less sharp."""
    blocks = "block long, counts binary"
    counted = texts.mapInArrow(_count_shingles, blocks).repartition("block").mapInArrow(_sum_counts, blocks).toArrow()
    counts = np.zeros(((1 << COUNTER_BITS) // COUNTERS, COUNTERS), np.int64)
    for block, part in zip(counted["block"].to_pylist(), counted["counts"].to_pylist()):
        counts[block] = np.frombuffer(part, np.int64)
    return counts.ravel().clip(max=np.iinfo(np.int32).max).astype(np.int32)


def _first_shingles(counts: np.ndarray, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            firsts, wholes, odd = [], [], []
            for text in batch["text"].to_pylist():
                own = shingle_set(text)
                wholes.append(len(own))
                odd.append(parities(own))
                # Of two sets alike, each has ceil(percent * n / 100) elements in common with the other.
                size = len(own) - -(-percent * len(own) // 100) + 1
                firsts.append(own[np.lexsort((own, counts[_counter(own)]))[:size]].view(np.int64))
            sizes = [len(f) for f in firsts]
            # Shingles of the set from this one on, itself included.
            after = [np.arange(n, n - len(f), -1) for f, n in zip(firsts, wholes)]
            before = [f[:i] if len(f) <= CARRIED else f[:0] for f in firsts for i in range(len(f))]
            odd = np.repeat(np.stack(odd), sizes, axis=0)
            yield pa.record_batch({
                "shingle": np.concatenate(firsts), "row": np.repeat(batch["row"].to_numpy(), sizes),
                "label": np.repeat(batch["label"].to_numpy(), sizes), "after": np.concatenate(after),
                "n_shingles": np.repeat(wholes, sizes), "before": pa.array(before, pa.list_(pa.int64())),
                **{o: np.ascontiguousarray(odd[:, i]) for i, o in enumerate(_ODD)}})

    return run


class NearDuplicates:
    """The groups of ``docs``. Building one runs the jobs; the results are tables."""

    def __init__(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT):
        self.doc_id, self.text, self.percent, self.distance = doc_id, text, percent, distance_for(percent)
        whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc")
        # Rows get a number that stays: the copy written here is what all later steps read.
        self.rows = staged(docs.select(F.monotonically_increasing_id().alias("row"), whole), "rows")
        texts = self.rows.select("row", F.col(f"doc.`{text}`").alias("text"))
        self.signed = written(texts.mapInArrow(_sign, _SIGNED), "signed")
        self.classes = staged(
            self.signed.filter("print IS NOT NULL").groupBy("print")
            .agg(F.min_by(F.struct("row", "n_shingles", *_LONGS), "row").alias("first"))
            .select("print", "first.*"), "classes")
        self.labels = self._labels()

    def _labels(self) -> DataFrame:
        """``row, label``: the component of every class that shares a key."""
        keys = self.classes.select("row", *_LONGS).mapInArrow(
            _index(self.distance // CHUNKS), "key long, row long")
        shared = keys.groupBy("key").agg(F.min("row").alias("low"), F.max("row").alias("high")) \
            .filter("low < high").select("key")
        self.keys = staged(keys.join(shared, "key"), "keys")
        named = staged(self.keys.select("row").distinct(), "compared")
        # Texts of rows that share a key, from which sets are built where they are compared.
        wanted = broadcast_if_small(named)
        self.texts = staged(
            self.rows.select("row", F.col(f"doc.`{self.text}`").alias("text")).join(wanted, "row", "left_semi"), "texts")
        labels = named.select("row", F.col("row").alias("label"))
        for turn in range(ROUNDS):
            found = written(self._confirmed(self._stars(labels, turn)), "found")
            if found.isEmpty():
                break
            labels = self._joined(labels, found)
        found = written(self._confirmed(self._across(labels)), "found")
        return labels if found.isEmpty() else self._joined(labels, found)

    def _joined(self, labels: DataFrame, links: DataFrame) -> DataFrame:
        """Labels after joining the components that confirmed links ``a, b`` connect."""
        first = labels.select(F.col("row").alias("a"), F.col("label").alias("label_a"))
        second = labels.select(F.col("row").alias("b"), F.col("label").alias("label_b"))
        between = links.join(first, "a").join(second, "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
        roots = connected_components(between).withColumnRenamed("id", "label")
        return staged(labels.join(roots, "label", "left").select(
            "row", F.coalesce("root", "label").alias("label")), "labels")

    def _mixed(self, labels: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
        """Keys whose rows are in different components: their rows, and one row of each."""
        labelled = self.keys.join(labels, "row")
        hub = F.min(F.struct(F.xxhash64("row", F.lit(turn)).alias("order"), "row", "label")).alias("hub")
        hubs = labelled.groupBy("key").agg(hub, F.min("label").alias("low"), F.max("label").alias("high")) \
            .filter("low < high").select("key", F.col("hub.row").alias("a"), F.col("hub.label").alias("label_a"))
        return labelled, hubs

    def _near(self, pairs: DataFrame) -> DataFrame:
        """Of pairs ``a, b``, those within the distance and the ratio of sizes, with ``far``."""
        signed = self.classes.select("row", "n_shingles", *_LONGS)
        first = signed.select(F.col("row").alias("a"), F.struct("n_shingles", *_LONGS).alias("sig_a"))
        second = signed.select(F.col("row").alias("b"), F.struct("n_shingles", *_LONGS).alias("sig_b"))
        low, high = F.least("sig_a.n_shingles", "sig_b.n_shingles"), F.greatest("sig_a.n_shingles", "sig_b.n_shingles")
        near = pairs.join(first, "a").join(second, "b").filter(low * 100 >= high * self.percent)
        return near.withColumn("far", distance("sig_a", "sig_b")).filter(F.col("far") <= self.distance).select("a", "b", "far")

    def _stars(self, labels: DataFrame, turn: int) -> DataFrame:
        """For each row, of the rows it is compared with in this round, the nearest one."""
        labelled, hubs = self._mixed(labels, turn)
        pairs = labelled.join(hubs, "key").filter("label != label_a").select("a", F.col("row").alias("b")).distinct()
        return self._near(pairs).groupBy("b").agg(F.min_by("a", F.struct("far", "a")).alias("a")).select("a", "b")

    def _across(self, labels: DataFrame) -> DataFrame:
        """All near pairs that are still in different components, among rows that share a key.

        Two sets that are alike share one of the first shingles of each in any common order,
        and from the first one they share on, both have enough shingles left. With rare
        shingles first, a text with many changes of its own meets nobody. Shingles are ordered
        by how often these texts hold them. Signatures and parities travel with the shingles, so
        that the join itself lets no pair out that is beyond the distance or has too few in common.
        """
        labelled, mixed = self._mixed(labels, ROUNDS)
        open_rows = labelled.join(mixed.select("key"), "key").select("row", "label").distinct()
        rows = staged(self.texts.join(open_rows, "row"), "mixed")
        counts = shingle_counts(rows.select("text"))
        first = written(rows.mapInArrow(_first_shingles(counts, self.percent), _FIRST), "first")
        shared = first.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high")) \
            .filter("low < high").select("shingle")
        signed = self.classes.select("row", F.struct(*_LONGS).alias("sig"))
        first = first.join(shared, "shingle").join(signed, "row").withColumn("odd", F.struct(*_ODD)).drop(*_ODD)
        first = staged(first, "first-shared")
        other = first.select("shingle", F.col("row").alias("b"), F.col("label").alias("label_b"), F.col("after").alias("after_b"),
                             F.col("n_shingles").alias("n_b"), F.col("before").alias("before_b"), F.col("sig").alias("sig_b"), F.col("odd").alias("odd_b"))
        enough = F.least("after", "after_b") * (100 + self.percent) >= (F.col("n_shingles") + F.col("n_b")) * self.percent
        sizes = F.least("n_shingles", "n_b") * 100 >= F.greatest("n_shingles", "n_b") * self.percent
        # Of n elements in two sets, at most so many are in one only: n less twice those in common.
        possible = differing("odd", "odd_b") * (100 + self.percent) <= (F.col("n_shingles") + F.col("n_b")) * (100 - self.percent)
        met = (F.col("label") < F.col("label_b")) & sizes & enough & possible & (distance("sig", "sig_b") <= self.distance) \
            & ~F.arrays_overlap("before", "before_b")
        return first.join(other, (first["shingle"] == other["shingle"]) & met).select(F.col("row").alias("a"), "b").distinct()

    def _confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs that are alike by their full sets."""
        first = self.texts.select(F.col("row").alias("a"), F.col("text").alias("text_a"))
        second = self.texts.select(F.col("row").alias("b"), F.col("text").alias("text_b"))
        return pairs.join(second, "b").join(first, "a").mapInArrow(_confirm(self.percent), "a long, b long")

    def groups(self) -> DataFrame:
        """``row, doc_id, n_shingles, component_id`` and ``stays`` (one row of each group)."""
        classes = self.classes.select("print", "row").join(self.labels, "row", "left") \
            .select("print", F.coalesce("label", "row").alias("root"))
        rows = self.signed.select("row", "n_shingles", "print").join(
            self.rows.select("row", F.col(f"doc.`{self.doc_id}`").alias("doc_id")), "row")
        alone = rows.filter("print IS NULL").withColumn("root", F.col("row"))
        rows = staged(rows.filter("print IS NOT NULL").join(classes, "print").unionByName(alone).drop("print"), "grouped")
        first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("first")
        firsts = rows.groupBy("root").agg(first).select(
            "root", F.col("first.doc_id").alias("component_id"), F.col("first.row").alias("first"))
        return rows.join(firsts, "root").select(
            "row", "doc_id", "n_shingles", "component_id", (F.col("row") == F.col("first")).alias("stays"))

    def kept(self) -> DataFrame:
        """The documents, one of each group."""
        return self.rows.join(self.groups().filter("stays").select("row"), "row", "left_semi").select("doc.*")
