"""Exact top-k by inner product with norm-bucketed retrieval.

Vectors are dealt to partitions by ranges of length and, there, cut into buckets of like
length, longest first. A query knows a score that its k-th best result reaches at least.
Over the query's length and the bucket's greatest length this gives a local threshold for
the cosine: above 1 the bucket is left out; when high, candidates are cut by the coordinates
in which the query is largest; else by length alone. What is left is verified by its product.

The stated queries are taken in blocks of bounded size; each block is sent to all tasks and
every vector is compared with it where it lies. Pruning only uses bounds, so no result is
lost, and ties go to the smaller id.

Cases: a vector that is null, empty or holds null or non-finite components takes no part, neither
as query nor as candidate; rows without an id neither; other vectors must have one width, else
the search raises before it begins; rows of one id are separate candidates, but a query's own id never is one; a
query with fewer candidates than k returns all; zero vectors score 0; an empty table gives an
empty result; other columns are ignored. Components must stay below 2**31 after scaling.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from etlkit.llm.common import pick
from etlkit.operators.reuse import staged
from etlkit.operators.sizing import shuffle_partitions

K = 10
# Components become floor(SCALE * x).
SCALE = 1024
# Every row whose id is divisible by this is a query.
QUERY_EVERY = 100
# Queries sent to all tasks at once, and vectors of a bucket.
BLOCK_QUERIES = 8192
BUCKET = 1024
# Longest vectors that give each query its first threshold.
HEAD = 1024
# Local cosine from which coordinates prune better than lengths.
COORDINATE_FROM = 0.4
FOCUS = 3
# Bounds are rounded values: a candidate is left out only if it misses by more than this.
SLACK = 1e-9
# Products of whole numbers below this are exact in doubles.
EXACT = 2.0**53


def prepared(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, v`` (whole numbers) and ``length`` of the vectors that take part."""
    rows = pick(vectors, vec_id=vec_id, x=embedding).filter("vec_id IS NOT NULL AND size(x) > 0")
    fine = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = rows.filter(fine).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("x", lambda c: F.floor(c.cast("double") * SCALE).cast("long")).alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda total, c: total + c.cast("double") * c.cast("double"))
    return rows.withColumn("length", F.sqrt(square))


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products; in doubles if no sum can leave their whole numbers."""
    bound = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * queries.shape[1]
    if bound < EXACT:
        return (queries @ vectors.T).astype(np.int64)
    return (queries.astype(np.int64).astype(object) @ vectors.astype(np.int64).astype(object).T).astype(np.int64)


class Best:
    """The k best (score, id) of each query so far, and a score that its k-th reaches."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.lengths = np.sqrt((queries * queries).sum(axis=1))
        self.floors = floors.copy()
        self.found: list[list[tuple[int, int]]] = [[] for _ in ids]

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        keep = (scores >= self.floors[query]) & (ids != self.ids[query])
        if not keep.any():
            return
        scores, ids = scores[keep], ids[keep]
        if len(scores) > self.k:
            top = np.lexsort((ids, -scores))[:self.k]
            scores, ids = scores[top], ids[top]
        own = sorted(self.found[query] + list(zip((-scores).tolist(), ids.tolist())))[:self.k]
        self.found[query] = own
        if len(own) == self.k:
            self.floors[query] = max(self.floors[query], -own[-1][0])

    def bucket(self, ids: np.ndarray, vectors: np.ndarray, lengths: np.ndarray) -> None:
        """Compare with one bucket, its vectors in descending order of length."""
        reach = self.lengths * lengths[0]
        # Least cosine with which a vector of this bucket can matter to a query.
        local = np.where(reach > 0, self.floors / np.maximum(reach, SLACK), np.where(self.floors > 0, np.inf, -np.inf))
        open_ = local <= 1 + SLACK
        by_coordinate = np.flatnonzero(open_ & (local >= COORDINATE_FROM) & (lengths[-1] > 0))
        unit = vectors / np.maximum(lengths, SLACK)[:, None] if len(by_coordinate) else vectors
        for q in by_coordinate.tolist():
            keep = self._in_reach(q, unit, float(local[q]))
            if len(keep):
                self.add(q, _products(self.queries[q:q + 1], vectors[keep])[0], ids[keep])
        by_length = np.flatnonzero(open_ & ~((local >= COORDINATE_FROM) & (lengths[-1] > 0)))
        if not len(by_length):
            return
        # Vectors shorter than floor / query length cannot reach the floor, even in line.
        least = self.floors[by_length] / np.maximum(self.lengths[by_length], SLACK)
        counts = np.searchsorted(-lengths, -(least * (1 - SLACK)) + SLACK, "right")
        counts = np.where(self.floors[by_length] <= 0, len(lengths), counts)
        for start in range(0, len(by_length), 256):
            part, n = by_length[start:start + 256], counts[start:start + 256]
            scores = _products(self.queries[part], vectors[:n.max()])
            for q, row, m in zip(part.tolist(), scores, n.tolist()):
                self.add(q, row[:m], ids[:m])

    def _in_reach(self, q: int, unit: np.ndarray, local: float) -> np.ndarray:
        """Vectors whose share in the query's largest coordinates allows the local cosine.

        With query u and vector p of length 1: u.p <= u_F.p_F + |u_rest| * |p_rest|.
        """
        u = self.queries[q] / self.lengths[q]
        focus = np.argsort(-np.abs(u))[:FOCUS]
        p = unit[:, focus]
        rest = max(0.0, 1 - float((u[focus] ** 2).sum()))
        bound = p @ u[focus] + np.sqrt(rest * np.maximum(0, 1 - (p * p).sum(axis=1)))
        return np.flatnonzero(bound >= local - 1e-6)

    def rows(self) -> pa.RecordBatch:
        query = np.repeat(self.ids, [len(f) for f in self.found])
        pairs = np.array([p for f in self.found for p in f], np.int64).reshape(-1, 2)
        return pa.record_batch({"query_id": query, "vec_id": pairs[:, 1], "score": -pairs[:, 0]})


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch as a matrix of doubles; all have the width of the first."""
    return batch["v"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(float)


def _search(ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(ids, queries, floors, k)
        for batch in batches:
            for start in range(0, batch.num_rows, BUCKET):
                part = batch.slice(start, BUCKET)
                best.bucket(part["vec_id"].to_numpy(), _matrix(part), part["length"].to_numpy())
        yield best.rows()

    return run


def _first_floors(ids: np.ndarray, queries: np.ndarray, head: list, k: int) -> np.ndarray:
    """A score that each query's k-th best reaches: its k-th best among a few long vectors."""
    head_ids = np.array([r["vec_id"] for r in head], np.int64)
    vectors = np.array([r["v"] for r in head], float)
    floors = np.full(len(ids), -np.inf)
    if len(head) > k:
        for start in range(0, len(ids), 256):
            scores = _products(queries[start:start + 256], vectors).astype(float)
            scores[head_ids[None, :] == ids[start:start + 256, None]] = -np.inf
            floors[start:start + 256] = np.partition(scores, -k, axis=1)[:, -k]
    return floors


def top_products(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K,
                 query_every: int = QUERY_EVERY, block: int = BLOCK_QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best candidates of every query.

    Runs jobs: one writes the vectors in order of length; one per block of queries fetches it.
    """
    spark = vectors.sparkSession
    rows = prepared(vectors, vec_id, embedding)
    widths = rows.agg(F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("most")).first()
    if widths["least"] != widths["most"]:
        raise ValueError(f"vectors of {widths['least']} to {widths['most']} components have no products with each other")
    # Equal vectors differ in their ids, so many of them do not fill one range.
    dealt = rows.repartitionByRange(shuffle_partitions(rows), F.desc("length"), "vec_id")
    dealt = staged(dealt.sortWithinPartitions(F.desc("length"), "vec_id"), "by-length")
    asked = dealt.filter(F.col("vec_id") % query_every == 0).select("vec_id", "v")
    blocks = max(1, math.ceil(asked.count() / block))
    head = dealt.orderBy(F.desc("length"), "vec_id").limit(HEAD).collect()
    parts = []
    for i in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == i).orderBy("vec_id").collect()
        if not own:
            continue
        ids, queries = np.array([r["vec_id"] for r in own], np.int64), np.array([r["v"] for r in own], float)
        floors = _first_floors(ids, queries, head, k)
        parts.append(staged(_ranked(dealt.mapInArrow(
            _search(ids, queries, floors, k), "query_id long, vec_id long, score long"), k), "top"))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    return found


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The best of what the tasks found; each task sends at most k rows per query."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
