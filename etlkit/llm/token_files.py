"""Token ids in files: frequency-ranked, byte-aligned, with separate control bytes.

Every id is replaced by its rank in the corpus, the most frequent id having rank 0, and a
rank takes one to four bytes. The lengths of four ranks make one control byte, kept apart
from the data bytes, so a reader looks up four lengths, offsets and masks at once.

A folder written here holds ``blocks`` (Parquet; a row is a run of documents: ``shard``,
their ``doc_ids``, ``starts`` within the shard and ``sizes``, and the two streams
``control`` and ``data``), ``ranks`` (``id``, ``rank``) and ``shards`` (``shard``, ``base``:
ids in all shards before it). Shards are ranges of ascending document ids, nulls first.

Cases: a null or empty text is one end id; rows of the same id stay side by side in the order
of their texts' hashes; an empty table makes an empty folder that reads as no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from etlkit.llm.byte_tokens import encoder
from etlkit.llm.common import pick, slices
from etlkit.operators.reuse import staged
from etlkit.operators.sizing import broadcast_if_small, shuffle_partitions

END_ID = 0
# A block is closed when it holds so many ids.
BLOCK_IDS = 1 << 20

# For each control byte: bytes of its four values, where each begins, all four together.
_CODES = (np.arange(256)[:, None] >> (2 * np.arange(4))) & 3
_OFFSETS = np.cumsum(_CODES + 1, axis=1) - (_CODES + 1)
_TOTALS = (_CODES + 1).sum(axis=1)
_MASKS = ((np.uint64(1) << (8 * (_CODES + 1)).astype(np.uint64)) - np.uint64(1)).astype(np.uint32)

_IDS = "doc_id long, shard int, start long, n_tokens long, ids binary"
_BLOCKS = ("shard int, doc_ids array<long>, starts array<long>, sizes array<long>, "
           "control binary, data binary")


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    values = values.astype(np.uint32)
    codes = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    ends = np.cumsum(codes + 1, dtype=np.int64)
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    begins = ends - codes - 1
    data[begins] = values & 0xFF
    for byte in (1, 2, 3):
        longer = np.flatnonzero(codes >= byte)
        data[begins[longer] + byte] = (values[longer] >> (8 * byte)) & 0xFF
    quads = np.zeros(-(-len(codes) // 4) * 4, np.uint8)
    quads[:len(codes)] = codes
    quads = quads.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of two streams, by table lookup of the control bytes."""
    keys = np.frombuffer(control, np.uint8)
    totals = _TOTALS[keys]
    begins = np.cumsum(totals) - totals
    at = (begins[:, None] + _OFFSETS[keys]).ravel()[:n]
    padded = np.zeros(len(data) + 4, np.uint8)
    padded[:len(data)] = np.frombuffer(data, np.uint8)
    # Four bytes from every place on.
    words = np.ndarray(len(data) + 1, "<u4", padded.data, strides=(1,))[at]
    return (words & _MASKS[keys].ravel()[:n]).astype(np.uint32)


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts_to_ids = encoder(path)
        end = np.array([end_id], texts_to_ids.dtype).tobytes()
        width, start = texts_to_ids.dtype.itemsize, 0
        for batch in slices(batches, "text"):
            ids = [i + end for i in texts_to_ids.encode([t or "" for t in batch["text"].to_pylist()])]
            sizes = np.array([len(i) // width for i in ids], np.int64)
            ends = start + np.cumsum(sizes)
            yield pa.record_batch({
                "doc_id": batch["doc_id"], "shard": batch["shard"], "start": ends - sizes,
                "n_tokens": sizes, "ids": pa.array(ids, pa.binary())})
            start = int(ends[-1])

    return run


def encoded(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
            end_id: int = END_ID) -> DataFrame:
    """One row per document: ``doc_id, shard, start`` (within its shard), ``n_tokens, ids``.

    Documents are dealt to shards by ranges of their id before they are encoded, so the
    range borders come from the plain table. ``ids`` is binary, see ``TextEncoder.dtype``.
    """
    rows = pick(docs, doc_id=doc_id, text=text)
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("tie", F.xxhash64("text"))
    # Equal rows differ in where they are read, so many of them do not fill one shard.
    rows = rows.withColumn("place", F.monotonically_increasing_id())
    keys = ["doc_id", "tie", "place"]
    dealt = rows.repartitionByRange(shuffle_partitions(docs), *keys).sortWithinPartitions(*keys)
    return dealt.select("doc_id", F.spark_partition_id().alias("shard"), "text").mapInArrow(
        _encode(path, end_id), _IDS)


def _counts(dtype: np.dtype, vocabulary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in slices(batches, "ids"):
            ids = np.frombuffer(b"".join(batch["ids"].to_pylist()), dtype)
            total += np.bincount(ids, minlength=vocabulary)
        seen = np.flatnonzero(total)
        yield pa.record_batch({"id": seen, "n": total[seen]})

    return run


def id_ranks(ids: DataFrame, dtype: np.dtype, vocabulary: int) -> np.ndarray:
    """The rank of every id of the vocabulary by its count in all documents, ties by id.

    Runs a job; each task sends one count per id of the vocabulary at most.
    """
    counted = ids.select("ids").mapInArrow(_counts(dtype, vocabulary), "id long, n long")
    totals = np.zeros(vocabulary, np.int64)
    for row in counted.groupBy("id").agg(F.sum("n").alias("n")).collect():
        totals[row["id"]] = row["n"]
    ranks = np.empty(vocabulary, np.uint32)
    ranks[np.argsort(-totals, kind="stable")] = np.arange(vocabulary, dtype=np.uint32)
    return ranks


def _blocks(dtype: np.dtype, ranks: np.ndarray):
    def block(shard: int, rows: list) -> dict:
        ids = np.frombuffer(b"".join(r[3] for r in rows), dtype)
        control, data = pack(ranks[ids])
        return {"shard": shard, "doc_ids": [r[0] for r in rows], "starts": [r[1] for r in rows],
                "sizes": [r[2] for r in rows], "control": control, "data": data}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("shard", pa.int32()), *((n, pa.list_(pa.int64())) for n in ("doc_ids", "starts", "sizes")),
            ("control", pa.binary()), ("data", pa.binary())])
        rows, held, current = [], 0, None
        for batch in slices(batches, "ids"):
            for shard, *row in zip(*(batch[c].to_pylist() for c in ("shard", "doc_id", "start", "n_tokens", "ids"))):
                if rows and (shard != current or held >= BLOCK_IDS):
                    yield pa.RecordBatch.from_pylist([block(current, rows)], schema)
                    rows, held = [], 0
                rows.append(row)
                held, current = held + row[2], shard
        if rows:
            yield pa.RecordBatch.from_pylist([block(current, rows)], schema)

    return run


def write_tokens(docs: DataFrame, folder: str, path: str, doc_id: str = "doc_id",
                 text: str = "text", end_id: int = END_ID) -> None:
    """Encode all documents in ascending order of their id into ``folder``. Runs jobs.

    Texts are encoded once, into a table in the shared folder; the second pass over it,
    when all counts are known, only replaces ids.
    """
    spark = docs.sparkSession
    known = encoder(path)
    ids = staged(encoded(docs, path, doc_id, text, end_id), "token-ids")
    ranks = id_ranks(ids, known.dtype, known.vocabulary)
    ids.mapInArrow(_blocks(known.dtype, ranks), _BLOCKS).write.parquet(f"{folder}/blocks")
    shards = ids.groupBy("shard").agg(F.sum("n_tokens").alias("n"))  # one row per shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")) \
        .write.parquet(f"{folder}/shards")
    table = spark.createDataFrame(list(enumerate(ranks.tolist())), "id int, rank long")
    table.coalesce(1).write.parquet(f"{folder}/ranks")


def _decode(id_of: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array(row["sizes"], np.int64)
                ids = id_of[unpack(row["control"], row["data"], int(sizes.sum()))].tobytes()
                ends = 4 * np.cumsum(sizes)
                parts = [ids[b:e] for b, e in zip((ends - 4 * sizes).tolist(), ends.tolist())]
                yield pa.record_batch({
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "shard": pa.array([row["shard"]] * len(sizes), pa.int32()),
                    "start": pa.array(row["starts"], pa.int64()), "n_tokens": sizes,
                    "ids": pa.array(parts, pa.binary())})

    return run


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of a folder: ``doc_id``, ``start`` (ids of all documents before
    it), ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers)."""
    ranks = spark.read.parquet(f"{folder}/ranks").collect()  # one row per id of the vocabulary
    id_of = np.zeros(len(ranks), "<u4")
    for row in ranks:
        id_of[row["rank"]] = row["id"]
    rows = spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks").mapInArrow(_decode(id_of), _IDS)
    shards = spark.read.schema("shard int, base long").parquet(f"{folder}/shards")
    return rows.join(broadcast_if_small(shards), "shard").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids")
