"""Measured sizes and key skew, used to choose a join shape."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, GroupedData, functions as F, types as T

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
# Row header, 8 bytes per field and the hash-map entry of a broadcast relation.
_ROW_OVERHEAD = 40
_FIELD_BYTES = 8

_FIXED_WIDTH = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
    T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType,
)


def _variable_bytes(field: T.StructField) -> Column | None:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, _FIXED_WIDTH):
        return None
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        size = F.octet_length(value)
    elif isinstance(field.dataType, T.DecimalType):
        size = F.lit(16)
    else:
        size = F.octet_length(F.to_json(F.struct(value)))
    return F.coalesce(size, F.lit(0)).cast("long")


def measured_bytes(df: DataFrame) -> int:
    """Size of ``df`` as a broadcast relation. Runs one aggregate job over ``df``."""
    variable = [c for c in map(_variable_bytes, df.schema.fields) if c is not None]
    width = sum(variable, F.lit(0).cast("long"))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return row["n"] * (_ROW_OVERHEAD + _FIELD_BYTES * len(df.columns)) + (row["b"] or 0)


def is_small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> bool:
    """Whether ``df`` measurably fits the broadcast limit.

    First it is read for as many rows as pass the limit by their number alone, partition after
    partition, and no further; only a frame with fewer rows is measured by an aggregate job.
    """
    most = limit_bytes // (_ROW_OVERHEAD + _FIELD_BYTES * len(df.columns)) + 1
    if beyond(df, most).collect():
        return False
    if all(isinstance(f.dataType, _FIXED_WIDTH) for f in df.schema.fields):
        return True
    return measured_bytes(df) <= limit_bytes


def beyond(df: DataFrame, rows: int) -> DataFrame:
    """One row if ``df`` has ``rows`` rows or more, else none; no column is read."""
    return df.select(F.lit(1).alias("row")).offset(rows - 1).limit(1)


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast only when the measured size is within the limit.

    Beyond it the frame is returned without a hint, so Spark shuffles both sides
    and splits skewed partitions at run time. Runs the jobs of ``is_small``.
    """
    return F.broadcast(df) if is_small(df, limit_bytes) else df


def key_hash(df: DataFrame, keys: list[str]) -> Column:
    return F.xxhash64(*[df[f"`{k}`"] for k in keys])


def hot_keys(df: DataFrame, keys: list[str], share: float = 0.01) -> dict[int, float]:
    """Hashes of keys that hold more than ``share`` of the rows, with their share.

    One scan of the key columns with a frequent-items sketch per task. Sketches are
    merged by groups of tasks, then by groups of these and then to one, so that no task
    receives more than a few; rows are not shuffled. The sketch tracks ``12 / share``
    keys, which bounds the result. Its error is under a quarter of ``share``: a key just
    below the threshold may be included, which is harmless because hot keys are only
    laid out differently, never dropped.
    """
    total, top = frequent_keys(df, keys, 12 * math.ceil(1 / share))
    return {h: n / total for h, n in top if n > share * total}


def frequent_keys(df: DataFrame, keys: list[str], tracked: int) -> tuple[int, list[tuple[int, int]]]:
    """(rows, [(hash, estimated rows)]) of the keys in a frequent-items sketch that tracks ``tracked``."""
    merged = (
        by_tasks(df.select(key_hash(df, keys).alias("h")))
        .agg(F.count(F.lit(1)).alias("n"),
             F.expr(f"approx_top_k_accumulate(h, {tracked})").alias("sketch"))
        .groupBy(F.pmod("tasks", F.lit(math.isqrt(shuffle_partitions(df)) + 1)).alias("tasks"))
        .agg(F.sum("n").alias("n"), F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
        .groupBy(F.lit("all").alias("tasks"))
        .agg(F.sum("n").alias("n"), F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
        .select("n", F.expr(f"approx_top_k_estimate(sketch, {tracked})").alias("top"))
        .first()
    )
    return (merged["n"], [(t["item"], t["count"]) for t in merged["top"]]) if merged else (0, [])


def by_tasks(df: DataFrame) -> GroupedData:
    """Rows grouped by the input partition they are read from, in bounded many groups.

    The first level of merging sketches: each group takes those of a few tasks, so
    that no single task receives one sketch per task of a large scan.
    """
    groups = F.lit(shuffle_partitions(df))
    return df.groupBy(F.pmod(F.spark_partition_id(), groups).alias("tasks"))


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def salts_for(df: DataFrame, hot: dict[int, float]) -> int:
    """Salts that bring the hottest key down to about one shuffle partition's share."""
    if not hot:
        return 1
    return max(2, math.ceil(max(hot.values()) * shuffle_partitions(df)))


def parts_for(df: DataFrame, hot: dict[int, float]) -> dict[int, int]:
    """Per hot key, the parts that bring it down to about one shuffle partition's share, two at least."""
    return {h: max(2, math.ceil(share * shuffle_partitions(df))) for h, share in hot.items()}


def parts_of(df: DataFrame, keys: list[str], parts: dict[int, int]) -> Column:
    """The parts of the row's key; 1 for keys without an entry."""
    if not parts:
        return F.lit(1)
    known = F.create_map(*[F.lit(x) for entry in parts.items() for x in entry])
    own = key_hash(df, keys)
    return F.when(own.isin(list(parts)), F.coalesce(known[own], F.lit(1))).otherwise(F.lit(1))


def salts_by_key(df: DataFrame, keys: list[str], hot: dict[int, float]) -> Column:
    """Number of salts of the row's key: its own share decides."""
    return parts_of(df, keys, parts_for(df, hot))


def row_salt(df: DataFrame, salts: int | Column) -> Column:
    """A salt in ``[0, salts)`` that a retried task computes again identically.

    It mixes the row's hash with the number of the partition the row is read
    from, so that rows which are copies of each other spread as well.
    """
    hashable = [F.col(f"`{f.name}`") for f in df.schema.fields
                if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    salts = F.lit(salts) if isinstance(salts, int) else salts
    row = F.pmod(F.xxhash64(*hashable), salts)
    return F.pmod(row + F.spark_partition_id(), salts).cast("int")


def is_hot(df: DataFrame, keys: list[str], hot: dict[int, float]) -> Column:
    return key_hash(df, keys).isin(list(hot)) if hot else F.lit(False)
