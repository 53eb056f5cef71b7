"""Partition layout."""

from __future__ import annotations

import math
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, functions as F

from etlkit.operators.ranks import place
from etlkit.operators.sizing import hot_keys, is_hot, measured_bytes, row_salt, salts_by_key

TARGET_FILE_BYTES = 256 * 1024 * 1024
# Rows that a task sorts for one file, by their size in memory.
SORT_BYTES = 512 * 1024 * 1024
TIES = 1 << 20
# Rows that the cuts of a curve are read from, about.
CUT_SAMPLE = 20_000


def partition_summary(df: DataFrame, label: str = "") -> DataFrame:
    """Rows per partition with the ratio to the mean: ``label, partition_id, rows, to_mean``.

    Empty partitions do not appear. The mean is a scalar subquery over the same counts.
    """
    counted = df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count(F.lit(1)).alias("rows"))
    mean = counted.agg(F.avg("rows")).scalar()
    return counted.select(
        F.lit(label).alias("label"), "partition_id", "rows",
        F.round(F.col("rows") / mean, 4).alias("to_mean"))


def skew_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: keys, rows, hottest key's rows and share, median, hottest to median.

    The median comes from the table of how many keys have each count, which stays
    small however many keys there are.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    counts = per_key.groupBy("rows").agg(F.count(F.lit(1)).alias("keys"))
    summed = counts.agg(
        F.sum("keys").alias("distinct_keys"),
        F.sum(F.col("rows") * F.col("keys")).alias("total_rows"),
        F.max("rows").alias("max_rows"),
        F.percentile("rows", F.lit(0.5), F.col("keys")).alias("median_rows"),
    )
    return summed.withColumns({
        "max_share": F.col("max_rows") / F.col("total_rows"),
        "max_to_median": F.col("max_rows") / F.col("median_rows"),
    })


def spread_evenly(df: DataFrame, partitions: int) -> DataFrame:
    """Round-robin over ``partitions``: equal sizes whatever the keys."""
    return df.repartition(partitions)


def colocate(
    df: DataFrame, keys: Sequence[str], partitions: int | None = None, share: float = 0.001
) -> DataFrame:
    """Hash-partition by (keys, ``salt``); only keys above ``share`` get several salts.

    A following group-by on (keys, salt) needs no further shuffle, and its small
    result can then be merged by keys. Runs one scan of the keys to find hot ones.
    """
    hot = hot_keys(df, list(keys), share)
    salted = df.withColumn("salt", row_salt(df, salts_by_key(df, list(keys), hot)))
    by = [*keys, "salt"]
    return salted.repartition(partitions, *by) if partitions else salted.repartition(*by)


def range_layout(
    df: DataFrame, columns: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Range-partition and sort by ``columns``, so files cover narrow value ranges.

    The last range key is a salt, which differs between rows and between copies of
    a row in different input partitions: a value holding many rows is split over
    several partitions instead of filling one.
    """
    by = [*columns, "__tie"]
    salted = df.withColumn("__tie", row_salt(df, TIES))
    ranged = (salted.repartitionByRange(partitions, *by) if partitions
              else salted.repartitionByRange(*by))
    return ranged.sortWithinPartitions(*columns).drop("__tie")


def _cuts(df: DataFrame, columns: Sequence[str], ranks: int) -> list[list]:
    """Per column, ascending values that split a sample of about ``CUT_SAMPLE`` rows evenly."""
    used = df.select(*[F.col(f"`{c}`") for c in columns])
    share = min(1.0, CUT_SAMPLE / max(1, used.count()))
    sample = used.sample(share, seed=1).limit(2 * CUT_SAMPLE).collect()
    cuts = []
    for i in range(len(columns)):
        found = sorted(r[i] for r in sample if r[i] is not None and r[i] == r[i])
        cuts.append(sorted({found[len(found) * k // ranks] for k in range(1, ranks)}) if found else [])
    return cuts


def curve_layout(
    df: DataFrame, columns: Sequence[str], partitions: int | None = None, bits: int = 10
) -> DataFrame:
    """Range-partition along a curve through ``columns``, so files are narrow in each of them.

    A value's rank is its place among ``2 ** bits`` sampled quantiles of its column, so columns
    of any type and spread weigh alike. The ranks' bits are interleaved, highest first, into the
    position on a Z-order curve, and rows are sorted by it. A filter on any one of n columns then
    leaves about the n-th root of the files that it would leave of a sort by it. Runs a count and
    a sample of these columns.
    """
    if bits * len(columns) > 62:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not fit a curve position")
    names = [f"__rank{i}" for i in range(len(columns))]
    cuts = _cuts(df, columns, 1 << bits)
    ranked = df.withColumns({n: place(c, F.col(f"`{v}`"), True).cast("long") for n, c, v in zip(names, cuts, columns)})
    position = F.lit(0).cast("long")
    for bit in range(bits):
        for i, name in enumerate(names):
            taken = F.shiftright(name, bit).bitwiseAND(1)
            position = position.bitwiseOR(F.shiftleft(taken, bit * len(names) + len(names) - 1 - i))
    placed = ranked.withColumn("__curve", position).drop(*names)
    return range_layout(placed, ["__curve"], partitions).drop("__curve")


# Keep many small partition values in parallel tasks; large ones are still split.
BALANCED_WRITE = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}


def balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Lay rows out for a write partitioned by ``partition_by``: a value in one task,
    unless it is large, when adaptive execution splits it. Write it under
    ``options(spark, BALANCED_WRITE)``."""
    return df.hint("rebalance", *partition_by)


def stored_bytes(df: DataFrame) -> int:
    """Total size of the files behind a file-based frame, from one listing that Spark spreads
    over tasks: no data is read."""
    files = [unquote(uri) for uri in df.inputFiles()]
    if not files:
        return 0
    listed = df.sparkSession.read.format("binaryFile").load(files)
    return listed.agg(F.sum("length").alias("bytes")).first()["bytes"] or 0


def compacted(
    df: DataFrame,
    cluster_by: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES,
) -> DataFrame:
    """Lay a file-based frame out as files near ``target_bytes`` when written.

    Without ``cluster_by`` neighbouring files are merged with no shuffle. With it each file is sorted
    by one task, so a file also holds no more than ``SORT_BYTES`` of rows in memory, however
    well they compress: a job measures them.
    """
    files = max(1, math.ceil(stored_bytes(df) / target_bytes))
    if not cluster_by:
        return df.coalesce(files)
    return range_layout(df, cluster_by, max(files, math.ceil(measured_bytes(df) / SORT_BYTES)))
