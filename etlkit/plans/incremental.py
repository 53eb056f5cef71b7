"""Incremental loads and change application."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from etlkit.operators.layout import BALANCED_WRITE, TARGET_FILE_BYTES, balanced, stored_bytes
from etlkit.operators.reuse import measured, observed, staged
from etlkit.session import options
from etlkit.workspace import file_system

BATCH = "load_batch"


def _read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def incremental_load(
    source: DataFrame, target: str, state: str, watermark_column: str
) -> dict[str, Any]:
    """Append the source rows that are not loaded yet and store the new high-watermark.

    Rows above the stored watermark are new. Of rows equal to it and of rows without a
    value, those are new that the target does not hold already, repeated rows counted;
    the target is read at that value only. Rows that later arrive below the stored
    watermark are not picked up.

    A load goes to its own partition ``load_batch=N`` of ``target`` and is repeated
    into the same partition if the run failed before the watermark was stored.
    Row count and new watermark are measured by the write itself.
    """
    spark = source.sparkSession
    stored = _read_if_exists(spark, state)
    last = stored.orderBy(F.col(BATCH).desc()).first() if stored is not None else None
    batch = last[BATCH] + 1 if last else 0
    kind = source.schema[watermark_column].dataType
    fresh = source
    if last:
        value = F.col(watermark_column)
        high = F.lit(last["high_watermark"]).cast(kind)
        seen_at = value.isNull() | (value == high)
        loaded = spark.read.schema(_with_batch(source)).option("basePath", target).parquet(target)
        loaded = loaded.filter(F.col(BATCH) < batch).filter(seen_at).select(source.columns)
        above = source.filter(value > high if last["high_watermark"] is not None else value.isNotNull())
        fresh = above.union(source.filter(seen_at).exceptAll(loaded))
    counted, load = observed(
        fresh, f"load {batch}", F.count(F.lit(1)).alias("rows"),
        F.max(F.col(watermark_column)).cast("string").alias("high_watermark"))
    counted.write.mode("overwrite").parquet(f"{target}/{BATCH}={batch}")
    found = measured(load)
    rows, high = found.get("rows", 0), found.get("high_watermark")
    high = high or (last["high_watermark"] if last else None)
    row = spark.range(0, 1, 1, 1).select(
        F.lit(batch).cast("long").alias(BATCH), F.lit(rows).cast("long").alias("rows"),
        F.lit(high).cast("string").alias("high_watermark"))
    row.write.mode("append").parquet(state)
    return {"batch": batch, "rows": rows, "high_watermark": high}


def _with_batch(source: DataFrame) -> T.StructType:
    return T.StructType([*source.schema.fields, T.StructField(BATCH, T.LongType())])


def latest_changes(changes: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last change per key; combined before the shuffle, so a busy key stays cheap."""
    rest = [c for c in changes.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order_by)).alias("__row")
    return changes.groupBy(*keys).agg(last).select(*keys, "__row.*")


def apply_changes(
    base: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    operation: str = "op",
    delete: str = "D",
) -> DataFrame:
    """Base table after upserts and deletes; ``base`` has unique, non-null keys.

    ``changes`` holds the base columns, the operation and the order columns. Only
    the last change per key counts. One full outer join on unique keys.
    """
    latest = latest_changes(changes, keys, order_by)
    changed = latest.select(
        *keys, F.struct(*[c for c in base.columns if c not in keys]).alias("__new"),
        F.col(operation).alias("__op"))
    joined = base.join(changed, list(keys), "full_outer")
    kept = joined.filter(F.col("__op").isNull() | (F.col("__op") != F.lit(delete)))

    def value(column: str) -> Column:
        if column in keys:
            return F.col(column)
        return F.when(F.col("__op").isNotNull(), F.col(f"__new.`{column}`")).otherwise(
            F.col(column)).alias(column)

    return kept.select(*[value(c) for c in base.columns])


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace exactly the partitions that ``df`` has rows for; repeating it changes nothing.

    ``df`` must not read ``path``; pass it through ``staged`` first if it does.
    """
    writer = balanced(df, partition_by).write.mode("overwrite").partitionBy(*partition_by)
    with options(df.sparkSession, BALANCED_WRITE):
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)


# Else Spark makes numbers or dates of text, and "01" would be written back as 1.
_TEXT_PARTITIONS = {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """A partitioned folder with its partition columns as the text of the folders' names."""
    with options(spark, _TEXT_PARTITIONS):
        return spark.read.parquet(path)


def compact_partition(
    spark: SparkSession, path: str, partition_by: str, value: Any, target_bytes: int = TARGET_FILE_BYTES
) -> None:
    """Rewrite one partition of a folder as files near ``target_bytes``; the others stay.

    The rows are staged in their new files' layout, then replace the partition. Its value is
    compared as text, which is what the folder's name holds. A run that dies while it replaces
    the partition leaves it in part; ``sources.layered`` has a table that does not.
    """
    rows = _stored(spark, path).filter(F.col(partition_by).eqNullSafe(F.lit(value).cast("string")))
    files = max(1, math.ceil(stored_bytes(rows) / target_bytes))
    kept = staged(rows.coalesce(files), "compact")
    (kept.coalesce(files).write.mode("overwrite").partitionBy(partition_by)
     .option("partitionOverwriteMode", "dynamic").parquet(path))


def merge_into_partitions(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    partition_by: str,
    operation: str = "op",
    delete: str = "D",
) -> None:
    """Apply changes to a partitioned folder, rewriting only the partitions they touch.

    Touched are the partitions that changed rows go to and those where changed keys are
    stored, so a key may move. The latter are found by a semi join over the stored keys.
    The new content is staged before it replaces the old, and the folders of partitions
    left without rows are removed, one call per folder. Partition values have the type that
    ``changes`` gives them; empty text is a null, as in the folders. A run that dies while it
    replaces partitions leaves them in part; ``sources.layered`` has a table that does not.
    """
    kind = changes.schema[partition_by].dataType
    if isinstance(kind, T.StringType):
        changes = changes.withColumn(partition_by, F.nullif(F.col(partition_by), F.lit("")))
    stored = _stored(spark, path)
    stored = stored.withColumn(partition_by, stored[partition_by].cast(kind))
    held = stored.select(*keys, partition_by).join(changes.select(*keys).distinct(), list(keys), "left_semi")
    touched = staged(
        held.select(F.col(partition_by).alias("__touched"))
        .union(changes.select(partition_by)).distinct(), "touched")
    base = stored.join(touched, F.col(partition_by).eqNullSafe(F.col("__touched")), "left_semi")
    result = staged(apply_changes(base, changes, keys, order_by, operation, delete), "merge")
    remaining = result.select(F.col(partition_by).alias("__kept")).distinct()
    emptied = touched.join(
        remaining, F.col("__touched").eqNullSafe(F.col("__kept")), "left_anti")
    folder = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]+$", 1)
    located = base.select(partition_by, folder.alias("folder")).join(
        emptied, F.col(partition_by).eqNullSafe(F.col("__touched")), "left_semi")
    stale = [r["folder"] for r in located.select("folder").distinct().collect()]
    overwrite_partitions(result, path, [partition_by])
    for uri in stale:
        system, folder_path = file_system(spark, uri, encoded=True)
        system.delete(folder_path, True)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Read files written with differing columns; columns missing in a file are null."""
    return spark.read.option("mergeSchema", "true").parquet(path)
