"""Exact distinct counts from stored bitmaps, for any grouping, without reading the rows again.

Every distinct value of a column gets a position once. Each load stores, per group, column and
bucket of 32,768 positions, which positions occur. Counts of coarser groups, of several loads or of
everything are bitwise sums of these rows. A load is scanned once for all columns.

Folders of a store::

    values/load=N/      column_name, value, chunk, position: values that no earlier load had
    bitmaps/load=N/     groups, column_name, origin, chunk, bucket, bitmap; without _SUCCESS not read
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from etlkit.operators.reuse import staged
from etlkit.workspace import file_system

_NULL, _VALUE = "null", "="
# Positions within one task's share of the values; the bits above hold the task.
_ROW_BITS = 33
_SLOT = ["origin", "chunk", "bucket"]


def _text(df: DataFrame, column: str) -> Column:
    """A column as text, equal for equal values and for no others; null is a value."""
    kind, value = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        raise TypeError(f"{column}: distinct values of {kind.simpleString()} are not supported")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = value + F.lit(0.0).cast(kind)  # minus zero equals zero
    elif isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)  # two instants can read the same on a clock
    elif isinstance(kind, T.BinaryType):
        value = F.hex(value)
    return F.coalesce(F.concat(F.lit(_VALUE), value.cast("string")), F.lit(_NULL))


class DistinctStore:
    """Distinct values of ``columns`` per group of the ``by`` columns, kept at ``path``.

    A bitmap takes 4 KiB before compression however few positions it holds: group by what
    has a good part of a bucket's values, such as days or regions, not by single keys.
    """

    def __init__(self, spark: SparkSession, path: str, columns: Sequence[str], by: Sequence[str] = ()):
        taken = {c.lower() for c in by} & {"column_name", "value", "bitmap", "position", "load", *_SLOT}
        if taken:
            raise ValueError(f"names that the store uses itself: {sorted(taken)}")
        self.spark, self.path = spark, path.rstrip("/")
        self.columns, self.by = list(columns), list(by)

    def _names(self, folder: str) -> list[str]:
        system, path = file_system(self.spark, f"{self.path}/{folder}")
        return [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []

    def loads(self) -> list[int]:
        """Loads that are complete."""
        numbers = [int(n.partition("=")[2]) for n in self._names("bitmaps") if n.startswith("load=")]
        return sorted(n for n in numbers if "_SUCCESS" in self._names(f"bitmaps/load={n}"))

    def _read(self, folder: str, loads: Sequence[int]) -> DataFrame:
        parts = [self.spark.read.parquet(f"{self.path}/{folder}/load={n}").withColumn("load", F.lit(n))
                 for n in loads]
        return reduce(DataFrame.unionAll, parts)

    def add(self, df: DataFrame, load: int) -> None:
        """Store the values of one load; runs jobs. A complete load is left as it is, one that died is
        written anew. Loads are added one after the other.

        Values are made distinct per group in each task first, so hot ones do not travel.
        """
        done = self.loads()
        if load in done:
            return
        pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), _text(df, c).alias("value"))
                          for c in self.columns])
        groups = [f"`{c}`" for c in self.by]
        seen = staged(df.select(*groups, F.inline(pairs)).distinct(), "distinct-values")
        fresh = seen.select("column_name", "value").distinct()
        if done:
            fresh = fresh.join(self._read("values", done), ["column_name", "value"], "left_anti")
        # Ranges put values that sort together, and so often occur together, in one bucket.
        placed = fresh.repartitionByRange("column_name", "value").sortWithinPartitions("column_name", "value")
        slot = F.monotonically_increasing_id()
        (placed.withColumn("slot", slot).select(
            "column_name", "value", F.shiftright("slot", _ROW_BITS).cast("int").alias("chunk"),
            (F.col("slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1).alias("position"))
         .write.mode("overwrite").parquet(f"{self.path}/values/load={load}"))
        known = self._read("values", [*done, load]).withColumnRenamed("load", "origin")
        found = seen.join(known, ["column_name", "value"]).withColumn("bucket", F.bitmap_bucket_number("position"))
        (found.groupBy(*groups, "column_name", *_SLOT)
         .agg(F.bitmap_construct_agg(F.bitmap_bit_position("position")).alias("bitmap"))
         .write.mode("overwrite").parquet(f"{self.path}/bitmaps/load={load}"))

    def counts(self, by: Sequence[str] = (), loads: Sequence[int] | None = None) -> DataFrame:
        """``by`` columns, ``column_name``, ``distinct_count`` over the loads named, or all. NULL counts as one
        value. ``by`` may be any of the store's; a column of a group without rows has no row."""
        unknown = sorted(set(by) - set(self.by))
        done = self.loads()
        missing = sorted(set(loads or ()) - set(done))
        if unknown or missing:
            raise ValueError(f"not in the store: {unknown or missing}")
        chosen = done if loads is None else list(loads)
        if not chosen:
            raise ValueError("no load to count")
        groups = [f"`{c}`" for c in by]
        merged = self._read("bitmaps", chosen).groupBy(*groups, "column_name", *_SLOT).agg(
            F.bitmap_or_agg("bitmap").alias("bitmap"))
        return merged.groupBy(*groups, "column_name").agg(
            F.sum(F.bitmap_count("bitmap")).alias("distinct_count"))
