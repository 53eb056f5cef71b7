"""Ordered per-key computations that do not gather a hot key in one task.

Keys above a share of all rows are cut along the order into chunks of about equal size.
The borders are quantiles of the whole order, unique column included, taken from a sample
of the hot keys' rows, so rows that are alike in the first order columns are cut as well.
What a chunk needs from earlier ones is a single carry row, taken from a small table with
one row per hot key and chunk and placed in front of the chunk. Rows are shuffled once, by
(key, chunk). Keys below the share keep one chunk, and without hot keys the plan is the
plain window.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from etlkit.operators.reuse import staged
from etlkit.operators.sizing import broadcast_if_small, hot_keys, is_hot, key_hash, shuffle_partitions

HOT_SHARE = 0.001
# Sampled rows for each border between chunks.
SAMPLES = 40


def _borders(df: DataFrame, keys: list[str], order: list[str], hot: dict[int, float]) -> DataFrame:
    """``__hash, __borders, __coarse``: per hot key the ordered first rows of its chunks, and
    every few of them.

    A key gets as many chunks as shuffle partitions would be its share. The sample and the
    borders grow with the number of partitions only. Runs one scan of the order columns.
    """
    partitions, share = shuffle_partitions(df), sum(hot.values()) if keys else 1.0
    pieces = sum(math.ceil(s * partitions) for s in hot.values()) if keys else partitions
    rows = df.count() * share
    fraction = min(1.0, pieces * SAMPLES / max(rows, 1.0))
    step = max(1, math.ceil(rows * fraction / pieces))
    named = F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)])
    sample = (df.filter(is_hot(df, keys, hot)) if keys else df).sample(fraction, seed=11)
    sorted_rows = F.array_sort(F.collect_list(named))
    # Borders are fixed by writing them: all later steps must cut alike.
    borders = staged(
        sample.withColumn("__hash", _hash(sample, keys)).groupBy("__hash").agg(sorted_rows.alias("rows"))
        .select("__hash", F.filter("rows", lambda _, i: i % step == step - 1).alias("__borders")), "borders")
    coarse = max(2, math.isqrt(pieces))
    return borders.withColumn("__coarse", F.filter("__borders", lambda _, i: i % coarse == coarse - 1)) \
        .withColumn("__step", F.lit(coarse))


def _hash(df: DataFrame, keys: list[str]) -> Column:
    return key_hash(df, keys) if keys else F.lit(0).cast("long")


def _with_chunks(df: DataFrame, keys: list[str], order: list[str], hot: dict[int, float]) -> DataFrame:
    """Add ``__chunk``: the number of borders up to the row, null for keys that are not hot.

    Counted in two steps, first among every few borders, then among the few that follow.
    """
    named = F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)])
    rows = df.withColumn("__hash", _hash(df, keys))
    rows = rows.join(broadcast_if_small(_borders(df, keys, order, hot)), "__hash", "left")
    passed = F.size(F.filter("__coarse", lambda b: b <= named)) * F.col("__step")
    rest = F.slice("__borders", passed + 1, F.col("__step"))
    chunk = passed + F.size(F.filter(rest, lambda b: b <= named))
    return rows.withColumn("__chunk", F.when(F.col("__borders").isNotNull(), chunk)).select(*df.columns, "__chunk")


def _chunked_window(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    share: float,
    carry_of: Callable[[DataFrame], DataFrame],
    computed: Callable[[Window], dict[str, Column]],
) -> DataFrame:
    """Add ``computed`` columns over each key in order.

    ``carry_of(rows)`` returns, per key and ``__chunk``, the columns a carry row
    sets. In ``computed`` a carry row is told apart by ``__carry``.
    """
    hot = hot_keys(df, keys, share) if keys else {}
    if keys and not hot:
        rows = df.withColumns({"__carry": F.lit(False), "__chunk": F.lit(None)})
    else:
        cut = _with_chunks(df, keys, order, hot).withColumn("__carry", F.lit(False))
        carry = carry_of(cut.filter("__chunk IS NOT NULL").drop("__carry"))
        rows = cut.unionByName(carry.withColumn("__carry", F.lit(True)), allowMissingColumns=True)
    within = (Window.partitionBy(*keys, "__chunk").orderBy(F.col("__carry").desc(), *order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    result = rows.withColumns(computed(within)).filter(~F.col("__carry"))
    return result.drop("__carry", "__chunk")


def _earlier_chunks(keys: list[str]) -> Window:
    return (Window.partitionBy(*keys).orderBy("__chunk")
            .rowsBetween(Window.unboundedPreceding, -1))


def forward_fill(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    order_by: Sequence[str],
    share: float = HOT_SHARE,
) -> DataFrame:
    """Replace nulls in ``columns`` by the last non-null value of the same key.

    ``order_by`` should end in a unique column, by which also rows of one moment are cut.
    Without ``keys`` the frame is one series and always chunked. Runs a scan of the keys
    to find hot ones, and a scan of the order columns if there are any.
    """
    keys, order = list(keys), list(order_by)

    def latest_before(rows: DataFrame) -> DataFrame:
        latest = rows.groupBy(*keys, "__chunk").agg(*[
            F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c) for c in columns
        ])
        return latest.withColumns({
            c: F.last(c, ignorenulls=True).over(_earlier_chunks(keys)) for c in columns
        })

    def filled(window: Window) -> dict[str, Column]:
        return {c: F.last(c, ignorenulls=True).over(window) for c in columns}

    result = _chunked_window(df, keys, order, share, latest_before, filled)
    return result.select(*df.columns)


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    share: float = HOT_SHARE,
    name: str = "row_number",
) -> DataFrame:
    """Number each key's rows from 1 along ``order_by``, as a row-number window would.

    A carry row counts as many rows as the chunks before it hold.
    """
    keys, order = list(keys), list(order_by)

    def rows_before(rows: DataFrame) -> DataFrame:
        counted = rows.groupBy(*keys, "__chunk").agg(F.count(F.lit(1)).alias("n"))
        return counted.select(
            *keys, "__chunk",
            F.coalesce(F.sum("n").over(_earlier_chunks(keys)), F.lit(0)).alias("__before"))

    def position(window: Window) -> dict[str, Column]:
        return {name: F.sum(F.coalesce("__before", F.lit(1))).over(window)}

    keyed = df.withColumn("__before", F.lit(None).cast("long"))
    result = _chunked_window(keyed, keys, order, share, rows_before, position)
    return result.select(*df.columns, name)
