"""Grouped metrics."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from etlkit.operators.reuse import staged
from etlkit.operators.sizing import (
    by_tasks, frequent_keys, hot_keys, key_hash, parts_of, row_salt, salts_by_key, shuffle_partitions,
)

FUNCTIONS = {
    "sum": F.sum, "count": F.count, "avg": F.avg, "max": F.max, "min": F.min,
    "stddev": F.stddev_samp,
}


def _expand(metrics: Mapping[str, str | Iterable[str]]) -> list[tuple[str, str]]:
    pairs = [(column, name) for column, names in metrics.items()
             for name in ([names] if isinstance(names, str) else names)]
    for _, name in pairs:
        if name not in FUNCTIONS:
            raise ValueError(f"Unsupported aggregation function: {name}")
    return pairs


def aggregate_metrics(
    df: DataFrame,
    group_by_columns: Sequence[str],
    metrics: Mapping[str, str | Iterable[str]],
    alias_prefix: str = "",
) -> DataFrame:
    """Group and compute one or several functions per column.

    Result columns are ``{prefix}{column}_{function}``. ``count`` counts non-null
    values. Spark combines partial results before the shuffle, so a hot group
    costs one row per map task.
    """
    computed = [FUNCTIONS[f](F.col(c)).alias(f"{alias_prefix}{c}_{f}") for c, f in _expand(metrics)]
    return df.groupBy(*group_by_columns).agg(*computed)


def exact_sum(value: Column, scale: int = 2) -> Column:
    """Sum of doubles to ``scale`` decimals that does not depend on row order.

    Whole units are added as integers, which stays in generated code, and in two
    parts so that no row count overflows them.
    """
    units = F.rint(value * F.lit(float(10**scale))).cast("long")
    high = F.sum(F.shiftright(units, 20)).cast("decimal(20,0)")
    low = F.sum(units.bitwiseAND(F.lit((1 << 20) - 1)))
    return (high * F.lit(1 << 20) + low).cast("double") / F.lit(float(10**scale))


def count_where(**conditions: Column) -> list[Column]:
    """One counting column per named condition, all computed in one pass."""
    return [F.count_if(condition).alias(name) for name, condition in conditions.items()]


def distinct_sketch(value: Column) -> Column:
    """Mergeable sketch of a column's distinct values, NULL counted as one value."""
    return F.hll_sketch_agg(F.xxhash64(value), F.lit(12))


def distinct_estimate(sketch: str) -> Column:
    """Distinct values of all sketches in a column; 0 when there are none."""
    return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(sketch)), F.lit(0))


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column with NULL counted as one value: ``column_name, distinct_count``.

    Exact counts de-duplicate one column at a time, so each branch scans and
    shuffles a single column and hot values collapse before the shuffle.
    """
    if approximate:
        sketched = by_tasks(df).agg(*[distinct_sketch(F.col(c)).alias(c) for c in columns])
        wide = sketched.agg(*[distinct_estimate(c).alias(c) for c in columns])
        pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("distinct_count"))
                          for c in columns])
        return wide.select(F.inline(pairs))
    parts = [
        df.select(c).distinct().agg(
            F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("distinct_count"))
        for c in columns
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result


_PARTIAL = {
    "sum": (("sum",), lambda p: F.sum(p["sum"])),
    "count": (("count",), lambda p: F.sum(p["count"])),
    "min": (("min",), lambda p: F.min(p["min"])),
    "max": (("max",), lambda p: F.max(p["max"])),
    "avg": (("sum", "count"), lambda p: F.sum(p["sum"]) / F.sum(p["count"])),
}


def salted_aggregate(
    df: DataFrame,
    group_by_columns: Sequence[str],
    metrics: Mapping[str, str | Iterable[str]],
    salts: int | None = None,
    share: float = 0.01,
) -> DataFrame:
    """Two-phase aggregate: by (keys, salt), then by keys; equal to the plain aggregate.

    Only groups above ``share`` of the rows are salted, each by its own share unless ``salts`` is
    given. The first phase spreads them over their salts, the second merges at most that many rows per group. Averages travel
    as sum and count. Runs one scan of the keys to find hot groups.
    """
    pairs = _expand(metrics)
    unsupported = sorted({f for _, f in pairs} - set(_PARTIAL))
    if unsupported:
        raise ValueError(f"not mergeable over salts: {unsupported}")
    keys = list(group_by_columns)
    hot = hot_keys(df, keys, share) if keys else {}
    needed = list(dict.fromkeys((c, base) for c, f in pairs for base in _PARTIAL[f][0]))
    names = {pair: f"__p{i}" for i, pair in enumerate(needed)}
    used = df.select(*dict.fromkeys([*group_by_columns, *[c for c, _ in pairs]]))
    if keys:
        parts = parts_of(used, keys, {h: salts for h in hot}) if salts else salts_by_key(used, keys, hot)
    else:
        parts = salts or shuffle_partitions(df)
    partial = (
        used.withColumn("__salt", row_salt(used, parts))
        .groupBy(*group_by_columns, "__salt")
        .agg(*[FUNCTIONS[base](c).alias(names[c, base]) for c, base in needed])
    )
    merged = [
        _PARTIAL[f][1]({base: F.col(names[c, base]) for base in _PARTIAL[f][0]}).alias(f"{c}_{f}")
        for c, f in pairs
    ]
    return partial.groupBy(*group_by_columns).agg(*merged)


def period_trend(df: DataFrame, date_column: str, metrics: list[Column]) -> DataFrame:
    """Metrics by year and month, in time order."""
    value = F.col(date_column)
    return (
        df.groupBy(F.year(value).alias("year"), F.month(value).alias("month"))
        .agg(*metrics)
        .orderBy("year", "month")
    )


def top_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """First ``k`` rows in an order that should end in a unique key."""
    return df.orderBy(*order).limit(k)


# Groups that the keys outside a sketch are counted in together.
REST_BUCKETS = 1 << 14


def top_keys(df: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """The ``k`` most frequent keys as (keys, rows), exactly; ties go to smaller keys.

    A frequent-items sketch names candidates, which one pass counts exactly; the other keys
    are counted together in ``REST_BUCKETS`` groups by their hash. A group with fewer rows than the
    k-th candidate holds no key that could enter. The keys of the groups that do not, if there are
    any, are counted as well. So what is shuffled are candidates and groups, not all keys, unless
    the counts are nearly even. Runs the sketch and the count.
    """
    keys = list(keys)
    _, found = frequent_keys(df, keys, 20 * k + 1000)
    found = sorted(found, key=lambda f: -f[1])[:4 * k]
    own = key_hash(df, keys)
    known = own.isin([h for h, _ in found]) if found else F.lit(False)
    bucket = F.pmod(own, F.lit(REST_BUCKETS)).cast("int")
    tagged = df.select(
        F.when(known, F.struct(*[F.col(f"`{c}`").alias(c) for c in keys])).alias("key"),
        F.when(~known, bucket).alias("bucket"))
    counted = staged(tagged.groupBy("key", "bucket").agg(F.count(F.lit(1)).alias("rows")), "top-keys")
    candidates = counted.filter("bucket IS NULL").select("key.*", "rows")
    leading = candidates.orderBy(F.desc("rows")).limit(k).collect()
    least = leading[-1]["rows"] if len(leading) == k else 1
    open_buckets = [r["bucket"] for r in counted.filter(F.col("bucket").isNotNull() & (F.col("rows") >= least)).collect()]
    if open_buckets:
        rest = df.filter(~known & bucket.isin(open_buckets)).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
        candidates = candidates.unionByName(rest)
    return top_k(candidates, k, F.col("rows").desc(), *keys)
