"""Column validation, quality reports and rule checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from etlkit.operators.columns import as_condition
from etlkit.operators.metrics import distinct_estimate, distinct_sketch
from etlkit.operators.sizing import by_tasks


def validate_required_columns(df: DataFrame, required_columns: Sequence[str]) -> None:
    """Raise ``ValueError`` naming the required columns that ``df`` lacks."""
    missing = [c for c in required_columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def is_missing(value: Column, data_type: T.DataType) -> Column:
    """NULL, or NaN where the type has one."""
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def _exact_profile(df: DataFrame, column: str) -> DataFrame:
    value = F.col("value")
    frequencies = df.groupBy(F.col(f"`{column}`").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    missing = is_missing(value, df.schema[column].dataType)
    return frequencies.agg(
        F.lit(column).alias("column_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("null_count"),
        F.count(F.lit(1)).alias("distinct_count"),
    )


def _approximate_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    measures = [F.count(F.lit(1)).alias("n")]
    merged = [F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows")]
    rows = []
    for i, c in enumerate(columns):
        value = F.col(f"`{c}`")
        measures += [F.count_if(is_missing(value, df.schema[c].dataType)).alias(f"m{i}"),
                     distinct_sketch(value).alias(f"s{i}")]
        merged += [F.coalesce(F.sum(f"m{i}"), F.lit(0)).alias(f"m{i}"),
                   distinct_estimate(f"s{i}").alias(f"d{i}")]
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.col("total_rows"),
            F.col(f"m{i}").alias("null_count"), F.col(f"d{i}").alias("distinct_count")))
    used = df.select(*[F.col(f"`{c}`") for c in columns])
    return by_tasks(used).agg(*measures).agg(*merged).select(F.inline(F.array(*rows)))


def check_data_quality(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """One row per column: total rows, nulls (NaN included), distinct values, completeness.

    Exact: each column is reduced to its value frequencies, from which all
    measures follow. A branch scans only its own column and combines equal values
    before the shuffle; all branches run in one job. With ``approximate`` the
    whole report is a single pass and distinct counts come from sketches (error
    about 2%). If
    ``df`` is costly to compute, write or persist it first: the exact form reads
    it once per column.
    """
    columns = list(df.columns if columns is None else columns)
    if approximate:
        profile = _approximate_profile(df, columns)
    else:
        profile = reduce(DataFrame.unionAll, [_exact_profile(df, c) for c in columns])
    total, nulls = F.col("total_rows"), F.col("null_count")

    def percent(part: Column) -> Column:
        return F.when(total > 0, part / total * 100).otherwise(F.lit(0.0))

    return profile.select(
        "column_name", "total_rows", "null_count",
        percent(nulls).alias("null_percentage"),
        "distinct_count",
        percent(total - nulls).alias("completeness"),
    )


def quality_report(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False
) -> dict[str, Any]:
    """The quality report as a dictionary. Runs one job; one row per column is collected."""
    rows = check_data_quality(df, columns, approximate).collect()
    measures = ("null_count", "null_percentage", "distinct_count", "completeness")
    return {
        "total_rows": rows[0]["total_rows"] if rows else 0,
        "columns": {r["column_name"]: {m: r[m] for m in measures} for r in rows},
    }


def _violation(condition: str | Column) -> Column:
    """A row breaks a rule when its condition is false or unknown."""
    return ~F.coalesce(as_condition(condition), F.lit(False))


def check_rules(
    df: DataFrame, rules: Mapping[str, str | Column], min_rows: int | None = None
) -> DataFrame:
    """Rows checked and rows failing per rule, in one pass: ``rule, checked, failed, passed``.

    ``min_rows`` adds a ``row_count`` rule that fails by the number of rows missing.
    """
    failed = {name: F.count_if(_violation(c)) for name, c in rules.items()}
    if min_rows is not None:
        failed["row_count"] = F.greatest(F.lit(min_rows) - F.count(F.lit(1)), F.lit(0))
    counted = df.agg(F.count(F.lit(1)).alias("checked"),
                     *[expr.alias(f"f{i}") for i, expr in enumerate(failed.values())])
    rows = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col("checked"),
                 F.col(f"f{i}").cast("long").alias("failed"), (F.col(f"f{i}") == 0).alias("passed"))
        for i, name in enumerate(failed)
    ])
    return counted.select(F.inline(rows))


def tag_violations(
    df: DataFrame, rules: Mapping[str, str | Column], column: str = "violations"
) -> DataFrame:
    """Add the comma-separated names of the rules a row breaks; empty text when none."""
    named = [F.when(_violation(c), F.lit(name)) for name, c in rules.items()]
    return df.withColumn(column, F.concat_ws(",", *named))


def split_by_rules(
    df: DataFrame, rules: Mapping[str, str | Column]
) -> tuple[DataFrame, DataFrame]:
    """(passing rows, quarantined rows with the names of the broken rules)."""
    tagged = tag_violations(df, rules)
    passing = tagged.filter(F.col("violations") == "").drop("violations")
    return passing, tagged.filter(F.col("violations") != "")
