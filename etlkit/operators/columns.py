"""Column names, audit columns, date dimensions and tiers."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Fixed values of the audit columns.
SOURCE_SYSTEM = "pyspark_etl"
LOAD_ID = "batch_load"


def _snake(name: str) -> str:
    return "_".join(re.findall(r"[a-zA-Z0-9]+", name)).lower()


def _camel(name: str) -> str:
    first, *rest = _snake(name).split("_")
    return first + "".join(word.capitalize() for word in rest)


def _lower(name: str) -> str:
    return name.lower().replace(" ", "_")


CONVENTIONS = {"snake_case": _snake, "camelCase": _camel, "lower": _lower}


def standardize_column_names(df: DataFrame, naming_convention: str = "snake_case") -> DataFrame:
    """Rename every column by one convention; two columns meeting in one name raise."""
    if naming_convention not in CONVENTIONS:
        raise ValueError(f"Unsupported naming convention: {naming_convention}")
    rename = CONVENTIONS[naming_convention]
    sources: dict[str, list[str]] = {}
    for name in df.columns:
        sources.setdefault(rename(name), []).append(name)
    clashes = {new: old for new, old in sources.items() if len(old) > 1 or not new}
    if clashes:
        raise ValueError(f"column names collide or vanish when standardized: {clashes}")
    return df.toDF(*sources)


def add_audit_columns(
    df: DataFrame,
    load_timestamp: str | None = None,
    source_system: str = SOURCE_SYSTEM,
    load_id: str = LOAD_ID,
) -> DataFrame:
    """Add ``load_timestamp``, ``source_system`` and ``load_id``."""
    loaded = F.lit(load_timestamp).cast("timestamp") if load_timestamp else F.current_timestamp()
    return df.withColumns({
        "load_timestamp": loaded,
        "source_system": F.lit(source_system),
        "load_id": F.lit(load_id),
    })


def create_date_dimensions(df: DataFrame, date_column: str, quarter: bool = False) -> DataFrame:
    """Add year, month, day and ISO text of a date column, and on request its quarter."""
    value = F.col(f"`{date_column}`")
    if isinstance(df.schema[date_column].dataType, T.StringType):
        value = F.try_to_timestamp(value)
    parts = {"year": F.year(value), "month": F.month(value), "day": F.dayofmonth(value)}
    if quarter:
        parts["quarter"] = F.quarter(value)
    parts["formatted"] = F.date_format(value, "yyyy-MM-dd")
    return df.withColumns({f"{date_column}_{part}": expr for part, expr in parts.items()})


def as_condition(condition: str | Column) -> Column:
    return F.expr(condition) if isinstance(condition, str) else condition


def first_match(cases: Mapping[str, str | Column], default: str | None = None) -> Column:
    """Label of the first condition that holds; ``default`` when none does."""
    chosen = F.lit(default).cast("string")
    for label, condition in reversed(list(cases.items())):
        chosen = F.when(as_condition(condition), F.lit(label)).otherwise(chosen)
    return chosen


def composite_key(*columns: str, separator: str = "_") -> Column:
    """Columns joined to one string key; null if any part is null."""
    parts: list[Column] = []
    for name in columns:
        parts += [F.lit(separator)] * bool(parts) + [F.col(name).cast("string")]
    return F.concat(*parts)


def threshold_flags(df: DataFrame, column: str, thresholds: Iterable[float]) -> DataFrame:
    """One 0/1 column ``above_<threshold>`` per threshold, all in a single projection."""
    value = F.col(column)
    return df.withColumns({
        f"above_{t:g}": F.when(value > F.lit(t), 1).otherwise(0) for t in thresholds
    })
