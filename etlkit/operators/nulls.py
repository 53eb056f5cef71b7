"""Null handling and de-duplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, functions as F

from etlkit.operators.windows import forward_fill

STRATEGIES = ("drop", "fill", "forward_fill")


def handle_null_values(
    df: DataFrame,
    strategy: str = "drop",
    fill_values: Mapping[str, Any] | None = None,
    subset: Sequence[str] | None = None,
    keys: Sequence[str] = (),
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Drop rows with nulls, fill nulls with values, or carry the last value forward.

    ``fill`` without values puts 0 into the numeric columns of ``subset``. With
    values, ``subset`` restricts which of them are used. ``forward_fill`` needs
    ``order_by`` and, for series that restart per entity, ``keys``.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"Unsupported null handling strategy: {strategy}")
    if strategy == "drop":
        return df.dropna(subset=list(subset) if subset else None)
    if strategy == "forward_fill":
        if not order_by:
            raise ValueError("forward_fill needs order_by")
        fixed = {*keys, *order_by}
        columns = list(subset) if subset else [c for c in df.columns if c not in fixed]
        return forward_fill(df, columns, keys, order_by)
    if not fill_values:
        return df.fillna(0, subset=list(subset) if subset else None)
    used = {c: v for c, v in fill_values.items() if subset is None or c in subset}
    return df.fillna(used) if used else df


def remove_duplicates(
    df: DataFrame,
    subset: Sequence[str] | None = None,
    keep: str = "first",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Keep one row per distinct ``subset`` (all columns by default).

    With ``order_by`` the first or last row in that order is kept; it should end
    in a unique column. Without it, which row survives is not defined. Either way
    this is an aggregate that combines before the shuffle, so a key holding a
    large part of the rows never gathers in one task.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    keys = list(subset) if subset else list(df.columns)
    rest = [c for c in df.columns if c not in keys]
    if not order_by or not rest:
        return df.dropDuplicates(keys)
    pick = F.min_by if keep == "first" else F.max_by
    chosen = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order_by)).alias("__row"))
    return chosen.select(*[F.col(c) if c in keys else F.col(f"__row.`{c}`").alias(c)
                           for c in df.columns])
