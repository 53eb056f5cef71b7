"""Business rules given as configuration."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame

from etlkit.operators.columns import as_condition, first_match

# Fixed label for rows that match no category.
OTHER = "Other"


def _filter(df: DataFrame, rule: Mapping[str, Any]) -> DataFrame:
    return df.filter(rule["condition"])


def _derive(df: DataFrame, rule: Mapping[str, Any]) -> DataFrame:
    return df.withColumn(rule["column"], as_condition(rule["expression"]))


def _categorize(df: DataFrame, rule: Mapping[str, Any]) -> DataFrame:
    label = first_match(rule["categories"], default=OTHER)
    return df.withColumn(f"{rule['column']}_category", label)


RULE_TYPES: dict[str, Callable[[DataFrame, Mapping[str, Any]], DataFrame]] = {
    "filter": _filter,
    "derive_column": _derive,
    "categorize": _categorize,
}


def apply_business_rules(df: DataFrame, rules: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """Apply named rules in order; a rule sees the columns made by those before it.

    ``filter`` takes ``condition``; ``derive_column`` takes ``column`` and
    ``expression``; ``categorize`` takes ``column`` and ``categories`` (label to
    condition, first match wins, else "Other") and writes ``<column>_category``.
    Conditions and expressions may be SQL text or ``Column``.
    """
    unknown = {name: r.get("type") for name, r in rules.items() if r.get("type") not in RULE_TYPES}
    if unknown:
        raise ValueError(f"unknown rule types: {unknown}")
    for rule in rules.values():
        df = RULE_TYPES[rule["type"]](df, rule)
    return df
