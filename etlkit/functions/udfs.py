"""Python functions on columns, each with its built-in equivalent.

The built-in form stays in the JVM and is the one to use; the others show the
cost and the shape of Python code for logic that has no built-in form.
"""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from etlkit.operators.columns import composite_key, first_match
from etlkit.operators.reuse import staged
from etlkit.operators.sizing import BROADCAST_LIMIT_BYTES, is_small


@F.udf(T.StringType(), useArrow=True)
def upper_udf(text):
    return None if text is None else text.upper()


def size_category_udf(bounds: Mapping[str, float], default: str):
    """Row function: first label whose lower bound the amount exceeds."""
    ordered = list(bounds.items())

    @F.udf(T.StringType(), useArrow=True)
    def category(amount):
        if amount is None:
            return default
        return next((label for label, bound in ordered if amount > bound), default)

    return category


def size_category(amount: Column, bounds: Mapping[str, float], default: str) -> Column:
    """Built-in form of ``size_category_udf``."""
    return first_match({label: amount > bound for label, bound in bounds.items()}, default)


@F.udf(T.StringType(), useArrow=True)
def key_udf(prefix, number):
    return None if prefix is None or number is None else f"{prefix}_{number}"


def key(prefix: str, number: str) -> Column:
    """Built-in form of ``key_udf``."""
    return composite_key(prefix, number)


@F.pandas_udf(T.DoubleType())
def net_amount(price: pd.Series, discount: pd.Series) -> pd.Series:
    """Price less discount, a whole Arrow batch at a time."""
    return price * (1 - discount)


def broadcast_lookup(
    df: DataFrame, column: str, lookup: DataFrame, key: str, value: str,
    name: str, default: str = "unknown", limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Add ``name``: the lookup value for ``column`` as text, by a dictionary sent to the executors.

    A dictionary goes through the driver, so the lookup is measured first; beyond
    ``limit_bytes`` it is joined instead. Both ways give the same: values are cast to text
    by Spark, and a null on either side finds nothing. Lookup keys must be unique and of the
    column's type. The lookup is computed once, into the shared folder.
    """
    entries = staged(lookup.select(
        F.col(key).alias("__key"), F.col(value).cast("string").alias("__value"),
    ).filter("__key IS NOT NULL AND __value IS NOT NULL"), "lookup")
    if not is_small(entries, limit_bytes):
        joined = df.join(entries, df[column] == entries["__key"], "left")
        return joined.withColumn(name, F.coalesce("__value", F.lit(default))).drop("__key", "__value")
    table = {r["__key"]: r["__value"] for r in entries.collect()}
    shared = df.sparkSession.sparkContext.broadcast(table)

    @F.udf(T.StringType(), useArrow=True)
    def find(k):
        return shared.value.get(k, default)

    return df.withColumn(name, find(column))
