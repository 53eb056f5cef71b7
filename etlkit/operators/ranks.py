"""Places of values among ascending cuts."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, functions as F


def place(cuts: list[Any], value: Column, counted: bool) -> Column:
    """How many of the ascending ``cuts`` are below ``value``, or at most it if ``counted``; 0 for null.

    By halving steps over a literal array, inside the JVM.
    """
    if not cuts:
        return F.lit(0)
    ends, steps = F.lit(cuts), [1 << k for k in reversed(range(len(cuts).bit_length()))]

    def further(at: Column, step: Column) -> Column:
        cut = F.get(ends, (at + step - 1).cast("int"))
        passed = cut <= value if counted else cut < value
        return at + F.when((at + step <= len(cuts)) & passed, step).otherwise(F.lit(0))

    return F.aggregate(F.lit(steps).cast("array<int>"), F.lit(0), further)
