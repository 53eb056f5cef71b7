"""Assertions on physical plans. Test helper only."""

from __future__ import annotations

import re

from etlkit.plans.run_log import JOIN_OPERATORS, physical_plan


def initial_plan(df) -> str:
    return physical_plan(df)


def final_plan(df) -> str:
    """The plan that adaptive execution ended with. Runs the query."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def final_part(plan: str) -> str:
    return plan.split("== Initial Plan ==")[0]


def joins(plan: str) -> list[str]:
    return re.findall("|".join(JOIN_OPERATORS), plan)


def exchanges(plan: str) -> int:
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|Round|Single)", plan))


def pushed(plan: str) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan)


def read_schemas(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan)
