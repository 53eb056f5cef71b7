"""A table of runs with the join operators their plans used."""

from __future__ import annotations

import re
from contextlib import redirect_stdout
from datetime import datetime, timezone
from io import StringIO
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from etlkit.sources.tables import values_lookup
from etlkit.workspace import ensure_checkpoint_dir

# Fixed operator names of Spark's physical plans.
JOIN_OPERATORS = (
    "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
    "BroadcastNestedLoopJoin", "CartesianProduct",
)
SCHEMA = ("run_id string, query string, run_at timestamp, join_operators string, "
          "exchanges long, rows long")


def physical_plan(df: DataFrame) -> str:
    """Text of the physical plan."""
    view = f"plan_{uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        return df.sparkSession.sql(f"EXPLAIN SELECT * FROM {view}").first()[0]
    finally:
        df.sparkSession.catalog.dropTempView(view)


def join_operators(plan: str) -> list[str]:
    return sorted(re.findall("|".join(JOIN_OPERATORS), plan))


def executed_plan(df: DataFrame) -> str:
    """Text of the plan that ran, once an action on ``df`` itself has ended."""
    with redirect_stdout(StringIO()) as out:
        df.explain("simple")
    return out.getvalue().partition("== Initial Plan ==")[0]


def record_run(spark: SparkSession, path: str, query: str, df: DataFrame) -> DataFrame:
    """Run ``df`` and append one row about the plan that ran to the run table.

    Adaptive execution may change joins while it runs, so the plan is taken after the run.
    The result is checkpointed in the shared folder and returned; write it from there.
    """
    ensure_checkpoint_dir(spark)
    result = df.checkpoint(eager=True)
    plan = executed_plan(df)
    exchanges = len(re.findall(r"\b(?:Broadcast)?Exchange\b", plan))
    row = (uuid4().hex, query, datetime.now(timezone.utc), ",".join(join_operators(plan)),
           exchanges, result.count())
    values_lookup(spark, [row], SCHEMA).write.mode("append").parquet(path)
    return result


def changed_strategies(spark: SparkSession, path: str) -> DataFrame:
    """Queries whose last two runs used different join operators."""
    runs = spark.read.schema(SCHEMA).parquet(path)
    newest = F.struct("run_at", "run_id")
    last = runs.groupBy("query").agg(
        F.max(newest).alias("at"), F.max_by("join_operators", newest).alias("latest"))
    before = (
        runs.join(last, "query").filter(newest < F.col("at"))
        .groupBy("query", "latest").agg(F.max_by("join_operators", newest).alias("previous"))
    )
    return before.select("query", "previous", "latest").filter("previous <> latest")
