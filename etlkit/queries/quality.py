"""Data quality, nulls, duplicates, ordered windows, layout and skew."""

from __future__ import annotations

from pyspark.sql import functions as F

from etlkit.operators.layout import (
    colocate, partition_summary, skew_profile, spread_evenly,
)
from etlkit.operators.metrics import exact_sum
from etlkit.operators.nulls import handle_null_values, remove_duplicates
from etlkit.operators.profiles import merged_report, store_profile, stored_profiles
from etlkit.operators.quality import (
    check_data_quality, check_rules, split_by_rules, tag_violations,
)
from etlkit.operators.windows import number_rows
from etlkit.queries.registry import query, table
from etlkit.workspace import new_path

GAPS_SQL = """
WITH o AS (SELECT o_orderkey, o_custkey, o_orderdate,
                  nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority,
                  CASE WHEN o_orderstatus = 'P' AND o_totalprice < 100000 THEN NULL
                       WHEN o_orderstatus = 'F' AND o_totalprice < 100000 THEN CAST('NaN' AS DOUBLE)
                       ELSE o_totalprice END AS o_totalprice FROM orders)
"""


def orders_with_gaps(spark, sf):
    price, low = F.col("o_totalprice"), F.col("o_totalprice") < 100000
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate",
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("o_orderpriority"),
        F.when((status == "P") & low, F.lit(None))
        .when((status == "F") & low, F.lit(float("nan"))).otherwise(price).alias("o_totalprice"),
    )


def _profile_sql(column: str, missing: str) -> str:
    return f"""
SELECT '{column}' AS column_name, count(*) AS total_rows, count(*) FILTER ({missing}) AS null_count,
       count(*) FILTER ({missing}) / count(*) * 100 AS null_percentage,
       (SELECT count(*) FROM (SELECT DISTINCT {column} FROM o)) AS distinct_count,
       (count(*) - count(*) FILTER ({missing})) / count(*) * 100 AS completeness
FROM o"""


QUALITY_SQL = GAPS_SQL + " UNION ALL ".join([
    _profile_sql("o_orderkey", "o_orderkey IS NULL"),
    _profile_sql("o_custkey", "o_custkey IS NULL"),
    _profile_sql("o_orderdate", "o_orderdate IS NULL"),
    _profile_sql("o_orderpriority", "o_orderpriority IS NULL"),
    _profile_sql("o_totalprice", "o_totalprice IS NULL OR isnan(o_totalprice)"),
])


@query("data_quality", QUALITY_SQL)
def data_quality(spark, sf):
    return check_data_quality(orders_with_gaps(spark, sf))


@query("data_quality_approx", f"""
SELECT column_name, total_rows, null_count, null_percentage, completeness FROM ({QUALITY_SQL})""")
def data_quality_approx(spark, sf):
    """The single-pass report without its estimates, which the tests compare."""
    return check_data_quality(orders_with_gaps(spark, sf), approximate=True).drop("distinct_count")


LINE_RULES = {
    "quantity_range": "l_quantity BETWEEN 1 AND 45",
    "price_positive": "l_extendedprice > 0",
    "discount_range": "l_discount >= 0 AND l_discount <= 0.08",
    "shipdate_known": "l_shipdate IS NOT NULL",
}


@query("quality_rules", """
SELECT rule, checked, failed, failed = 0 AS passed FROM (
  SELECT 'quantity_range' AS rule, count(*) AS checked,
         count(*) FILTER (NOT coalesce(l_quantity BETWEEN 1 AND 45, false)) AS failed FROM lineitem
  UNION ALL SELECT 'price_positive', count(*), count(*) FILTER (NOT coalesce(l_extendedprice > 0, false))
  FROM lineitem
  UNION ALL SELECT 'discount_range', count(*),
         count(*) FILTER (NOT coalesce(l_discount >= 0 AND l_discount <= 0.08, false)) FROM lineitem
  UNION ALL SELECT 'shipdate_known', count(*), count(*) FILTER (l_shipdate IS NULL) FROM lineitem
  UNION ALL SELECT 'row_count', count(*), greatest(1000000 - count(*), 0) FROM lineitem)""")
def quality_rules(spark, sf):
    return check_rules(table(spark, sf, "lineitem"), LINE_RULES, min_rows=1_000_000)


@query("quality_split", GAPS_SQL + """
SELECT o_orderkey, concat_ws(',',
         CASE WHEN o_orderpriority IS NULL THEN 'priority_known' END,
         CASE WHEN NOT coalesce(NOT isnan(o_totalprice) AND o_totalprice < 400000, false)
              THEN 'price_range' END) AS violations
FROM o""")
def quality_split(spark, sf):
    tagged = tag_violations(orders_with_gaps(spark, sf), {
        "priority_known": "o_orderpriority IS NOT NULL",
        "price_range": "NOT isnan(o_totalprice) AND o_totalprice < 400000",
    })
    return tagged.select("o_orderkey", "violations")


@query("quality_quarantine", GAPS_SQL + """
SELECT o_orderkey, o_orderpriority IS NULL OR NOT coalesce(NOT isnan(o_totalprice) AND o_totalprice < 400000, false) AS quarantined
FROM o""")
def quality_quarantine(spark, sf):
    passing, quarantined = split_by_rules(orders_with_gaps(spark, sf), {
        "priority_known": "o_orderpriority IS NOT NULL",
        "price_range": "NOT isnan(o_totalprice) AND o_totalprice < 400000",
    })
    return passing.select("o_orderkey", F.lit(False).alias("quarantined")).union(
        quarantined.select("o_orderkey", F.lit(True)))


@query("nulls_drop", GAPS_SQL + """
SELECT * FROM o WHERE o_orderpriority IS NOT NULL AND o_totalprice IS NOT NULL
                      AND NOT isnan(o_totalprice)""")
def nulls_drop(spark, sf):
    return handle_null_values(
        orders_with_gaps(spark, sf), "drop", subset=["o_orderpriority", "o_totalprice"])


@query("nulls_fill_values", GAPS_SQL + """
SELECT o_orderkey, coalesce(o_orderpriority, 'none') AS o_orderpriority,
       CASE WHEN o_totalprice IS NULL OR isnan(o_totalprice) THEN -1.0 ELSE o_totalprice END AS o_totalprice
FROM o""")
def nulls_fill_values(spark, sf):
    gaps = orders_with_gaps(spark, sf).select("o_orderkey", "o_orderpriority", "o_totalprice")
    return handle_null_values(gaps, "fill", {"o_orderpriority": "none", "o_totalprice": -1.0})


@query("nulls_fill_default", GAPS_SQL + """
SELECT o_orderkey, o_orderpriority,
       CASE WHEN o_totalprice IS NULL OR isnan(o_totalprice) THEN 0.0 ELSE o_totalprice END AS o_totalprice
FROM o""")
def nulls_fill_default(spark, sf):
    gaps = orders_with_gaps(spark, sf).select("o_orderkey", "o_orderpriority", "o_totalprice")
    return handle_null_values(gaps, "fill")


@query("forward_fill", """
SELECT event_id, user_id, ts, event_type,
       last_value(CASE WHEN event_type NOT IN ('error', 'signup') THEN value END IGNORE NULLS) OVER (
         PARTITION BY user_id ORDER BY ts, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
FROM events""")
def forward_fill_query(spark, sf):
    value = F.when(~F.col("event_type").isin("error", "signup"), F.col("value"))
    gaps = table(spark, sf, "events").select(
        "event_id", "user_id", "ts", "event_type", value.alias("value"))
    return handle_null_values(
        gaps, "forward_fill", subset=["value"], keys=["user_id"], order_by=["ts", "event_id"])


@query("window_rank_prepartitioned", """
SELECT o_orderkey, o_custkey, row_number() OVER (
         PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS order_number
FROM orders""")
def window_rank_prepartitioned(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return number_rows(
        orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], name="order_number").drop("o_orderdate")


def _dedup(spark, sf, keep):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return remove_duplicates(events, ["user_id", "event_type"], keep, ["ts", "event_id"])


DEDUP_SQL = """
SELECT event_id, ts, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts {d}, event_id {d}) = 1"""


@query("dedup_keep_first", DEDUP_SQL.format(d="ASC"))
def dedup_keep_first(spark, sf):
    return _dedup(spark, sf, "first")


@query("dedup_keep_last", DEDUP_SQL.format(d="DESC"))
def dedup_keep_last(spark, sf):
    return _dedup(spark, sf, "last")


@query("dedup_all", "SELECT DISTINCT user_id, event_type, floor(value) AS whole FROM events")
def dedup_all(spark, sf):
    events = table(spark, sf, "events").select(
        "user_id", "event_type", F.floor("value").cast("double").alias("whole"))
    return remove_duplicates(events)


@query("dedup_subset", "SELECT DISTINCT user_id, event_type FROM events")
def dedup_subset(spark, sf):
    return remove_duplicates(table(spark, sf, "events"), ["user_id", "event_type"]).select(
        "user_id", "event_type")


LAYOUT_SQL = """
SELECT l_returnflag, count(*) AS lines,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price
FROM lineitem GROUP BY l_returnflag"""


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select("l_returnflag", "l_suppkey", "l_extendedprice")


def _tasks(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _spread(spark, sf):
    return spread_evenly(_lines(spark, sf), 2 * _tasks(spark))


def _layout_totals(df):
    return df.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("lines"), exact_sum(F.col("l_extendedprice")).alias("price"))


@query("layout_round_robin", LAYOUT_SQL)
def layout_round_robin(spark, sf):
    return _layout_totals(_spread(spark, sf))


@query("layout_coalesce", LAYOUT_SQL)
def layout_coalesce(spark, sf):
    return _layout_totals(_spread(spark, sf).coalesce(_tasks(spark)))


@query("layout_by_key", """
SELECT l_suppkey, count(*) AS lines, max(l_extendedprice) AS max_price
FROM lineitem GROUP BY l_suppkey""")
def layout_by_key(spark, sf):
    """The first group-by uses the key layout as it is; only its small result moves again."""
    placed = colocate(_lines(spark, sf), ["l_suppkey"])
    partial = placed.groupBy("l_suppkey", "salt").agg(
        F.count(F.lit(1)).alias("n"), F.max("l_extendedprice").alias("m"))
    return partial.groupBy("l_suppkey").agg(
        F.sum("n").alias("lines"), F.max("m").alias("max_price"))


@query("partition_summary", """
SELECT 'lineitem' AS label, count(*) AS rows FROM lineitem""")
def partition_summary_query(spark, sf):
    """All rows, over round-robin partitions."""
    return partition_summary(_spread(spark, sf), "lineitem").groupBy("label").agg(F.sum("rows").alias("rows"))


@query("skew_profile", """
WITH k AS (SELECT l_suppkey, count(*) AS rows FROM lineitem GROUP BY l_suppkey)
SELECT count(*) AS distinct_keys, CAST(sum(rows) AS BIGINT) AS total_rows, max(rows) AS max_rows,
       quantile_cont(CAST(rows AS DOUBLE), 0.5) AS median_rows,
       max(rows) / sum(rows) AS max_share,
       max(rows) / quantile_cont(CAST(rows AS DOUBLE), 0.5) AS max_to_median
FROM k""")
def skew_profile_query(spark, sf):
    return skew_profile(table(spark, sf, "lineitem"), ["l_suppkey"])


PROFILED = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("stored_profile", f"""
WITH o AS (SELECT * REPLACE (CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS o_totalprice,
                             nullif(o_orderpriority, '5-LOW') AS o_orderpriority) FROM orders)
{" UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) - count({c}) AS null_count,
       count({c}) / count(*) * 100 AS completeness, {low} AS low, {high} AS high FROM o"""
    for c, low, high in (
        ("o_orderkey", "min(o_orderkey)::DOUBLE", "max(o_orderkey)::DOUBLE"),
        ("o_custkey", "min(o_custkey)::DOUBLE", "max(o_custkey)::DOUBLE"),
        ("o_totalprice", "min(o_totalprice)::DOUBLE", "max(o_totalprice)::DOUBLE"),
        ("o_orderdate", "datediff('day', DATE '1970-01-01', min(o_orderdate)::DATE)::DOUBLE",
         "datediff('day', DATE '1970-01-01', max(o_orderdate)::DATE)::DOUBLE"),
        ("o_orderpriority", "NULL::DOUBLE", "NULL::DOUBLE")))}""")
def stored_profile(spark, sf):
    """Profiles of the orders of each year, one of them stored twice, merged without reading orders again."""
    path = new_path(spark, "profiles")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("o_totalprice"),
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"))
    years = [r["year"] for r in orders.select(F.year("o_orderdate").alias("year")).distinct().collect()]
    for year in [*years, years[0]] if years else []:
        store_profile(orders.filter(F.year("o_orderdate").eqNullSafe(F.lit(year))), path, str(year), PROFILED)
    return merged_report(stored_profiles(spark, path)).select(
        "column_name", "total_rows", "null_count", "completeness", "low", "high")
