"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from etlkit.operators.bitmaps import DistinctStore
from etlkit.operators.metrics import (
    aggregate_metrics, count_where, distinct_counts, exact_sum, period_trend, salted_aggregate,
)
from etlkit.queries.registry import query, table
from etlkit.workspace import new_path


@query("aggregate_metrics", """
SELECT l_returnflag, l_linestatus,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS m_l_extendedprice_sum,
       round(CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(l_quantity), 4)
           AS m_l_quantity_avg,
       count(l_orderkey) AS m_l_orderkey_count,
       max(l_discount) AS m_l_discount_max, min(l_discount) AS m_l_discount_min
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def aggregate_metrics_query(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn(
        "l_extendedprice", F.col("l_extendedprice").cast("decimal(18,2)"))
    result = aggregate_metrics(
        lines, ["l_returnflag", "l_linestatus"],
        {"l_extendedprice": "sum", "l_quantity": "avg", "l_orderkey": "count",
         "l_discount": ["max", "min"]},
        alias_prefix="m_")
    return result.withColumns({
        "m_l_extendedprice_sum": F.col("m_l_extendedprice_sum").cast("double"),
        "m_l_quantity_avg": F.round("m_l_quantity_avg", 4),
    })


@query("group_count", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def group_count(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").count()


@query("agg_basic", """
SELECT l_suppkey, count(*) AS lines, count(l_shipdate) AS shipped,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(l_quantity) AS avg_quantity,
       max(l_extendedprice) AS max_price, min(l_extendedprice) AS min_price
FROM lineitem GROUP BY l_suppkey""")
def agg_basic(spark, sf):
    quantity = exact_sum(F.col("l_quantity"))
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("lines"), F.count("l_shipdate").alias("shipped"),
        quantity.alias("quantity"),
        (quantity / F.count("l_quantity")).alias("avg_quantity"),
        F.max("l_extendedprice").alias("max_price"), F.min("l_extendedprice").alias("min_price"),
    )


@query("agg_stddev", """
SELECT l_returnflag, round(stddev_samp(l_quantity), 4) AS quantity_stddev,
       round(stddev_samp(l_discount), 4) AS discount_stddev
FROM lineitem GROUP BY l_returnflag""")
def agg_stddev(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.stddev_samp("l_quantity"), 4).alias("quantity_stddev"),
        F.round(F.stddev_samp("l_discount"), 4).alias("discount_stddev"))


@query("agg_multi_key", """
SELECT l_suppkey, l_returnflag, l_linestatus, count(*) AS lines,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
       max(l_quantity) AS max_quantity, min(l_quantity) AS min_quantity,
       round(stddev_samp(l_quantity), 4) AS quantity_stddev
FROM lineitem GROUP BY l_suppkey, l_returnflag, l_linestatus""")
def agg_multi_key(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey", "l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("lines"), exact_sum(F.col("l_extendedprice")).alias("price"),
        F.max("l_quantity").alias("max_quantity"), F.min("l_quantity").alias("min_quantity"),
        F.round(F.stddev_samp("l_quantity"), 4).alias("quantity_stddev"),
    )


@query("monthly_trend", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM orders GROUP BY 1, 2 ORDER BY 1, 2""")
def monthly_trend(spark, sf):
    return period_trend(table(spark, sf, "orders"), "o_orderdate", [
        F.count(F.lit(1)).alias("orders"), exact_sum(F.col("o_totalprice")).alias("revenue")])


@query("global_count", "SELECT count(*) AS rows FROM orders")
def global_count(spark, sf):
    return table(spark, sf, "orders").agg(F.count(F.lit(1)).alias("rows"))


@query("distinct_counts", """
WITH o AS (SELECT o_custkey, o_orderdate, nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders)
SELECT 'o_custkey' AS column_name, (SELECT count(*) FROM (SELECT DISTINCT o_custkey FROM o)) AS distinct_count
UNION ALL SELECT 'o_orderdate', (SELECT count(*) FROM (SELECT DISTINCT o_orderdate FROM o))
UNION ALL SELECT 'o_orderpriority', (SELECT count(*) FROM (SELECT DISTINCT o_orderpriority FROM o))""")
def distinct_counts_query(spark, sf):
    orders = table(spark, sf, "orders").withColumn(
        "o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return distinct_counts(orders, ["o_custkey", "o_orderdate", "o_orderpriority"])


@query("distinct_bitmaps", """
WITH v AS (SELECT o_orderstatus AS status, 'o_custkey' AS column_name, CAST(o_custkey AS VARCHAR) AS v FROM orders
           UNION ALL SELECT o_orderstatus, 'o_orderdate', CAST(o_orderdate AS VARCHAR) FROM orders
           UNION ALL SELECT o_orderstatus, 'o_orderpriority', o_orderpriority FROM orders)
SELECT status, column_name, count(*) AS distinct_count FROM (SELECT DISTINCT * FROM v) GROUP BY ALL
UNION ALL SELECT 'all', column_name, count(*) FROM (SELECT DISTINCT column_name, v FROM v) GROUP BY ALL""")
def distinct_bitmaps(spark, sf):
    """Distinct values per status and of all orders, from the stored bitmaps of two loads."""
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderstatus", "status")
    store = DistinctStore(
        spark, new_path(spark, "distinct"), ["o_custkey", "o_orderdate", "o_orderpriority"], ["status"])
    dear = F.coalesce(F.col("o_totalprice") > 100000, F.lit(False))
    store.add(orders.filter(~dear), 0)
    store.add(orders.filter(dear), 1)
    total = store.counts().select(F.lit("all").alias("status"), "column_name", "distinct_count")
    return store.counts(["status"]).unionAll(total)


@query("counts_one_pass", """
SELECT count(*) FILTER (event_type = 'purchase') AS purchases,
       count(*) FILTER (event_type = 'error') AS errors,
       count(*) FILTER (value > 100) AS large_values, count(*) AS events
FROM events""")
def counts_one_pass(spark, sf):
    kind = F.col("event_type")
    return table(spark, sf, "events").agg(
        *count_where(purchases=kind == "purchase", errors=kind == "error",
                     large_values=F.col("value") > 100),
        F.count(F.lit(1)).alias("events"))


@query("agg_salted", """
SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
       round(CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(l_quantity), 4)
           AS avg_quantity,
       count(l_quantity) AS lines, max(l_quantity) AS max_quantity
FROM lineitem GROUP BY l_returnflag""")
def agg_salted(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn(
        "l_extendedprice", F.col("l_extendedprice").cast("decimal(18,2)"))
    result = salted_aggregate(
        lines, ["l_returnflag"],
        {"l_extendedprice": "sum", "l_quantity": ["avg", "count", "max"]})
    return result.select(
        "l_returnflag", F.col("l_extendedprice_sum").cast("double").alias("price"),
        F.round("l_quantity_avg", 4).alias("avg_quantity"),
        F.col("l_quantity_count").alias("lines"), F.col("l_quantity_max").alias("max_quantity"))


@query("distinct_values", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct_values(spark, sf):
    return table(spark, sf, "orders").select("o_custkey", "o_orderstatus").distinct()
