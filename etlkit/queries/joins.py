"""Joins in every strategy, skewed joins, shared wide tables."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from etlkit.operators.bands import band_join
from etlkit.operators.columns import first_match
from etlkit.operators.joins import (
    equi_join, hot_key_split_join, join_aggregate, salt_sides, salted_join,
)
from etlkit.operators.metrics import exact_sum, top_k
from etlkit.operators.sizing import broadcast_if_small, shuffle_partitions
from etlkit.queries.registry import query, table
from etlkit.sources.catalog import drop_table, write_bucketed
from etlkit.sources.tables import values_lookup, write_path
from etlkit.workspace import new_path

NET_SQL = "CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))"


def net():
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


def customers(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")


def orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


ORDERS_CUSTOMERS = """
SELECT o_custkey, o_orderkey, o_totalprice, c_name, c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey"""


@query("flagship_revenue", f"""
SELECT p_brand, CAST(sum({NET_SQL}) AS DOUBLE) AS net, count(*) AS lines
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_quantity > 10
GROUP BY p_brand ORDER BY net DESC, p_brand LIMIT 20""")
def flagship_revenue(spark, sf):
    """Filter, join parts (broadcast if measured small), revenue by brand, top 20."""
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    lines = table(spark, sf, "lineitem").filter("l_quantity > 10")
    by_brand = join_aggregate(
        lines, parts, ["l_partkey"], ["p_brand"],
        {"net": net().cast("decimal(18,4)")}, rows="lines")
    revenue = by_brand.withColumn("net", F.col("net").cast("double"))
    return top_k(revenue, 20, F.col("net").desc(), "p_brand")


@query("join_auto", """
SELECT c_custkey, c_name, c_nationkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def join_auto(spark, sf):
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    people = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    return equi_join(people, nations, "c_nationkey")


@query("join_broadcast", ORDERS_CUSTOMERS)
def join_broadcast(spark, sf):
    return equi_join(orders(spark, sf), customers(spark, sf), "o_custkey", strategy="broadcast")


@query("join_sort_merge", ORDERS_CUSTOMERS)
def join_sort_merge(spark, sf):
    return equi_join(orders(spark, sf), customers(spark, sf), "o_custkey", strategy="merge")


@query("join_shuffle_hash", ORDERS_CUSTOMERS)
def join_shuffle_hash(spark, sf):
    return equi_join(orders(spark, sf), customers(spark, sf), "o_custkey", strategy="shuffle_hash")


BANDS = [(1, 0.0, 100000.0, "bronze"), (2, 100000.0, 300000.0, "silver"),
         (3, 300000.0, 1000000.0, "gold")]
BAND_SCHEMA = "band_id int, min_amount double, max_amount double, tier string"


@query("join_band", """
SELECT o_orderkey, o_totalprice, band_id, tier
FROM orders JOIN (VALUES (1, 0.0, 100000.0, 'bronze'), (2, 100000.0, 300000.0, 'silver'),
                         (3, 300000.0, 1000000.0, 'gold')) AS b(band_id, min_amount, max_amount, tier)
  ON o_totalprice >= min_amount AND o_totalprice < max_amount""")
def join_band(spark, sf):
    bands = values_lookup(spark, BANDS, BAND_SCHEMA)
    return band_join(orders(spark, sf), "o_totalprice", bands, "min_amount", "max_amount").select(
        "o_orderkey", "o_totalprice", "band_id", "tier")


@query("join_band_many", """
WITH b AS (SELECT p_partkey, p_partkey * 8 AS low, p_partkey * 8 + 1 + p_size % 8 AS high FROM part)
SELECT p_partkey, count(*) AS orders, max(o_totalprice) AS highest
FROM orders JOIN b ON o_orderkey >= low AND o_orderkey < high GROUP BY p_partkey""")
def join_band_many(spark, sf):
    """One disjoint band per part, of eight widths: joined by shuffle on bins."""
    low = F.col("p_partkey") * 8
    bands = table(spark, sf, "part").select(
        "p_partkey", low.alias("low"), (low + 1 + F.col("p_size") % 8).alias("high"))
    joined = band_join(
        orders(spark, sf).select("o_orderkey", "o_totalprice"), "o_orderkey", bands, "low", "high")
    return joined.groupBy("p_partkey").agg(
        F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("highest"))


@query("join_star3", f"""
SELECT p_type, o_orderpriority, count(*) AS lines, CAST(sum({NET_SQL}) AS DOUBLE) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
GROUP BY p_type, o_orderpriority""")
def join_star3(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", net().alias("net"))
    priorities = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return (
        equi_join(equi_join(lines, parts, "l_partkey", strategy="broadcast"),
                  priorities, "l_orderkey")
        .groupBy("p_type", "o_orderpriority")
        .agg(F.count(F.lit(1)).alias("lines"), exact_sum(F.col("net"), 4).alias("revenue"))
    )


@query("join_dpp", """
SELECT o_orderpriority, count(*) AS orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY o_orderpriority""")
def join_dpp(spark, sf):
    """Filtering the dimension prunes the fact's partition folders at run time."""
    fact, dim = new_path(spark, "dpp-orders"), new_path(spark, "dpp-priority")
    source = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    write_path(source, fact, partition_by=["o_orderpriority"])
    levels = source.select("o_orderpriority").distinct().withColumn(
        "label", F.when(F.col("o_orderpriority") < "3", "fast").otherwise("normal"))
    write_path(levels, dim)
    fast = spark.read.parquet(dim).filter("label = 'fast'")
    return (
        spark.read.parquet(fact).join(broadcast_if_small(fast), "o_orderpriority")
        .groupBy("o_orderpriority")
        .agg(F.count(F.lit(1)).alias("orders"), exact_sum(F.col("o_totalprice")).alias("amount"))
    )


@query("bucketed_join", ORDERS_CUSTOMERS)
def bucketed_join(spark, sf):
    """Both sides bucketed on (key, salt): joined without a shuffle, no bucket holds a hot key."""
    left, right = salt_sides(orders(spark, sf), customers(spark, sf), ["o_custkey"])
    keys, buckets, run = ["o_custkey", "salt"], shuffle_partitions(left), uuid4().hex
    fact = write_bucketed(left, f"orders_{run}", keys, buckets)
    dim = write_bucketed(right, f"customers_{run}", keys, buckets)
    joined = fact.join(dim.hint("merge"), keys).drop("salt")
    for name in (f"orders_{run}", f"customers_{run}"):
        drop_table(spark, name)  # the files stay, and the frame above reads them
    return joined


HUB_SQL = """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1
                              ELSE o_custkey END AS hub FROM orders)
SELECT hub, o_orderkey, c_mktsegment FROM o JOIN customer ON hub = c_custkey"""


def hub_orders(spark, sf):
    """Orders whose urgent part all belongs to one customer: 40% of the rows on one key."""
    hub = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit(1).cast("long"))
    return table(spark, sf, "orders").select(
        "o_orderkey", hub.otherwise(F.col("o_custkey")).alias("hub"))


def hubs(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("hub"), "c_mktsegment")


@query("join_skew_adaptive", HUB_SQL)
def join_skew_adaptive(spark, sf):
    """Plain shuffle join: adaptive execution splits the hot partition by map output."""
    return equi_join(hub_orders(spark, sf), hubs(spark, sf), "hub", strategy="merge")


@query("join_salted", HUB_SQL)
def join_salted(spark, sf):
    return salted_join(hub_orders(spark, sf), hubs(spark, sf), ["hub"])


@query("join_salted_parts", """
SELECT p_brand, count(*) AS lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""")
def join_salted_parts(spark, sf):
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_extendedprice")
    return salted_join(lines, parts, ["l_partkey"]).groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("lines"), exact_sum(F.col("l_extendedprice")).alias("price"))


@query("join_hot_key_split", HUB_SQL)
def join_hot_key_split(spark, sf):
    return hot_key_split_join(hub_orders(spark, sf), hubs(spark, sf), ["hub"])


HUB_LEFT_SQL = HUB_SQL.replace(
    "FROM o JOIN customer ON hub = c_custkey",
    "FROM o LEFT JOIN customer ON hub = c_custkey AND c_mktsegment <> 'BUILDING'")


def some_hubs(spark, sf):
    return hubs(spark, sf).filter("c_mktsegment <> 'BUILDING'")


@query("join_salted_left", HUB_LEFT_SQL)
def join_salted_left(spark, sf):
    return salted_join(hub_orders(spark, sf), some_hubs(spark, sf), ["hub"], "left")


@query("join_hot_key_split_left", HUB_LEFT_SQL)
def join_hot_key_split_left(spark, sf):
    return hot_key_split_join(hub_orders(spark, sf), some_hubs(spark, sf), ["hub"], "left")


WEIGHTS = [("1-URGENT", 1.5), ("2-HIGH", 1.2), ("3-MEDIUM", 1.0), ("5-LOW", 0.5)]
WEIGHT_SCHEMA = "o_orderpriority string, multiplier double"
WEIGHTS_SQL = """(VALUES ('1-URGENT', CAST(1.5 AS DOUBLE)), ('2-HIGH', CAST(1.2 AS DOUBLE)),
                         ('3-MEDIUM', CAST(1.0 AS DOUBLE)), ('5-LOW', CAST(0.5 AS DOUBLE)))
                 AS w(o_orderpriority, multiplier)"""


@query("join_weighted", f"""
SELECT o.o_orderkey, o.o_totalprice * w.multiplier AS weighted
FROM orders o JOIN {WEIGHTS_SQL} ON o.o_orderpriority = w.o_orderpriority""")
def join_weighted(spark, sf):
    weights = values_lookup(spark, WEIGHTS, WEIGHT_SCHEMA)
    joined = table(spark, sf, "orders").join(F.broadcast(weights), "o_orderpriority")
    return joined.select(
        "o_orderkey", (F.col("o_totalprice") * F.col("multiplier")).alias("weighted"))


@query("values_lookup", f"""
SELECT w.o_orderpriority, w.multiplier, count(*) AS orders
FROM orders o JOIN {WEIGHTS_SQL} ON o.o_orderpriority = w.o_orderpriority
GROUP BY w.o_orderpriority, w.multiplier""")
def values_lookup_query(spark, sf):
    weights = values_lookup(spark, WEIGHTS, WEIGHT_SCHEMA)
    counted = table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"))
    return counted.join(F.broadcast(weights), "o_orderpriority")


WIDE_SQL = f"""
WITH wide AS (
  SELECT r_name AS region, p_type AS category,
         CASE WHEN l_extendedprice * (1 - l_discount) > 60000 THEN 'high'
              WHEN l_extendedprice * (1 - l_discount) > 20000 THEN 'medium' ELSE 'low' END AS tier,
         {NET_SQL} AS net
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""


def wide_lines(spark, sf):
    """Lines with region, category, net amount and tier."""
    places = (
        table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("l_suppkey", F.col("r_name").alias("region"))
    )
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("category"))
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", net().alias("amount"))
    tier = first_match({"high": "amount > 60000", "medium": "amount > 20000"}, "low")
    return (
        equi_join(equi_join(lines, parts, "l_partkey", strategy="broadcast"),
                  places, "l_suppkey", strategy="broadcast")
        .select("region", "category", tier.alias("tier"), "amount")
    )


def _by(spark, sf, column):
    return wide_lines(spark, sf).groupBy(column).agg(
        F.count(F.lit(1)).alias("lines"), exact_sum(F.col("amount"), 4).alias("net_amount"))


def _by_sql(column: str) -> str:
    return WIDE_SQL + (f"SELECT {column}, count(*) AS lines, CAST(sum(net) AS DOUBLE) AS net_amount "
                       f"FROM wide GROUP BY {column}")


@query("diamond_region", _by_sql("region"))
def diamond_region(spark, sf):
    return _by(spark, sf, "region")


@query("diamond_tier", _by_sql("tier"))
def diamond_tier(spark, sf):
    return _by(spark, sf, "tier")


@query("diamond_category", _by_sql("category"))
def diamond_category(spark, sf):
    return _by(spark, sf, "category")


@query("diamond_one_pass", WIDE_SQL + """
SELECT 'region' AS dimension, region AS label, count(*) AS lines, CAST(sum(net) AS DOUBLE) AS net_amount
FROM wide GROUP BY region
UNION ALL SELECT 'tier', tier, count(*), CAST(sum(net) AS DOUBLE) FROM wide GROUP BY tier
UNION ALL SELECT 'category', category, count(*), CAST(sum(net) AS DOUBLE) FROM wide GROUP BY category""")
def diamond_one_pass(spark, sf):
    """All three aggregates from one pass over the wide table, nothing cached.

    Rows first collapse to one per combination of the three columns.
    """
    combined = wide_lines(spark, sf).groupBy("region", "tier", "category").agg(
        F.count(F.lit(1)).alias("n"),
        exact_sum(F.col("amount"), 4).cast("decimal(28,4)").alias("net"))
    labels = F.explode(F.create_map(
        F.lit("region"), "region", F.lit("tier"), "tier", F.lit("category"), "category"))
    return combined.select(labels.alias("dimension", "label"), "n", "net").groupBy(
        "dimension", "label"
    ).agg(F.sum("n").alias("lines"), F.sum("net").cast("double").alias("net_amount"))
