"""Filters, rules, sorting and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from etlkit.operators.metrics import exact_sum, top_k, top_keys
from etlkit.operators.rules import apply_business_rules
from etlkit.queries.registry import query, table


@query("filter_compare", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
WHERE o_totalprice > 250000 AND o_totalprice < 400000 AND o_orderstatus = 'F'""")
def filter_compare(spark, sf):
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").filter(
        (price > 250000) & (price < 400000) & (F.col("o_orderstatus") == "F")
    ).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("filter_sql", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderpriority <> '5-LOW'""")
def filter_sql(spark, sf):
    return table(spark, sf, "orders").filter(
        "o_orderdate >= timestamp_ntz'1997-01-01' AND o_orderpriority <> '5-LOW'"
    ).select("o_orderkey", "o_orderdate")


@query("filter_isin", """
SELECT l_orderkey, l_partkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag IN ('A', 'R')""")
def filter_isin(spark, sf):
    return table(spark, sf, "lineitem").filter(F.col("l_returnflag").isin("A", "R")).select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")


@query("having", """
SELECT l_suppkey, count(*) AS lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM lineitem GROUP BY l_suppkey HAVING sum(CAST(l_extendedprice AS DECIMAL(18,2))) > 20000000""")
def having(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("lines"), exact_sum(F.col("l_extendedprice")).alias("revenue")
    ).filter("revenue > 20000000")


@query("filter_derived", """
SELECT p_partkey, p_retailprice * 1.2 AS gross FROM part
WHERE p_retailprice * 1.2 > 1150 AND p_retailprice > 900""")
def filter_derived(spark, sf):
    # Only the condition on the stored column reaches the file reader.
    return (
        table(spark, sf, "part").filter("p_retailprice > 900")
        .select("p_partkey", (F.col("p_retailprice") * 1.2).alias("gross"))
        .filter("gross > 1150")
    )


@query("filter_constant", """
SELECT c_custkey, c_name FROM customer WHERE 1 = 1""")
def filter_constant(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    nobody = customers.filter(F.lit(1) == F.lit(2))
    return customers.filter(F.lit(1) == F.lit(1)).unionAll(nobody)


@query("filter_random")
def filter_random(spark, sf):
    drawn = table(spark, sf, "part").select(
        "p_partkey", "p_retailprice", (F.rand(42) * F.col("p_retailprice")).alias("drawn"))
    return drawn.filter("drawn > 500")


@query("filter_join_pushdown", """
SELECT o_orderkey, c_mktsegment, o_totalprice
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_totalprice > 300000 AND c_acctbal > 0""")
def filter_join_pushdown(spark, sf):
    joined = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.filter("o_totalprice > 300000 AND c_acctbal > 0").select(
        "o_orderkey", "c_mktsegment", "o_totalprice")


RULES = {
    "open_or_final": {"type": "filter", "condition": "o_orderstatus <> 'P'"},
    "net": {"type": "derive_column", "column": "net", "expression": "o_totalprice * 0.9"},
    "size": {"type": "categorize", "column": "net", "categories": {
        "large": "net >= 300000", "medium": "net >= 100000"}},
}


@query("rules_all", """
SELECT o_orderkey, o_orderstatus, o_totalprice * 0.9 AS net,
       CASE WHEN o_totalprice * 0.9 >= 300000 THEN 'large' WHEN o_totalprice * 0.9 >= 100000 THEN 'medium'
            ELSE 'Other' END AS net_category
FROM orders WHERE o_orderstatus <> 'P'""")
def rules_all(spark, sf):
    return apply_business_rules(table(spark, sf, "orders"), RULES).select(
        "o_orderkey", "o_orderstatus", "net", "net_category")


@query("rules_categorize", """
SELECT p_partkey, p_size, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium'
       ELSE 'Other' END AS p_size_category
FROM part""")
def rules_categorize(spark, sf):
    rules = {"size": {"type": "categorize", "column": "p_size", "categories": {
        "small": F.col("p_size") < 10, "medium": "p_size < 30"}}}
    return apply_business_rules(
        table(spark, sf, "part").select("p_partkey", "p_size"), rules)


@query("sort_global", """
SELECT o_orderkey, o_orderstatus, o_orderdate, o_totalprice FROM orders
ORDER BY o_orderstatus, o_orderdate DESC, o_orderkey""")
def sort_global(spark, sf):
    # The unique last key lets the range shuffle split a status that holds many rows.
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice"
    ).orderBy("o_orderstatus", F.col("o_orderdate").desc(), "o_orderkey")


@query("top_k", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def top_orders(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return top_k(orders, 100, F.col("o_totalprice").desc(), "o_orderkey")


@query("hot_keys", """
SELECT l_partkey, count(*) AS rows FROM lineitem GROUP BY l_partkey
ORDER BY rows DESC, l_partkey LIMIT 10""")
def hot_parts(spark, sf):
    return top_keys(table(spark, sf, "lineitem"), ["l_partkey"], 10)


@query("limit_rows")
def limit_rows(spark, sf):
    return table(spark, sf, "orders").limit(1000)


@query("sample_rows")
def sample_rows(spark, sf):
    return table(spark, sf, "orders").sample(0.1, seed=42)
