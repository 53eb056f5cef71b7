"""Projections, column transforms, scalar functions and Python functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from etlkit.functions import udfs
from etlkit.operators.columns import (
    add_audit_columns, composite_key, create_date_dimensions, first_match,
    standardize_column_names, threshold_flags,
)
from etlkit.queries.registry import query, table

LOADED = "2024-01-15 08:30:00"


@query("project_narrow", "SELECT p_partkey, p_retailprice FROM part")
def project_narrow(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_retailprice")


@query("computed_columns", """
SELECT l_orderkey, l_partkey, l_linenumber,
       l_extendedprice / 1000 AS price_thousands,
       l_extendedprice * l_discount AS discount_amount,
       l_extendedprice - l_extendedprice * l_discount AS net_amount,
       l_quantity * 0.1 AS reserve_quantity
FROM lineitem""")
def computed_columns(spark, sf):
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        (price / 1000).alias("price_thousands"),
        (price * discount).alias("discount_amount"),
        (price - price * discount).alias("net_amount"),
        (F.col("l_quantity") * 0.1).alias("reserve_quantity"),
    )


@query("standardize_names", """
SELECT p_partkey AS part_key, p_name AS part_name, p_brand AS brand_code, p_type AS type,
       p_size AS size_cm, p_retailprice AS retail_price_usd
FROM part""")
def standardize_names(spark, sf):
    messy = table(spark, sf, "part").toDF(
        "Part Key", "Part-Name", "Brand (Code)", "__Type__", "Size  cm", "Retail.Price $ USD")
    return standardize_column_names(messy)


@query("standardize_names_camel", """
SELECT p_partkey AS partKey, p_name AS partName, p_brand AS brandCode, p_type AS type,
       p_size AS sizeCm, p_retailprice AS retailPriceUsd
FROM part""")
def standardize_names_camel(spark, sf):
    messy = table(spark, sf, "part").toDF(
        "Part Key", "Part-Name", "Brand (Code)", "__Type__", "Size  cm", "Retail.Price $ USD")
    return standardize_column_names(messy, "camelCase")


@query("audit_columns", f"""
SELECT *, TIMESTAMP '{LOADED}' AS load_timestamp, 'pyspark_etl' AS source_system,
       'batch_load' AS load_id
FROM customer""")
def audit_columns(spark, sf):
    audited = add_audit_columns(table(spark, sf, "customer"), LOADED)
    return audited.withColumn("load_timestamp", F.col("load_timestamp").cast("timestamp_ntz"))


@query("date_dimensions", """
SELECT o_orderkey, o_orderdate,
       CAST(year(o_orderdate) AS INTEGER) AS o_orderdate_year,
       CAST(month(o_orderdate) AS INTEGER) AS o_orderdate_month,
       CAST(day(o_orderdate) AS INTEGER) AS o_orderdate_day,
       CAST(quarter(o_orderdate) AS INTEGER) AS o_orderdate_quarter,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate_formatted
FROM orders""")
def date_dimensions(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return create_date_dimensions(orders, "o_orderdate", quarter=True)


@query("tier_columns", """
SELECT l_orderkey, l_partkey, l_linenumber,
       CASE WHEN l_extendedprice > 60000 THEN 'premium' WHEN l_extendedprice > 20000 THEN 'standard'
            ELSE 'basic' END AS price_tier,
       CASE WHEN l_quantity >= 40 THEN 'bulk' WHEN l_quantity >= 10 THEN 'case' ELSE 'unit' END
            AS quantity_group
FROM lineitem""")
def tier_columns(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        first_match({"premium": "l_extendedprice > 60000", "standard": "l_extendedprice > 20000"},
                    "basic").alias("price_tier"),
        first_match({"bulk": "l_quantity >= 40", "case": "l_quantity >= 10"}, "unit")
        .alias("quantity_group"),
    )


@query("composite_key", """
SELECT o_orderkey, o_orderstatus || '_' || CAST(o_custkey AS VARCHAR) AS status_customer
FROM orders""")
def composite_key_query(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", composite_key("o_orderstatus", "o_custkey").alias("status_customer"))


@query("threshold_flags", """
SELECT o_orderkey,
       CAST(o_totalprice > 50000 AS INTEGER) AS above_50000,
       CAST(o_totalprice > 100000 AS INTEGER) AS above_100000,
       CAST(o_totalprice > 200000 AS INTEGER) AS above_200000,
       CAST(o_totalprice > 400000 AS INTEGER) AS above_400000
FROM orders""")
def threshold_flags_query(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return threshold_flags(orders, "o_totalprice", [50000, 100000, 200000, 400000]).drop(
        "o_totalprice")


@query("scalar_strings", r"""
SELECT c_custkey, upper(c_name) AS upper_name, lower(c_mktsegment) AS lower_segment,
       trim('  ' || c_mktsegment || ' ') AS trimmed, c_name || '/' || c_mktsegment AS joined,
       regexp_replace(c_name, '[^a-zA-Z0-9]', '_', 'g') AS safe_name
FROM customer""")
def scalar_strings(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.upper("c_name").alias("upper_name"),
        F.lower("c_mktsegment").alias("lower_segment"),
        F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("trimmed"),
        F.concat("c_name", F.lit("/"), "c_mktsegment").alias("joined"),
        F.regexp_replace("c_name", r"[^a-zA-Z0-9]", "_").alias("safe_name"),
    )


@query("scalar_dates", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
       CAST(day(o_orderdate) AS INTEGER) AS d, CAST(quarter(o_orderdate) AS INTEGER) AS q,
       strftime(o_orderdate, '%Y/%m') AS year_month,
       strftime(CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE), '%d.%m.%Y') AS reparsed
FROM orders""")
def scalar_dates(spark, sf):
    date = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.year(date).alias("y"), F.month(date).alias("m"),
        F.dayofmonth(date).alias("d"), F.quarter(date).alias("q"),
        F.date_format(date, "yyyy/MM").alias("year_month"),
        F.date_format(F.to_date(F.date_format(date, "yyyy-MM-dd")), "dd.MM.yyyy").alias("reparsed"),
    )


@query("scalar_math", """
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity + 1 AS plus_one, l_quantity - l_tax AS minus_tax,
       l_extendedprice * l_tax AS tax_amount, l_extendedprice / l_quantity AS unit_price,
       CAST(floor(l_quantity) AS INTEGER) AS whole_quantity, CAST(l_linenumber AS DOUBLE) AS line_double,
       CAST(l_orderkey AS VARCHAR) AS order_text
FROM lineitem""")
def scalar_math(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        (F.col("l_quantity") + 1).alias("plus_one"),
        (F.col("l_quantity") - F.col("l_tax")).alias("minus_tax"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("tax_amount"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_quantity").cast("int").alias("whole_quantity"),
        F.col("l_linenumber").cast("double").alias("line_double"),
        F.col("l_orderkey").cast("string").alias("order_text"),
    )


@query("scalar_nulls", """
SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') IS NULL AS unspecified,
       coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED'), 'none') AS priority,
       o_totalprice < 1000 OR nullif(o_orderstatus, 'P') IS NULL AS to_check
FROM orders""")
def scalar_nulls(spark, sf):
    priority = F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED"))
    status = F.nullif("o_orderstatus", F.lit("P"))
    return table(spark, sf, "orders").select(
        "o_orderkey", priority.isNull().alias("unspecified"),
        F.coalesce(priority, F.lit("none")).alias("priority"),
        ((F.col("o_totalprice") < 1000) | status.isNull()).alias("to_check"),
    )


@query("udf_upper", "SELECT c_custkey, upper(c_mktsegment) AS segment FROM customer")
def udf_upper(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", udfs.upper_udf("c_mktsegment").alias("segment"))


SIZES = {"high": 300000.0, "medium": 100000.0}
SIZE_SQL = """CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'medium'
                   ELSE 'low' END"""


@query("udf_category", f"SELECT o_orderkey, {SIZE_SQL} AS category FROM orders")
def udf_category(spark, sf):
    category = udfs.size_category_udf(SIZES, "low")
    return table(spark, sf, "orders").select(
        "o_orderkey", category("o_totalprice").alias("category"))


@query("udf_key", """
SELECT o_orderkey, o_orderstatus || '_' || CAST(o_custkey AS VARCHAR) AS status_customer
FROM orders""")
def udf_key(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", udfs.key_udf("o_orderstatus", "o_custkey").alias("status_customer"))


@query("native_vs_udf", """
SELECT count(*) AS orders, count(*) AS same_upper, count(*) AS same_category, count(*) AS same_key
FROM orders""")
def native_vs_udf(spark, sf):
    orders = table(spark, sf, "orders")
    price = F.col("o_totalprice")
    both = orders.select(
        udfs.upper_udf("o_orderpriority").alias("u1"), F.upper("o_orderpriority").alias("n1"),
        udfs.size_category_udf(SIZES, "low")(price).alias("u2"),
        udfs.size_category(price, SIZES, "low").alias("n2"),
        udfs.key_udf("o_orderstatus", "o_custkey").alias("u3"),
        udfs.key("o_orderstatus", "o_custkey").alias("n3"),
    )
    return both.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.expr("u1 <=> n1")).alias("same_upper"),
        F.count_if(F.expr("u2 <=> n2")).alias("same_category"),
        F.count_if(F.expr("u3 <=> n3")).alias("same_key"),
    )


@query("pandas_udf_net", """
SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem""")
def pandas_udf_net(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        udfs.net_amount("l_extendedprice", "l_discount").alias("net"))


@query("udf_broadcast_lookup", """
SELECT c_custkey, c_nationkey, coalesce(n_name, 'unknown') AS nation
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) ON c_nationkey = n_nationkey""")
def udf_broadcast_lookup(spark, sf):
    nations = table(spark, sf, "nation").filter("n_regionkey <> 0")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return udfs.broadcast_lookup(
        customers, "c_nationkey", nations, "n_nationkey", "n_name", "nation")
