"""Whole loads, incremental loads, change data, lineage cuts and run records."""

from __future__ import annotations

from pyspark.sql import functions as F

from etlkit.operators.reuse import iterate
from etlkit.plans.etl import EtlJob
from etlkit.plans.incremental import (
    apply_changes, compact_partition, incremental_load, merge_into_partitions, overwrite_partitions, read_evolving,
)
from etlkit.plans.run_log import SCHEMA, changed_strategies, record_run
from etlkit.queries.joins import flagship_revenue
from etlkit.queries.registry import query, table
from etlkit.queries.storage import store
from etlkit.sources.layered import LayeredTable
from etlkit.sources.versions import VersionedTable
from etlkit.workspace import new_path

LOADED = "2024-01-15 08:30:00"

ETL_SQL = f"""
SELECT o_orderkey AS id, o_custkey AS customer_key, o_totalprice AS total_price,
       o_orderdate AS order_date, o_orderpriority AS priority, o_orderstatus AS status,
       TIMESTAMP '{LOADED}' AS load_timestamp, 'pyspark_etl' AS source_system,
       'batch_load' AS load_id,
       CAST(year(o_orderdate) AS INTEGER) AS order_date_year,
       CAST(month(o_orderdate) AS INTEGER) AS order_date_month,
       CAST(day(o_orderdate) AS INTEGER) AS order_date_day,
       strftime(o_orderdate, '%Y-%m-%d') AS order_date_formatted
FROM orders"""


def raw_orders(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("Customer Key"),
        F.col("o_totalprice").alias("Total-Price"), F.col("o_orderdate").alias("Order Date"),
        F.col("o_orderpriority").alias("Priority"), F.col("o_orderstatus").alias("Status"))


def _plain_time(df):
    return df.withColumn("load_timestamp", F.col("load_timestamp").cast("timestamp_ntz"))


@query("etl_transform", ETL_SQL)
def etl_transform(spark, sf):
    job = EtlJob(store(spark, sf), load_timestamp=LOADED)
    return _plain_time(job.transform_data(raw_orders(spark, sf)))


@query("etl_run", ETL_SQL + " WHERE o_orderstatus <> 'P'")
def etl_run(spark, sf):
    """Source table to target table through the whole job, then read back."""
    target = store(spark, new_path(spark, "etl"))
    target.write_table(raw_orders(spark, sf), "raw_orders")
    EtlJob(target, load_timestamp=LOADED).run(
        "raw_orders", "clean_orders", "Status <> 'P'", partition_by="load_timestamp")
    return _plain_time(target.read_table("clean_orders")).drop("load_timestamp_partition_day")


@query("incremental_load", """
SELECT *, CASE WHEN o_orderstatus <> 'P' THEN date_trunc('month', o_orderdate)::TIMESTAMP END AS closed_month FROM orders""")
def incremental_load_query(spark, sf):
    """Loads from a source that also grows at the last month loaded and in rows without one.

    The last load sees the whole source; each takes what is not loaded yet.
    """
    base = new_path(spark, "incremental")
    month = F.when(F.col("o_orderstatus") != "P", F.date_trunc("month", "o_orderdate").cast("timestamp_ntz"))
    source = table(spark, sf, "orders").withColumn("closed_month", month)
    urgent = F.col("o_orderpriority") == "1-URGENT"
    seen = [F.col("closed_month") < F.lit(until).cast("timestamp_ntz") for until in ("1997-01-01", "1999-07-01")]
    at = F.col("closed_month") == F.lit("1997-01-01").cast("timestamp_ntz")
    without = F.col("closed_month").isNull()
    for visible in (seen[0] | ((at | without) & urgent), seen[1] | (without & urgent), F.lit(True)):
        incremental_load(source.filter(visible), f"{base}/orders", f"{base}/state", "closed_month")
    return spark.read.parquet(f"{base}/orders").select(*source.columns)


def customer_changes(customers):
    """Updates for customers in debt, some of whom change their segment, then deletes
    for one segment, then new customers."""
    def change(df, op, at):
        return df.withColumns({"op": F.lit(op), "changed_at": F.lit(at)})

    debt = change(customers.filter("c_acctbal < 0"), "U", 1)
    moved = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("MACHINERY")).otherwise(F.col("c_mktsegment"))
    raised = debt.withColumns({"c_acctbal": F.col("c_acctbal") + 1000, "c_mktsegment": moved})
    furniture = change(customers.filter("c_mktsegment = 'FURNITURE'"), "D", 2)
    added = change(customers.filter("c_nationkey = 3").withColumn(
        "c_custkey", -F.col("c_custkey") - 1), "I", 3)
    return raised.unionByName(furniture).unionByName(added)


CHANGES_SQL = """
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_acctbal < 0 THEN c_acctbal + 1000 ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_acctbal < 0 AND c_mktsegment = 'BUILDING' THEN 'MACHINERY' ELSE c_mktsegment END AS c_mktsegment
FROM customer WHERE c_mktsegment <> 'FURNITURE'
UNION ALL SELECT -c_custkey - 1, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer WHERE c_nationkey = 3"""


@query("apply_changes", CHANGES_SQL)
def apply_changes_query(spark, sf):
    customers = table(spark, sf, "customer")
    return apply_changes(customers, customer_changes(customers), ["c_custkey"], ["changed_at"])


@query("merge_partitions", CHANGES_SQL)
def merge_partitions(spark, sf):
    """The same changes applied to a stored table, rewriting only touched segments."""
    customers, path = table(spark, sf, "customer"), new_path(spark, "merge-customers")
    overwrite_partitions(customers, path, ["c_mktsegment"])
    merge_into_partitions(spark, path, customer_changes(customers), ["c_custkey"], ["changed_at"],
                          "c_mktsegment")
    return spark.read.parquet(path).select(*customers.columns)


@query("layered_merge", CHANGES_SQL)
def layered_merge(spark, sf):
    """The same changes to a table in layers: two loads, one of them written twice, folded in two steps."""
    customers, path = table(spark, sf, "customer"), new_path(spark, "layered-customers")
    log = LayeredTable(spark, path, customers.schema, ["c_custkey"], "c_mktsegment", "op")
    changes = customer_changes(customers)
    log.write_delta(customers.withColumn("op", F.lit(None).cast("string")), 0)
    for _ in range(2):
        log.write_delta(changes, 1, ["changed_at"])
    log.compact()
    log.compact(newest=True)
    log.vacuum()
    return log.read()


@query("layered_partitions", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '12' ELSE strftime(o_orderdate, '%m') END AS month,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
FROM orders WHERE o_orderstatus <> 'P'""")
def layered_partitions(spark, sf):
    """Orders by month, as text such as 01; filled ones change and move to December, pending ones go.
    Then one month's files are put together, and a load stays that is not folded yet."""
    orders, path = table(spark, sf, "orders"), new_path(spark, "layered-orders")
    rows = orders.select("o_orderkey", F.date_format("o_orderdate", "MM").alias("month"), "o_totalprice", F.lit(None).cast("string").alias("op"))
    log = LayeredTable(spark, path, rows.drop("op").schema, ["o_orderkey"], "month", "op")
    log.merge(rows)
    status = orders.select("o_orderkey", "o_orderstatus", (F.col("o_totalprice") + 1).alias("o_totalprice"))
    log.merge(status.filter("o_orderstatus = 'F'").withColumns({"month": F.lit("12"), "op": F.lit("U")}))
    log.rewrite_partition("12")
    log.write_delta(status.filter("o_orderstatus = 'P'").withColumns({"month": F.lit("01"), "op": F.lit("D")}), 2)
    log.vacuum()
    return log.read()


@query("partition_overwrite", """
SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
       THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice
FROM orders""")
def partition_overwrite(spark, sf):
    """Replace two priorities, twice: the others stay and the repeat changes nothing."""
    path = new_path(spark, "overwrite")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    overwrite_partitions(orders, path, ["o_orderpriority"])
    doubled = orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).withColumn(
        "o_totalprice", F.col("o_totalprice") * 2)
    for _ in range(2):
        overwrite_partitions(doubled, path, ["o_orderpriority"])
    return spark.read.parquet(path).select(*orders.columns)


@query("compact_partition", "SELECT o_orderkey, o_orderpriority FROM orders")
def compact_partition_query(spark, sf):
    """One priority, written in many small files, is rewritten in place."""
    path = new_path(spark, "compact-one")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    orders.repartition(8).write.partitionBy("o_orderpriority").parquet(path)
    compact_partition(spark, path, "o_orderpriority", "2-HIGH")
    return spark.read.parquet(path).select(*orders.columns)


@query("schema_evolution", """
SELECT p_partkey, p_name, CASE WHEN p_size >= 25 THEN p_retailprice END AS p_retailprice FROM part""")
def schema_evolution(spark, sf):
    """Files of small parts lack the price column that files of large parts have."""
    path, parts = new_path(spark, "evolving"), table(spark, sf, "part")
    parts.filter("p_size < 25 OR p_size IS NULL").select("p_partkey", "p_name").write.parquet(f"{path}/version=1")
    parts.filter("p_size >= 25").select("p_partkey", "p_name", "p_retailprice").write.parquet(
        f"{path}/version=2")
    return read_evolving(spark, path).select("p_partkey", "p_name", "p_retailprice")


@query("schema_versions", """
SELECT p_partkey, p_size AS p_dimension, CASE WHEN p_size >= 20 THEN p_retailprice END AS p_retailprice,
       CASE WHEN p_size >= 40 THEN p_brand ELSE 'none' END AS p_brand FROM part""")
def schema_versions(spark, sf):
    """Parts loaded in three versions: keys widened, size renamed, price and brand added, name dropped."""
    parts = table(spark, sf, "part")
    dimension = F.col("p_size").alias("p_dimension")
    small, middle = "coalesce(p_size, 0) < 20", "p_size >= 20 AND p_size < 40"
    versioned = VersionedTable(spark, new_path(spark, "versions"))
    steps = [
        (parts.filter(small).select(F.col("p_partkey").cast("int"), "p_name", "p_size"), {}),
        (parts.filter(middle).select("p_partkey", "p_name", dimension, "p_retailprice"),
         {"renamed": {"p_dimension": "p_size"}}),
        (parts.filter("p_size >= 40").select("p_partkey", dimension, "p_retailprice", "p_brand"),
         {"defaults": {"p_brand": "none"}}),
    ]
    for rows, changes in steps:
        versioned.declare(rows.schema, **changes)
        versioned.append(rows)
    return versioned.read()


@query("iterative_checkpoint", """
SELECT o_orderkey, CAST(o_totalprice > 50000 AS INTEGER) + CAST(o_totalprice > 100000 AS INTEGER)
       + CAST(o_totalprice > 150000 AS INTEGER) + CAST(o_totalprice > 200000 AS INTEGER)
       + CAST(o_totalprice > 250000 AS INTEGER) AS level
FROM orders""")
def iterative_checkpoint(spark, sf):
    start = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.lit(0).alias("level"))

    def raise_level(df, i):
        above = F.col("o_totalprice") > 50000 * i
        return df.withColumn("level", F.col("level") + above.cast("int"))

    return iterate(start, raise_level, rounds=5, checkpoint_every=2).drop("o_totalprice")


@query("run_metadata", """
SELECT 'flagship_revenue' AS query, least(count(DISTINCT p_brand), 20) AS rows, 'BroadcastHashJoin' AS join_operators
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity > 10""")
def run_metadata(spark, sf):
    """Runs the revenue report, stores it, and records rows and join operators of the plan that ran."""
    base = new_path(spark, "runs")
    record_run(spark, f"{base}/log", "flagship_revenue", flagship_revenue(spark, sf)).write.parquet(f"{base}/report")
    return spark.read.schema(SCHEMA).parquet(f"{base}/log").select("query", "rows", "join_operators")


@query("changed_strategies", """
SELECT 'orders_by_customer' AS query, 'SortMergeJoin' AS previous, 'BroadcastHashJoin' AS latest
WHERE (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey) > 0""")
def changed_strategies_query(spark, sf):
    """The same report run with two join strategies, and one that did not change."""
    log = f"{new_path(spark, 'runs')}/log"
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    for hint in ("merge", "broadcast"):
        joined = orders.join(customers.hint(hint), F.col("o_custkey") == F.col("c_custkey"))
        record_run(spark, log, "orders_by_customer", joined.select("o_orderkey", "c_mktsegment"))
        record_run(spark, log, "orders_by_status", orders.groupBy("o_orderstatus").count())
    return changed_strategies(spark, log)
