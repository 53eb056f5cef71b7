"""Sources, sinks, formats and the catalog."""

from __future__ import annotations

from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from etlkit.operators.layout import compacted, curve_layout
from etlkit.operators.reuse import measured, observed
from etlkit.queries.registry import query, table
from etlkit.settings import WarehouseSettings
from etlkit.sources.catalog import collect_stats, drop_table, register_external_table
from etlkit.sources.fanout import fan_out
from etlkit.sources.tables import (
    TableStore, range_rows, read_path, write_path,
)
from etlkit.workspace import new_path


def store(spark, base_path):
    return TableStore(spark, WarehouseSettings(format="parquet", base_path=base_path))


@query("read_table", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 100000""")
def read_table(spark, sf):
    return store(spark, sf).read_table(
        "orders.parquet", columns=["o_orderkey", "o_totalprice"],
        filter_condition="o_orderstatus = 'O' AND o_totalprice > 100000")


@query("sql_query", """
SELECT o_orderpriority, count(*) AS orders, max(o_totalprice) AS highest
FROM orders WHERE o_totalprice > 50000 GROUP BY o_orderpriority HAVING count(*) > 10""")
def sql_query(spark, sf):
    return store(spark, sf).execute_query(
        """SELECT o_orderpriority, count(*) AS orders, max(o_totalprice) AS highest
           FROM {orders} WHERE o_totalprice > :least
           GROUP BY o_orderpriority HAVING count(*) > :rows""",
        args={"least": 50000, "rows": 10}, views={"orders": table(spark, sf, "orders")})


@query("table_metadata", """
SELECT 'orders.parquet' AS table_id, count(*) AS num_rows, u.position, u.column_name, u.data_type, 'NULLABLE' AS mode
FROM orders, (VALUES (0, 'o_orderkey', 'bigint'), (1, 'o_custkey', 'bigint'), (2, 'o_orderstatus', 'string'),
     (3, 'o_totalprice', 'double'), (4, 'o_orderdate', 'timestamp_ntz'), (5, 'o_orderpriority', 'string'))
     AS u(position, column_name, data_type)
GROUP BY ALL""")
def table_metadata(spark, sf):
    return store(spark, sf).get_table_schema("orders.parquet").select(
        "table_id", "num_rows", "position", "column_name", "data_type", "mode")


@query("table_stats", " UNION ALL ".join(f"""
SELECT 'orders' AS table_name, '{c}' AS column_name, count(*) AS rows,
       count(*) - count({c}) AS null_count FROM orders"""
    for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
              "o_orderpriority")))
def table_stats(spark, sf):
    """Optimizer statistics of every column, without the estimates, which the tests compare."""
    name = f"stats_{uuid4().hex}"
    register_external_table(spark, name, f"{sf}/orders.parquet")
    try:
        stats = collect_stats(spark, [name])
    finally:
        drop_table(spark, name)
    return stats.select(F.lit("orders").alias("table_name"), "column_name", "rows", "null_count")


@query("json_roundtrip", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'explicit' AS schema FROM customer
UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'inferred' FROM customer""")
def json_roundtrip(spark, sf):
    customers, path = table(spark, sf, "customer"), new_path(spark, "json")
    write_path(customers, path, "json")
    explicit = read_path(spark, path, "json", customers.schema)
    inferred = read_path(spark, path, "json").select(
        *[F.col(f.name).cast(f.dataType) for f in customers.schema])
    return explicit.withColumn("schema", F.lit("explicit")).unionByName(
        inferred.withColumn("schema", F.lit("inferred")))


@query("external_table", "SELECT p_partkey, p_brand, p_size FROM part WHERE p_size > 25")
def external_table(spark, sf):
    name = f"part_{uuid4().hex}"
    register_external_table(spark, name, f"{sf}/part.parquet")
    found = spark.sql(f"SELECT p_partkey, p_brand, p_size FROM {name} WHERE p_size > 25")
    drop_table(spark, name)  # the files stay, and the frame above reads them
    return found


@query("partition_pruned_scan", """
SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderpriority = '2-HIGH'""")
def partition_pruned_scan(spark, sf):
    path = new_path(spark, "by-priority")
    write_path(table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"),
               path, partition_by=["o_orderpriority"])
    return spark.read.parquet(path).filter("o_orderpriority = '2-HIGH'")


@query("range_source", """
WITH days AS (SELECT unnest(generate_series(0, (SELECT date_diff('day', min(o_orderdate), max(o_orderdate)) FROM orders))) AS id),
     made AS (SELECT (SELECT min(o_orderdate)::DATE FROM orders) + id::INTEGER AS day FROM days),
     seen AS (SELECT o_orderdate::DATE AS day, count(*) AS n FROM orders GROUP BY 1)
SELECT day, coalesce(n, 0) AS orders FROM made LEFT JOIN seen USING (day)""")
def range_source(spark, sf):
    """A calendar generated over the range of the order dates, with the orders of each day."""
    orders = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))
    ends = orders.agg(F.min("day").alias("first"), F.max("day").alias("last")).first()
    if ends["first"] is None:
        return orders.withColumn("orders", F.lit(0).cast("long"))
    days = range_rows(spark, (ends["last"] - ends["first"]).days + 1,
                      day=F.date_add(F.lit(ends["first"]), F.col("id").cast("int")))
    seen = orders.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    return days.join(seen, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("orders"))


@query("write_modes", "SELECT * FROM customer")
def write_modes(spark, sf):
    """Overwrite, append, ignore and error in turn; the table ends as the whole input."""
    customers, target = table(spark, sf, "customer"), store(spark, new_path(spark, "modes"))
    in_debt = F.coalesce(F.col("c_acctbal") < 0, F.lit(False))
    target.write_table(customers, "people", mode="overwrite")
    target.write_table(customers.filter(in_debt), "people", mode="overwrite")
    target.write_table(customers.filter(~in_debt), "people", mode="append")
    target.write_table(customers, "people", mode="ignore")
    try:
        target.write_table(customers, "people", mode="error")
    except AnalysisException:
        return target.read_table("people")
    raise AssertionError("writing over an existing table in mode 'error' must fail")


@query("catalog_write_modes", "SELECT * FROM customer")
def catalog_write_modes(spark, sf):
    """The modes on a catalog table; ignore leaves the table that is there."""
    customers, name = table(spark, sf, "customer"), f"people_{uuid4().hex}"
    catalog, path = TableStore(spark, WarehouseSettings(format="table")), new_path(spark, "people")
    in_debt = F.coalesce(F.col("c_acctbal") < 0, F.lit(False))
    catalog.write_table(customers.filter(in_debt), name, mode="overwrite", path=path)
    catalog.write_table(customers.filter(~in_debt), name, mode="append", path=path)
    catalog.write_table(customers, name, mode="ignore", path=path)
    found = catalog.read_table(name)
    drop_table(spark, name)  # the files stay, and the frame above reads them
    return found


@query("write_daily_partitions", "SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM events")
def write_daily_partitions(spark, sf):
    events, target = table(spark, sf, "events"), store(spark, new_path(spark, "daily"))
    target.write_table(events, "events", partition_by="ts")
    stored = target.read_table("events")
    return stored.select(*events.columns, F.col("ts_partition_day").cast("string").alias("day"))


@query("write_clustered", """
SELECT l_suppkey, l_returnflag, count(*) AS lines, max(l_extendedprice) AS max_price
FROM lineitem GROUP BY l_suppkey, l_returnflag""")
def write_clustered(spark, sf):
    """Files sorted by supplier, each covering a narrow range of suppliers."""
    target = store(spark, new_path(spark, "clustered"))
    target.write_table(table(spark, sf, "lineitem"), "lines", cluster_by=["l_suppkey", "l_shipdate"])
    return target.read_table("lines").groupBy("l_suppkey", "l_returnflag").agg(
        F.count(F.lit(1)).alias("lines"), F.max("l_extendedprice").alias("max_price"))


@query("write_curve", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice >= 100000 AND o_totalprice < 120000""")
def write_curve(spark, sf):
    """Orders along a curve through customer and price, read by a range of prices."""
    path = new_path(spark, "curve")
    columns = ["o_custkey", "o_totalprice"]
    curve_layout(table(spark, sf, "orders").select("o_orderkey", *columns), columns, 16).write.parquet(path)
    return spark.read.parquet(path).filter("o_totalprice >= 100000 AND o_totalprice < 120000")


@query("write_with_metrics", """
SELECT count(*) AS stored_rows, count(*) AS observed_rows,
       count(*) FILTER (o_orderstatus = 'F') AS observed_final
FROM orders""")
def write_with_metrics(spark, sf):
    """Counts taken by the write itself, next to a recount of what was stored."""
    path = new_path(spark, "metrics")
    counted, seen = observed(
        table(spark, sf, "orders"), "orders written", F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("o_orderstatus") == "F").alias("final"))
    counted.write.parquet(path)
    return spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("stored_rows"),
        F.lit(measured(seen)["rows"]).cast("long").alias("observed_rows"),
        F.lit(measured(seen)["final"]).cast("long").alias("observed_final"))


@query("parquet_roundtrip", "SELECT * FROM customer")
def parquet_roundtrip(spark, sf):
    path = new_path(spark, "parquet")
    write_path(table(spark, sf, "customer"), path)
    return read_path(spark, path)


@query("fanout_write", """
SELECT 'suppliers' AS target, CAST(l_suppkey AS VARCHAR) AS label, count(*) AS lines
FROM lineitem WHERE l_quantity > 5 GROUP BY l_suppkey
UNION ALL SELECT 'flags', l_returnflag, count(*) FROM lineitem WHERE l_quantity > 5 GROUP BY l_returnflag""")
def fanout_write(spark, sf):
    """One costly aggregate, kept on the executors, feeds both destinations."""
    shared = table(spark, sf, "lineitem").filter("l_quantity > 5").groupBy(
        F.col("l_suppkey").cast("string").alias("suppliers"), F.col("l_returnflag").alias("flags")
    ).agg(F.count(F.lit(1)).alias("n"))

    def writer(column):
        def write(df):
            path = new_path(spark, f"fanout-{column}")
            counted = df.groupBy(F.col(column).alias("label")).agg(F.sum("n").alias("lines"))
            write_path(counted, path)
            return path
        return write

    paths = fan_out(shared, {c: writer(c) for c in ("suppliers", "flags")})
    first, second = [
        spark.read.parquet(path).select(F.lit(name).alias("target"), "label", "lines")
        for name, path in paths.items()
    ]
    return first.unionByName(second)


@query("format_roundtrip", " UNION ALL ".join(
    f"SELECT c_custkey, c_name, c_acctbal, c_mktsegment, '{f}' AS format FROM customer"
    for f in ("parquet", "orc", "csv", "json")))
def format_roundtrip(spark, sf):
    customers = table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    result = None
    for name in ("parquet", "orc", "csv", "json"):
        path = new_path(spark, name)
        write_path(customers, path, name)
        read = read_path(spark, path, name, customers.schema).withColumn("format", F.lit(name))
        result = read if result is None else result.unionByName(read)
    return result


@query("compact_files", "SELECT * FROM orders")
def compact_files(spark, sf):
    scattered, packed = new_path(spark, "scattered"), new_path(spark, "packed")
    pieces = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_path(table(spark, sf, "orders").repartition(pieces), scattered)
    write_path(compacted(spark.read.parquet(scattered), ["o_orderdate"]), packed)
    return spark.read.parquet(packed)
