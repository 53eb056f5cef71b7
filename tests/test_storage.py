import glob
import os

import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from etlkit.operators import layout
from etlkit.operators.layout import (
    BALANCED_WRITE, balanced, colocate, compacted, partition_summary, range_layout, skew_profile,
    stored_bytes,
)
from etlkit.operators.reuse import (
    STORAGE_LEVELS, is_cached, iterate, observed, persisted, preview, staged, storage_level,
)
from etlkit.session import options
from etlkit.settings import WarehouseSettings
from etlkit.sources.catalog import (
    collect_stats, drop_table, list_tables, register_external_table,
)
from etlkit.sources.fanout import fan_out
from etlkit.sources.tables import (
    TableStore, daily_layout, describe_columns, read_path, resolve_table_id, values_lookup,
    write_path,
)
from etlkit.workspace import new_path, shared_root


@pytest.mark.parametrize("table_id, expected", [
    ("t", "p.d.t"), ("x.t", "p.x.t"), ("q.x.t", "q.x.t"), ("a.b.c.t", "a.b.c.t")])
def test_table_ids(table_id, expected):
    assert resolve_table_id(table_id, "p", "d") == expected


def test_table_ids_without_defaults():
    assert resolve_table_id("t") == "t" and resolve_table_id("d.t", "", "x") == "d.t"


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, WarehouseSettings(
        format="parquet", base_path=str(tmp_path), project="p", dataset="d"))


def test_modes(store, tables):
    nation = tables("nation")
    assert store.write_table(nation, "n") == {"table": "p.d.n", "mode": "overwrite", "rows": 25}
    assert store.write_table(nation, "n", mode="append")["rows"] == 25
    assert store.write_table(nation, "n", mode="ignore")["rows"] == 0
    assert store.read_table("n").count() == 50
    with pytest.raises(AnalysisException):
        store.write_table(nation, "n", mode="error")
    with pytest.raises(ValueError, match="unknown write mode"):
        store.write_table(nation, "n", mode="upsert")


def test_read_filters_on_a_column_it_does_not_return(store, tables):
    store.write_table(tables("nation"), "n")
    read = store.read_table("n", ["n_name"], "n_regionkey = 1")
    assert read.columns == ["n_name"] and read.count() == 5


def test_empty_write_keeps_the_schema(store, tables):
    store.write_table(tables("nation").limit(0), "empty")
    assert store.read_table("empty").columns == tables("nation").columns


def test_daily_and_clustered_write(store, tables, tmp_path):
    events = tables("events")
    store.write_table(events, "e", partition_by="ts", cluster_by=["user_id"])
    days = glob.glob(f"{tmp_path}/p/d/e/ts_partition_day=*")
    assert len(days) == events.select(F.to_date("ts")).distinct().count()
    stored = store.read_table("e")
    assert stored.drop("ts_partition_day").exceptAll(events).count() == 0
    for path in glob.glob(f"{tmp_path}/p/d/e/*/*.parquet"):
        users = pq.read_table(path, columns=["user_id"])["user_id"].to_pylist()
        assert users == sorted(users)


def test_catalog_tables(spark, tables):
    store = TableStore(spark, WarehouseSettings(format="table"))
    store.write_table(tables("region"), "regions_t")
    assert "regions_t" in list_tables(spark)
    assert store.execute_query("SELECT count(*) AS n FROM regions_t").first().n == 5
    schema = store.get_table_schema("regions_t").collect()
    assert [(r.column_name, r.data_type, r.num_rows) for r in schema] == [
        ("r_regionkey", "int", 5), ("r_name", "string", 5)]
    assert schema[0].created is not None
    drop_table(spark, "regions_t")
    drop_table(spark, "regions_t")
    assert "regions_t" not in list_tables(spark)


def test_file_table_facts(store, tables):
    store.write_table(tables("nation"), "n")
    rows = store.get_table_schema("n").collect()
    assert {(r.table_id, r.num_rows) for r in rows} == {("p.d.n", 25)}
    assert rows[0].num_bytes > 500 and rows[0].modified.startswith("20")
    store.write_table(tables("region"), "other.d.r")
    assert store.get_table_schema("other.d.r").first().table_id == "other.d.r"


def test_connector_options(spark):
    store = TableStore(spark, WarehouseSettings(format="warehouse", project="p", temp_bucket="b"))
    assert store._connector_options(table="p.d.t", partitionField=None) == {
        "parentProject": "p", "temporaryGcsBucket": "b", "table": "p.d.t"}
    with pytest.raises(ValueError, match="base_path"):
        TableStore(spark, WarehouseSettings(format="orc"))


def test_query_binds_arguments(store, tables):
    df = store.execute_query("SELECT * FROM {n} WHERE n_nationkey < :k", {"k": 3},
                             {"n": tables("nation")})
    assert df.count() == 3


@pytest.mark.parametrize("format", ["parquet", "orc", "json", "csv"])
def test_formats(spark, tables, tmp_path, format):
    customers = tables("customer")
    assert write_path(customers, f"{tmp_path}/x", format)["rows"] == 150
    back = read_path(spark, f"{tmp_path}/x", format, customers.schema)
    assert back.exceptAll(customers).count() == 0 and back.count() == 150


def test_partitioned_external_table_sees_its_partitions(spark, tables, tmp_path):
    write_path(tables("nation"), f"{tmp_path}/n", partition_by=["n_regionkey"])
    df = register_external_table(spark, "ext_n", f"{tmp_path}/n", partitioned=True)
    assert df.count() == 25 and df.filter("n_regionkey = 2").count() == 5
    drop_table(spark, "ext_n")
    assert os.path.exists(f"{tmp_path}/n")


def test_statistics(spark, sf):
    register_external_table(spark, "stat_n", f"{sf}/nation.parquet")
    rows = {r.column_name: r for r in collect_stats(spark, ["stat_n"]).collect()}
    assert rows["n_regionkey"].rows == 25 and rows["n_regionkey"].null_count == 0
    assert rows["n_name"].min is None
    drop_table(spark, "stat_n")


def test_values_lookup_types(spark):
    df = values_lookup(spark, [(1, 0.5, "it's"), (2, None, "b")], "i int, d double, s string")
    assert df.dtypes == [("i", "int"), ("d", "double"), ("s", "string")]
    assert [tuple(r) for r in df.collect()] == [(1, 0.5, "it's"), (2, None, "b")]


def test_hot_partition_value_is_split_on_write(spark, tmp_path):
    """A day holding most rows is written by several tasks; days placed elsewhere are not."""
    many = f"{tmp_path}/many"
    spark.range(0, 200000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 5).alias("day"),
        F.xxhash64("id").alias("v")).write.parquet(many)
    with options(spark, {**BALANCED_WRITE, "spark.sql.files.openCostInBytes": "128MB",
                         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB"}):
        balanced(spark.read.parquet(many), ["day"]).write.partitionBy("day").parquet(
            f"{tmp_path}/out")
    files = {d: len(glob.glob(f"{tmp_path}/out/day={d}/*.parquet")) for d in range(5)}
    assert files[0] >= 4 and min(files.values()) <= 2
    assert spark.read.parquet(f"{tmp_path}/out").count() == 200000


def test_range_layout_splits_copies_of_one_row(spark):
    copies = spark.range(0, 8000, 1, 8).select(F.lit(7).alias("k"), F.lit("same").alias("v"))
    laid = range_layout(copies, ["k"], 8)
    sizes = [r["rows"] for r in partition_summary(laid, "x").collect()]
    assert sum(sizes) == 8000 and len(sizes) >= 6 and laid.columns == ["k", "v"]


def test_colocate_spreads_only_hot_keys(spark):
    df = spark.range(0, 9000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"))
    placed = colocate(df, ["k"], share=0.1)
    assert placed.groupBy("k").agg(F.count_distinct("salt").alias("n")).filter(
        "n > 1").collect()[0].k == 0
    assert placed.filter("k > 0 AND salt <> 0").count() == 0


def test_compaction(spark, tables, tmp_path):
    tables("orders").repartition(20).write.parquet(f"{tmp_path}/small")
    small = spark.read.parquet(f"{tmp_path}/small")
    total = sum(os.path.getsize(f) for f in glob.glob(f"{tmp_path}/small/*.parquet"))
    assert stored_bytes(small) == total
    compacted(small).write.parquet(f"{tmp_path}/one")
    assert len(glob.glob(f"{tmp_path}/one/*.parquet")) == 1
    compacted(small, ["o_orderdate"], total // 4).write.parquet(f"{tmp_path}/four")
    assert 3 <= len(glob.glob(f"{tmp_path}/four/*.parquet")) <= 5
    assert spark.read.parquet(f"{tmp_path}/four").exceptAll(tables("orders")).count() == 0


def test_a_sorted_file_is_bounded_by_its_rows_in_memory(spark, tmp_path, monkeypatch):
    # Long equal texts are tiny in a file and large where a task sorts them.
    rows = spark.range(0, 4000, 1, 8).select("id", F.repeat(F.lit("x"), 1000).alias("v"))
    rows.write.parquet(f"{tmp_path}/small")
    small = spark.read.parquet(f"{tmp_path}/small")
    monkeypatch.setattr(layout, "SORT_BYTES", 1 << 20)
    compacted(small, ["id"]).write.parquet(f"{tmp_path}/sorted")
    files = [pd.read_parquet(f) for f in glob.glob(f"{tmp_path}/sorted/*.parquet")]
    assert len(files) == 5 and max(map(len, files)) <= 1500
    assert sorted(i for f in files for i in f["id"]) == list(range(4000))
    assert all(f["id"].is_monotonic_increasing and len(f) == f["id"].max() - f["id"].min() + 1 for f in files)
    compacted(small).write.parquet(f"{tmp_path}/one")
    assert len(glob.glob(f"{tmp_path}/one/*.parquet")) == 1


def test_skew_profile(spark):
    df = spark.createDataFrame([("a",)] * 80 + [("b",)] * 10 + [("c",)] * 6 + [("d",)] * 4, "k string")
    row = skew_profile(df, ["k"]).first()
    assert (row.distinct_keys, row.total_rows, row.max_rows, row.median_rows) == (4, 100, 80, 8.0)
    assert (row.max_share, row.max_to_median) == (0.8, 10.0)


def test_persisted_is_released_and_derived_frames_are_not_cached(spark):
    df = spark.range(100)
    with persisted(df, "DISK_ONLY") as kept:
        assert is_cached(kept) and kept.storageLevel == STORAGE_LEVELS["DISK_ONLY"]
        derived = kept.filter("id > 5")
        assert not is_cached(derived) and derived.count() == 94
    assert not is_cached(df)
    with pytest.raises(ValueError, match="unknown storage level"):
        storage_level("RAM")


def test_persisted_is_released_after_an_error(spark):
    df = spark.range(7)
    with pytest.raises(RuntimeError), persisted(df):
        raise RuntimeError
    assert not is_cached(df)


def test_checkpoint_cuts_the_plan(spark):
    seen = []

    def step(df, i):
        seen.append(df._jdf.queryExecution().logical().toString().count("Project"))
        return df.withColumn("n", F.col("n") + i)

    result = iterate(spark.range(5).withColumn("n", F.lit(0)), step, rounds=6, checkpoint_every=2)
    assert {r.n for r in result.collect()} == {21}
    assert max(seen) <= 3 and seen[2] == 0


def test_staged_frame_does_not_depend_on_its_source(spark):
    df = staged(spark.range(10).withColumn("x", F.col("id") * 2))
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.count() == 10


def test_observed_rows_come_with_the_action(spark, tmp_path):
    counted, seen = observed(spark.range(42), "n")
    counted.write.parquet(f"{tmp_path}/x")
    assert seen.get == {"rows": 42}
    assert len(preview(spark.range(42), 3)) == 3


@pytest.mark.parametrize("reuse", ["cache", "table", "none"])
def test_fan_out(spark, reuse):
    totals = fan_out(spark.range(10), {
        "count": lambda df: df.count(), "sum": lambda df: df.agg(F.sum("id")).first()[0]}, reuse)
    assert totals == {"count": 10, "sum": 45}
    with pytest.raises(ValueError, match="unknown reuse"):
        fan_out(spark.range(1), {}, "memory")


def test_paths_are_new_and_shared(spark):
    assert new_path(spark, "x") != new_path(spark, "x")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_root(spark) == configured.rstrip("/")


def test_describe_reads_no_data_column(tables):
    df = describe_columns(tables("orders"), "orders")
    assert df.count() == 6


def test_daily_layout_without_partitions_changes_nothing(tables):
    nation = tables("nation")
    assert daily_layout(nation, None, None) is nation
