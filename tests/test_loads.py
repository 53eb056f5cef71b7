import glob
import os
import subprocess
import sys
from types import SimpleNamespace

import pytest
from conftest import ROOT
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from etlkit.operators.reuse import measured, observed
from etlkit.plans import job
from etlkit.plans.etl import EtlJob, first_date_dimensions
from etlkit.plans.incremental import (
    apply_changes, compact_partition, incremental_load, latest_changes, merge_into_partitions, overwrite_partitions,
)
from etlkit.plans.run_log import changed_strategies, physical_plan, record_run
from etlkit.session import build_session, options
from etlkit.settings import SparkSettings, WarehouseSettings
from etlkit.sources.tables import TableStore
from etlkit.workspace import shared_root


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, WarehouseSettings(format="parquet", base_path=str(tmp_path)))


@pytest.fixture
def people(spark, store):
    df = spark.createDataFrame(
        [(1, "a", "2024-01-05"), (2, None, "2024-02-06"), (3, "c", "2024-02-06")],
        "id int, `Full Name` string, `Start Date` string"
    ).withColumn("Start Date", F.to_date("Start Date"))
    store.write_table(df, "people")
    return df


def test_run_reports_rows_and_quality(store, people):
    result = EtlJob(store).run("people", "clean", "id > 1", partition_by="start_date")
    assert (result["rows_in"], result["rows_out"]) == (2, 2)
    assert result["quality"]["columns"]["Full Name"]["null_count"] == 1
    clean = store.read_table("clean")
    assert {"full_name", "load_timestamp", "start_date_year", "start_date_formatted",
            "start_date_partition_day"} <= set(clean.columns)
    assert clean.select("start_date_month").distinct().collect() == [(2,)]


def test_run_that_writes_nothing(store, people):
    EtlJob(store).run("people", "clean")
    ignored = EtlJob(store).run("people", "clean", mode="ignore")
    assert (ignored["rows_in"], ignored["rows_out"]) == (0, 0)
    emptied = EtlJob(store, extra_steps=[lambda df: df.filter(F.lit(False))], quality="none").run(
        "people", "none")
    assert (emptied["rows_out"], emptied["quality"]) == (0, None)
    assert store.read_table("clean").count() == 3 and store.read_table("none").count() == 0


def test_missing_required_column_fails(store, people):
    with pytest.raises(ValueError, match="Missing required columns"):
        EtlJob(store, ["email"]).run("people", "clean")
    with pytest.raises(ValueError, match="unknown quality mode"):
        EtlJob(store, quality="some")


def test_date_dimensions_take_the_first_dated_name(spark):
    df = spark.createDataFrame([(1, 2)], "update_count int, birth_date int")
    assert first_date_dimensions(df).columns == df.columns
    assert first_date_dimensions(df.select("update_count").toDF("n")).columns == ["n"]


def test_job_exit_codes(store, people, monkeypatch):
    monkeypatch.setattr(job, "TableStore", lambda spark: store)
    arguments = ["--source-table", "people", "--target-table", "out"]
    assert job.main(arguments + ["--mode", "append", "--filter-condition", "id < 3"]) == 0
    assert store.read_table("out").count() == 2
    assert job.main(arguments + ["--mode", "error"]) == 1
    with pytest.raises(SystemExit):
        job.main(arguments + ["--mode", "merge"])


def test_settings_from_environment():
    assert SparkSettings.from_env({"SPARK_DRIVER_MEMORY": "3g"}).as_conf() == {
        "spark.app.name": "etlkit", "spark.driver.memory": "3g"}
    warehouse = WarehouseSettings.from_env({"WAREHOUSE_PROJECT": "p", "WAREHOUSE_DATASET": ""})
    assert warehouse.project == "p"
    with pytest.raises(ValueError, match="dataset"):
        warehouse.require_names()


def test_session_overrides_apply_to_a_running_session(spark, conf):
    conf(spark__sql__shuffle__partitions="8")
    same = build_session(overrides={"spark.sql.shuffle.partitions": "9"})
    assert same is spark and spark.conf.get("spark.sql.shuffle.partitions") == "9"
    with pytest.raises(ValueError, match="cannot change"):
        build_session(overrides={"spark.memory.fraction": "0.7"})
    with options(spark, {"spark.sql.shuffle.partitions": "3", "spark.sql.made.up": "x"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "9"
    assert spark.conf.get("spark.sql.made.up", None) is None


def test_incremental_load_takes_only_new_rows_and_survives_a_crash(spark, tables, tmp_path):
    events, target, state = tables("events"), f"{tmp_path}/t", f"{tmp_path}/s"
    early = events.filter("event_id < 400")
    assert incremental_load(early, target, state, "ts")["rows"] == early.count()
    # A run that wrote its batch but not its state is repeated into the same batch.
    events.filter("event_id >= 400").limit(10).write.parquet(f"{target}/load_batch=1")
    done = incremental_load(events, target, state, "ts")
    assert done["batch"] == 1 and done["rows"] == events.count() - early.count()
    assert incremental_load(events, target, state, "ts")["rows"] == 0
    stored = spark.read.parquet(target).select(*events.columns)
    assert stored.count() == events.count() and stored.exceptAll(events).count() == 0


def test_incremental_load_of_empty_source(spark, tables, tmp_path):
    empty = tables("events").limit(0)
    result = incremental_load(empty, f"{tmp_path}/t", f"{tmp_path}/s", "ts")
    assert result == {"batch": 0, "rows": 0, "high_watermark": None}
    assert incremental_load(tables("events"), f"{tmp_path}/t", f"{tmp_path}/s", "ts")["rows"] == 1000


BASE = [(1, "a", 1.0), (2, "b", None), (3, "c", 3.0)]
CHANGES = [(1, "a", 9.0, "U", 1), (1, "a", None, "U", 2), (2, "b", 0.0, "D", 1),
           (4, "b", 4.0, "I", 1), (5, "c", 5.0, "I", 1), (5, "c", 5.0, "D", 2), (6, "z", 0.0, "D", 1)]
AFTER = {(1, "a", None), (3, "c", 3.0), (4, "b", 4.0)}


@pytest.fixture
def change_sets(spark):
    return (spark.createDataFrame(BASE, "k int, p string, v double"),
            spark.createDataFrame(CHANGES, "k int, p string, v double, op string, at int"))


def test_apply_changes(change_sets):
    base, changes = change_sets
    result = apply_changes(base, changes, ["k"], ["at"])
    assert result.columns == base.columns and {tuple(r) for r in result.collect()} == AFTER
    assert latest_changes(changes, ["k"], ["at"]).count() == 5
    assert apply_changes(base, changes.limit(0), ["k"], ["at"]).count() == 3


def test_merge_rewrites_touched_partitions_only(spark, change_sets, tmp_path):
    base, changes = change_sets
    base = base.union(spark.createDataFrame(
        [(7, "quiet", 7.0), (8, "gone / x", 8.0), (9, None, 9.0)], base.schema))
    changes = changes.union(spark.createDataFrame(
        [(8, "gone / x", 0.0, "D", 1), (9, None, 0.0, "D", 1)], changes.schema))
    path = f"{tmp_path}/t"
    overwrite_partitions(base, path, ["p"])
    quiet = glob.glob(f"{path}/p=quiet/*.parquet")
    merge_into_partitions(spark, path, changes, ["k"], ["at"], "p")
    merged = spark.read.parquet(path).select(*base.columns)
    assert {tuple(r) for r in merged.collect()} == AFTER | {(7, "quiet", 7.0)}
    assert glob.glob(f"{path}/p=quiet/*.parquet") == quiet


def test_overwrite_twice_changes_nothing(spark, tmp_path):
    df = spark.createDataFrame(BASE, "k int, p string, v double")
    for _ in range(2):
        overwrite_partitions(df, f"{tmp_path}/t", ["p"])
    overwrite_partitions(df.filter("p = 'a'").withColumn("v", F.lit(0.0)), f"{tmp_path}/t", ["p"])
    stored = spark.read.parquet(f"{tmp_path}/t").select("k", "p", "v")
    assert {tuple(r) for r in stored.collect()} == {(1, "a", 0.0), (2, "b", None), (3, "c", 3.0)}


def test_run_log_reports_a_changed_join(spark, tables, tmp_path):
    orders, customers = tables("orders"), tables("customer")
    on = F.col("o_custkey") == F.col("c_custkey")
    log = f"{tmp_path}/log"
    for name, hint in (("same", "merge"), ("same", "merge"), ("moved", "broadcast"), ("moved", "merge")):
        joined = orders.join(customers.hint(hint), on)
        assert record_run(spark, log, name, joined).count() == joined.count()
    assert [tuple(r) for r in changed_strategies(spark, log).collect()] == [
        ("moved", "BroadcastHashJoin", "SortMergeJoin")]


def test_run_log_records_the_join_that_ran(spark, tables, tmp_path, conf):
    """Planned as a sort-merge join, turned into a broadcast join by what the filter left."""
    conf(spark__sql__autoBroadcastJoinThreshold="1000")
    few = tables("customer").filter(F.col("c_name").endswith("7")).select("c_custkey").distinct()
    joined = tables("orders").select("o_orderkey", "o_custkey").join(few, F.col("o_custkey") == F.col("c_custkey"))
    assert "SortMergeJoin" in physical_plan(joined)
    record_run(spark, f"{tmp_path}/log", "report", joined)
    assert spark.read.parquet(f"{tmp_path}/log").first()["join_operators"] == "BroadcastHashJoin"


def test_compaction_of_one_partition(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.range(400).selectExpr("id", "case when id % 2 = 0 then 'a' else null end as p")
    df.repartition(4).write.partitionBy("p").parquet(path)
    others = sorted(glob.glob(f"{path}/p=__HIVE*/*.parquet"))
    assert len(glob.glob(f"{path}/p=a/*.parquet")) == 4
    compact_partition(spark, path, "p", "a")
    assert len(glob.glob(f"{path}/p=a/*.parquet")) == 1
    assert sorted(glob.glob(f"{path}/p=__HIVE*/*.parquet")) == others
    assert spark.read.parquet(path).select("id", "p").exceptAll(df).count() == 0 and spark.read.parquet(path).count() == 400


def test_merge_moves_a_key_between_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    overwrite_partitions(spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (3, "b", 3.0)], "k int, p string, v double"), path, ["p"])
    changes = spark.createDataFrame([(1, "b", 9.0, "U", 1), (3, None, 4.0, "U", 1)], "k int, p string, v double, op string, at int")
    merge_into_partitions(spark, path, changes, ["k"], ["at"], "p")
    assert {tuple(r) for r in spark.read.parquet(path).select("k", "p", "v").collect()} == {
        (1, "b", 9.0), (2, "a", 2.0), (3, None, 4.0)}


def test_load_takes_ties_and_rows_without_a_value(spark, tmp_path):
    def load(rows):
        source = spark.createDataFrame(rows, "id int, w int")
        return incremental_load(source, f"{tmp_path}/t", f"{tmp_path}/s", "w")["rows"]

    assert load([(0, None), (1, None)]) == 2
    assert load([(0, None), (1, None), (1, 5)]) == 1
    assert load([(0, None), (1, None), (1, 5), (2, 5), (2, 5), (3, None)]) == 3
    assert load([(0, None), (1, None), (1, 5), (2, 5), (2, 5), (3, None), (4, 6)]) == 1
    assert load([(0, None), (1, None), (1, 5), (2, 5), (2, 5), (3, None), (4, 6)]) == 0
    stored = sorted((tuple(r) for r in spark.read.parquet(f"{tmp_path}/t").select("id", "w").collect()), key=str)
    assert stored == sorted([(0, None), (1, None), (1, 5), (2, 5), (2, 5), (3, None), (4, 6)], key=str)


def test_restarted_session_takes_new_static_options():
    code = """
from etlkit.session import build_session, restart_session, stop_session
s = build_session("one", {"spark.memory.fraction": "0.5", "spark.ui.enabled": "false"})
assert s.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
s = restart_session("two", {"spark.memory.fraction": "0.7", "spark.ui.enabled": "false"})
print(s.sparkContext.appName, s.conf.get("spark.memory.fraction"), s.range(3).count())
stop_session()
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True,
                          timeout=120, env={"SPARK_MASTER": "local[2]", **os.environ})
    assert done.stdout.strip().endswith("two 0.7 3"), done.stderr[-2000:]


def test_cluster_without_a_shared_folder_is_refused():
    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default),
        sparkContext=SimpleNamespace(master="yarn", applicationId="a"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(cluster)
    configured = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: "hdfs://x/cp/"))
    assert shared_root(configured) == "hdfs://x/cp"


TEXTS = ["01", "007", "2024-01-05", "1e3", None, "x y"]


def test_text_partitions_survive_merge_and_compaction(spark, tmp_path):
    path = f"{tmp_path}/t"
    base = [(i, TEXTS[i % 6], float(i)) for i in range(24)]
    spark.createDataFrame(base, "k int, p string, v double").repartition(4).write.partitionBy("p").parquet(path)
    before = sorted(os.listdir(path))
    changes = [(0, "01", 100.0, "U", 1), (1, "007", 0.0, "D", 1), (2, "01", 200.0, "U", 1), (30, "", 5.0, "I", 1), (31, "1", 6.0, "I", 1)]
    merge_into_partitions(spark, path, spark.createDataFrame(changes, "k int, p string, v double, op string, at int"), ["k"], ["at"], "p")
    for value in ("01", "007", "1e3", None):
        compact_partition(spark, path, "p", value)
    want = {k: (p, v) for k, p, v in base if k != 1} | {0: ("01", 100.0), 2: ("01", 200.0), 30: (None, 5.0), 31: ("1", 6.0)}
    with options(spark, {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}):
        found = spark.read.parquet(path)
    rows = [(r["k"], r["p"], r["v"]) for r in found.collect()]
    assert sorted(rows, key=str) == sorted(((k, *r) for k, r in want.items()), key=str)
    assert sorted(os.listdir(path)) == sorted([*before, "p=1"])


def test_other_errors_of_an_observation_are_raised(spark):
    class Broken:
        @property
        def get(self):
            return spark.sparkContext._jvm.java.util.Objects.requireNonNull(None)

    with pytest.raises(Py4JJavaError):
        measured(Broken())
    nothing, seen = observed(spark.range(3), "gone")
    nothing.filter("false").write.format("noop").mode("overwrite").save()
    assert measured(seen) == {}
