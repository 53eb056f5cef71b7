"""Grids of hot keys, curves through several columns, stored profiles, exact top keys, early size checks."""

import glob
from datetime import date, datetime
from decimal import Decimal
from math import isclose

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from etlkit.operators import sizing
from etlkit.operators.joins import salt_sides, salted_join
from etlkit.operators.layout import curve_layout, range_layout, stored_bytes
from etlkit.operators.metrics import top_keys
from etlkit.operators.profiles import merged_report, profile, store_profile, stored_profiles
from etlkit.operators.ranks import place
from etlkit.operators.sizing import beyond, is_small


def bag(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def both_hot(spark):
    """Key 1 holds a tenth of both sides, key 2 a fifth of the left, key 3 a fifth of the right."""
    def side(hot, label):
        key = F.when(F.col("id") % 10 == 0, 1).when(F.col("id") % 5 == 1, hot).when(F.col("id") == 7, None)
        return spark.range(2000).select(key.otherwise(100 + F.col("id") % 1500).cast("int").alias("k"), F.lit("same").alias(label))

    return side(2, "a"), side(3, "b")


def test_a_key_hot_on_both_sides_fills_a_grid(both_hot, conf):
    conf(spark__sql__shuffle__partitions="50")
    left, right = salt_sides(*both_hot, ["k"], 0.05)
    rows = {label: {r["k"]: r["n"] for r in side.groupBy("k").agg(F.count("*").alias("n")).collect()}
            for label, side in (("left", left), ("right", right))}
    # 200 rows in 5 x 5 cells, each row repeated for 5 of them; one-sided keys only on the other side.
    assert rows["left"][1] == rows["right"][1] == 1000
    assert rows["left"][2] == 400 and rows["right"][3] == 400 and rows["left"][None] == 1
    assert all(n <= 2 for k, n in rows["left"].items() if k and k > 100)
    cells = left.filter("k = 1").groupBy("salt").count().collect()
    assert len(cells) == 25 and max(r["count"] for r in cells) < 80
    met = left.join(right, ["k", "salt"]).filter("k = 1").groupBy("salt").count().collect()
    assert sum(r["count"] for r in met) == 200 * 200 and max(r["count"] for r in met) < 4 * 200 * 200 / 25


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("share", [0.001, 0.05, 2.0])
def test_grid_joins_equal_the_plain_join(both_hot, how, share, conf):
    conf(spark__sql__shuffle__partitions="20")
    left, right = both_hot
    for a, b in ((left, right), (left, right.limit(0)), (left.limit(0), right), (left, right.filter("k = 3")), (left.filter("k = 3"), right)):
        plain = a.join(b, "k", how).groupBy("k", "a", "b").count()
        assert bag(salted_join(a, b, ["k"], how, share).groupBy("k", "a", "b").count()) == bag(plain)


def test_each_hot_key_has_its_own_parts(spark, conf):
    conf(spark__sql__shuffle__partitions="100")
    left = spark.range(10000).select(F.when(F.col("id") % 2 == 0, 1).when(F.col("id") % 50 == 1, 2).otherwise(F.col("id")).alias("k"))
    right = spark.createDataFrame([(1,), (2,)], "k long")
    _, copies = salt_sides(left, right, ["k"], 0.01)
    found = {r["k"]: r["n"] for r in copies.groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert 45 <= found[1] <= 55 and found[2] <= 3


def files_with(path, column, low, high):
    """Files whose statistics allow rows with ``low <= column < high``, of all."""
    found, every = 0, glob.glob(f"{path}/*.parquet")
    for name in every:
        meta = pq.read_metadata(name)
        at = meta.schema.to_arrow_schema().names.index(column)
        spans = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        found += any(s.min < high and s.max >= low for s in spans)
    return found, len(every)


def test_a_curve_lets_files_be_skipped_by_either_column(spark, tmp_path):
    rows = spark.range(40000).select(
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"), F.pow(F.rand(3) * 100, F.lit(2.0)).alias("b"), "id")
    curve_layout(rows, ["a", "b"], 36).write.parquet(f"{tmp_path}/curve")
    range_layout(rows, ["a", "b"], 36).write.parquet(f"{tmp_path}/sorted")
    read = {}
    for layout in ("curve", "sorted"):
        stored = spark.read.parquet(f"{tmp_path}/{layout}")
        assert stored.exceptAll(rows).isEmpty() and stored.count() == 40000
        hit = stored.filter("b >= 2000 AND b < 2500")
        read[layout] = hit.select("_metadata.file_path").distinct().count()
        assert files_with(f"{tmp_path}/{layout}", "b", 2000, 2500)[0] >= read[layout]
    assert read["sorted"] == 36 and read["curve"] < 18
    assert files_with(f"{tmp_path}/curve", "b", 2000, 2500)[0] < 18 and files_with(f"{tmp_path}/curve", "a", 200, 250)[0] < 18


def test_a_curve_through_any_types(spark):
    rows = [(None, None, None, None), ("a", date(2024, 1, 1), Decimal("1.50"), float("nan")), ("é", date(1990, 1, 1), Decimal("-1.00"), 2.0)] * 50
    df = spark.createDataFrame(rows, "s string, d date, m decimal(9,2), f double").withColumn("t", F.lit(datetime(2024, 1, 1)))
    assert bag(curve_layout(df, ["s", "d", "m", "f", "t"], 4)) == bag(df)
    assert curve_layout(df.limit(0), ["s"], 4).count() == 0
    with pytest.raises(ValueError, match="do not fit"):
        curve_layout(df, ["s", "d", "m", "f", "t"], 4, bits=13)


def test_places(spark):
    cuts, values = [1, 3, 3, 7, 9], [None, 0, 1, 2, 3, 8, 9, 100]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    for counted in (True, False):
        found = [r[0] for r in df.select(place(cuts, F.col("v"), counted)).collect()]
        assert found == [0 if v is None else sum(c <= v if counted else c < v for c in cuts) for v in values]
    assert df.select(place([], F.col("v"), True).alias("p")).agg(F.max("p")).first()[0] == 0


def test_stored_profiles_merge_to_the_whole(spark, tmp_path):
    rows = spark.range(30000).select(
        "id", (F.col("id") % 700).cast("int").alias("few"), F.when(F.col("id") % 3 > 0, F.sqrt("id")).otherwise(F.lit(float("nan"))).alias("x"),
        F.when(F.col("id") % 5 > 0, F.col("id").cast("string")).alias("s"), F.lit(None).cast("int").alias("none"))
    path = f"{tmp_path}/profiles"
    for batch in range(6):
        store_profile(rows.filter(F.col("id") % 6 == batch), path, f"b{batch}")
    store_profile(rows.filter("id % 6 = 2"), path, "b2")
    store_profile(rows.limit(0), path, "empty")
    found = {r["column_name"]: r for r in merged_report(stored_profiles(spark, path), [0.1, 0.5]).collect()}
    exact = {"id": 30000, "few": 700, "x": 20001, "s": 24001, "none": 1}
    missing = {"id": 0, "few": 0, "x": 10000, "s": 6000, "none": 30000}
    for column, n in exact.items():
        r = found[column]
        assert r["total_rows"] == 30000 and r["null_count"] == missing[column]
        assert isclose(r["distinct_count"], n, rel_tol=0.06)
    assert abs(found["id"]["quantiles"][0] - 3000) < 600 and abs(found["few"]["quantiles"][1] - 350) < 15
    assert found["none"]["quantiles"] is None and found["s"]["low"] is None and found["id"]["high"] == 29999.0
    one = {r["column_name"]: r["total_rows"] for r in merged_report(stored_profiles(spark, path).filter("profile_batch = 'b1'")).collect()}
    assert one["id"] == 5000
    assert merged_report(profile(rows.limit(0))).first()["completeness"] == 0.0


def test_a_report_reads_profiles_only(spark, tmp_path):
    store_profile(spark.range(100), f"{tmp_path}/p", "1")
    plan = merged_report(stored_profiles(spark, f"{tmp_path}/p"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "/p]" in plan


@pytest.mark.parametrize("k", [1, 3, 10, 5000])
@pytest.mark.parametrize("shape", ["skewed", "even", "ties", "null"])
def test_top_keys_are_exact(spark, k, shape):
    key = {"skewed": "cast(sqrt(id * 7) as int)", "even": "id", "ties": "id % 50", "null": "case when id % 3 = 0 then null else id % 11 end"}[shape]
    df = spark.range(6000).selectExpr(f"{key} as a", "id % 2 as b")
    plain = df.groupBy("a", "b").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "a", "b").limit(k)
    assert [tuple(r) for r in top_keys(df, ["a", "b"], k).collect()] == [tuple(r) for r in plain.collect()]


def test_top_keys_count_candidates_and_groups_only(spark, monkeypatch):
    """With clear winners no key outside the candidates is counted for itself."""
    from etlkit.operators import metrics
    df = spark.range(200000).selectExpr("case when id % 4 = 0 then id % 16 else 1000 + id end as a")
    kept = []
    monkeypatch.setattr(metrics, "staged", lambda d, label: kept.append(d) or d.cache())
    assert [r["a"] for r in top_keys(df, ["a"], 4).collect()] == [0, 4, 8, 12]
    counted = kept[0]
    assert counted.count() <= metrics.REST_BUCKETS + 16 and counted.filter("bucket is null").count() <= 16
    counted.unpersist()


def test_a_size_check_stops_at_the_limit(spark, monkeypatch):
    big = spark.range(10**12)
    plan = beyond(big, 5000)._jdf.queryExecution().executedPlan().toString()
    assert "CollectLimit 5000" in plan
    monkeypatch.setattr(sizing, "measured_bytes", lambda df: pytest.fail("measured in full"))
    assert not is_small(big) and is_small(spark.range(1000)) and not is_small(spark.range(1000), 0)


def test_stored_bytes_are_listed_by_spark(spark, tmp_path):
    df = spark.range(1000).withColumn("p", F.concat(F.lit("a b%=/"), F.col("id") % 3))
    df.repartition(3).write.partitionBy("p").parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    sizes = {name: len(open(name, "rb").read()) for name in glob.glob(f"{tmp_path}/t/*/*.parquet")}
    assert stored_bytes(stored) == sum(sizes.values())
    assert 0 < stored_bytes(stored.filter(F.col("p").endswith("1"))) <= sum(sizes.values())
    assert stored_bytes(spark.range(3)) == 0
