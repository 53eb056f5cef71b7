import math
import random

import pytest
from plan_asserts import exchanges, final_part, final_plan, initial_plan, joins
from pyspark.sql import functions as F

from etlkit.operators.bands import band_join, candidates
from etlkit.operators.joins import (
    STRATEGIES, equi_join, hot_key_split_join, join_aggregate, salt_sides, salted_join,
)
from etlkit.operators.sizing import (
    BROADCAST_LIMIT_BYTES, broadcast_if_small, hot_keys, is_small, measured_bytes, salts_for,
)


@pytest.fixture
def skewed(spark):
    """1,000 rows: half on key 1, all copies of each other; some null keys."""
    rows = [(1, "copy")] * 500 + [(None, "none")] * 20 + [(i % 40, f"r{i}") for i in range(480)]
    return spark.createDataFrame(rows, "k int, v string").repartition(6)


@pytest.fixture
def lookup(spark):
    rows = [(i, f"n{i}") for i in range(0, 30)] + [(1, "again"), (None, "null")]
    return spark.createDataFrame(rows, "k int, name string")


def bag(df):
    return sorted(map(str, df.collect()))


def test_hot_keys_are_found_and_bounded(skewed):
    hot = hot_keys(skewed, ["k"], 0.1)
    assert len(hot) == 1 and abs(next(iter(hot.values())) - 0.512) < 0.01
    assert salts_for(skewed, hot) == 5 and salts_for(skewed, {}) == 1
    assert len(hot_keys(skewed, ["k"], 0.001)) <= 1000
    assert hot_keys(skewed.limit(0), ["k"]) == {}


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("share", [0.001, 0.1, 2.0])
def test_skew_joins_equal_the_plain_join(skewed, lookup, how, share):
    plain = bag(skewed.join(lookup, "k", how))
    assert bag(salted_join(skewed, lookup, ["k"], how, share)) == plain
    assert bag(hot_key_split_join(skewed, lookup, ["k"], how, share)) == plain
    assert bag(hot_key_split_join(skewed, lookup, ["k"], how, share, limit_bytes=0)) == plain


def test_salts_spread_copies_of_one_row(skewed, lookup):
    left, _ = salt_sides(skewed, lookup, ["k"], 0.1, salts=4)
    spread = {r.salt: r["count"] for r in left.filter("k = 1").groupBy("salt").count().collect()}
    assert len(spread) == 4 and max(spread.values()) < 300


def test_salting_needs_equal_types_and_supported_kind(skewed, lookup):
    with pytest.raises(ValueError, match="one type"):
        salted_join(skewed, lookup.withColumn("k", F.col("k").cast("long")), ["k"])
    with pytest.raises(ValueError, match="inner and left"):
        salted_join(skewed, lookup, ["k"], "full")
    with pytest.raises(ValueError, match="inner and left"):
        hot_key_split_join(skewed, lookup, ["k"], "full")


def test_all_strategies_agree(skewed, lookup):
    results = {s: bag(equi_join(skewed, lookup, "k", strategy=s)) for s in STRATEGIES}
    assert len(set(map(tuple, results.values()))) == 1
    with pytest.raises(ValueError, match="unknown join strategy"):
        equi_join(skewed, lookup, "k", strategy="fastest")


@pytest.mark.parametrize("strategy, operator", [
    ("broadcast", "BroadcastHashJoin"), ("merge", "SortMergeJoin"),
    ("shuffle_hash", "ShuffledHashJoin")])
def test_strategy_reaches_the_plan(skewed, lookup, strategy, operator):
    assert joins(initial_plan(equi_join(skewed, lookup, "k", strategy=strategy))) == [operator]


def test_large_sides_are_not_forced(skewed, lookup, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    for strategy in ("broadcast", "shuffle_hash"):
        plan = initial_plan(equi_join(skewed, lookup, "k", strategy=strategy, limit_bytes=10))
        assert joins(plan) == ["SortMergeJoin"]


def test_measured_size(spark):
    df = spark.createDataFrame([("a" * 1000, [1, 2]), (None, None)], "s string, a array<int>")
    assert 1000 < measured_bytes(df) < 1400
    assert is_small(df) and not is_small(df, 500)
    assert measured_bytes(df.limit(0)) == 0
    assert broadcast_if_small(df, 500) is df


def test_join_aggregate_with_and_without_broadcast(skewed, lookup, conf):
    sums = {"total": F.length("v"), "one": "1"}
    small = join_aggregate(skewed, lookup, ["k"], ["name"], sums)
    large = join_aggregate(skewed, lookup, ["k"], ["name"], sums, limit_bytes=0)
    plain = skewed.join(lookup, "k").groupBy("name").agg(
        F.sum(F.length("v")).alias("total"), F.sum(F.lit(1)).alias("one"),
        F.count(F.lit(1)).alias("rows"))
    assert bag(small) == bag(large) == bag(plain)


def test_adaptive_execution_splits_the_hot_partition(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="2000",
         spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
         spark__sql__adaptive__advisoryPartitionSizeInBytes="2000",
         spark__sql__adaptive__coalescePartitions__enabled="false")
    fact = spark.range(0, 40000, 1, 8).select(
        F.when(F.col("id") % 10 < 9, 1).otherwise(F.col("id") % 500).alias("k"), "id")
    dim = spark.range(500).select(F.col("id").alias("k"), F.col("id").cast("string").alias("n"))
    joined = equi_join(fact, dim, "k", strategy="merge")
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 40000


def brute(values, bands):
    return sorted((v, i) for v in values for i, (low, high) in enumerate(bands)
                  if v is not None and (low is None or v >= low) and (high is None or v < high))


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("broadcast", [True, False])
def test_band_join_equals_brute_force(spark, conf, seed, broadcast):
    draw = random.Random(seed)
    low = [round(draw.uniform(-50, 50), 1) for _ in range(25)]
    bands = [(x, x + draw.choice([0.1, 1, 3, 17.5, 64, 0, -2])) for x in low]
    bands += [(None, -20.0), (30.0, None), (-math.inf, 0.0), (10.0, math.inf)]
    values = [round(draw.uniform(-80, 120), 1) for _ in range(150)] + [None, *low, 1e300, -1e300]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    table = spark.createDataFrame(
        [(i, *b) for i, b in enumerate(bands)], "band int, low double, high double")
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    joined = band_join(df, "v", table, "low", "high", **({} if broadcast else {"limit_bytes": 0}))
    assert joined.columns == ["v", "band", "low", "high"]
    assert sorted((r.v, r.band) for r in joined.collect()) == brute(values, bands)
    plan = initial_plan(joined)
    assert joins(plan) == (["BroadcastHashJoin"] if broadcast else []) and exchanges(plan) == 0
    assert broadcast or ("MapInArrow" in plan and plan.count("Exchange ") == 1)


BOTH_WAYS = pytest.mark.parametrize("limit", [{}, {"limit_bytes": 0}])


@BOTH_WAYS
def test_band_edges_and_empty_bands(spark, limit):
    df = spark.createDataFrame([(0,), (10,), (20,), (30,)], "v int")
    bands = spark.createDataFrame([(1, 0, 10), (2, 10, 20)], "band int, low int, high int")
    matched = {(r.v, r.band) for r in band_join(df, "v", bands, "low", "high", **limit).collect()}
    assert matched == {(0, 1), (10, 2)}
    assert band_join(df, "v", bands.limit(0), "low", "high", **limit).count() == 0
    assert band_join(df.limit(0), "v", bands, "low", "high", **limit).count() == 0


@BOTH_WAYS
def test_bands_of_whole_numbers_that_doubles_cannot_tell_apart(spark, limit):
    big = 1 << 60
    values, bands = [big + i for i in range(8)], [(big + i, big + i + 1 + i % 3) for i in range(8)] + [(big + 3, big + 3)]
    df = spark.createDataFrame([(v, "same") for v in values], "v long, name string")
    table = spark.createDataFrame([(i, *b, "other") for i, b in enumerate(bands)], "band int, low long, high long, name string")
    joined = band_join(df, "v", table, "low", "high", **limit)
    assert joined.columns == ["v", "name", "band", "low", "high", "name"]
    rows = joined.toDF("v", "a", "band", "low", "high", "b").collect()
    assert sorted((r.v, r.band) for r in rows) == brute(values, bands)
    assert {(r.a, r.b) for r in rows} == {("same", "other")}


@BOTH_WAYS
def test_nan_is_above_all_numbers(spark, limit):
    df = spark.createDataFrame([(1.0,), (math.nan,), (math.inf,)], "v double")
    bands = [(0, 0.0, None), (1, None, math.nan), (2, math.nan, None), (3, None, math.inf)]
    table = spark.createDataFrame(bands, "band int, low double, high double")
    joined = band_join(df, "v", table, "low", "high", **limit)
    plain = df.join(table, F.expr("(low IS NULL OR v >= low) AND (high IS NULL OR v < high)"))
    assert sorted(map(str, joined.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("limit", [BROADCAST_LIMIT_BYTES, 0])
def test_one_wide_band_costs_what_it_matches(spark, limit):
    """20,000 narrow bands, with and without one over all of them: the pairs met grow by the wide one's matches."""
    values = spark.range(20000).select((F.col("id") * 50 + 0.5).alias("v"))
    narrow = spark.range(20000).select("id", (F.col("id") * 50.0).alias("low"), (F.col("id") * 50.0 + 1).alias("high"))
    wide = spark.createDataFrame([(-1, -1e10, 1e10)], narrow.schema)
    met = [candidates(values, "v", b, "low", "high", limit).count() for b in (narrow, narrow.union(wide))]
    assert 20000 <= met[0] <= 60000 and met[1] == met[0] + 20000
    assert band_join(values, "v", narrow.union(wide), "low", "high", limit).count() == 40000


def test_a_swept_value_that_holds_most_rows_spreads(spark, conf):
    conf(spark__sql__shuffle__partitions="8")
    rows = spark.range(40000).select(F.when(F.col("id") % 4 > 0, 7.0).otherwise(F.col("id") / 100).alias("v"))
    bands = spark.createDataFrame([(1, 0.0, 7.5), (2, 7.0, 8.0), (3, 7.0, 7.0), (4, 100.0, 1e9)], "band int, low double, high double")
    met = candidates(rows, "v", bands, "low", "high", 0)
    sizes = [r["n"] for r in met.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 4 and max(sizes) < 0.5 * sum(sizes)
    found = {r["band"]: r["n"] for r in band_join(rows, "v", bands, "low", "high", 0).groupBy("band").agg(F.count("*").alias("n")).collect()}
    plain = rows.join(bands, F.expr("v >= low AND v < high")).groupBy("band").agg(F.count("*").alias("n")).collect()
    assert found == {r["band"]: r["n"] for r in plain}


def test_bucketed_tables_join_without_shuffle(spark, sf, conf):
    from etlkit.queries import QUERIES
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = initial_plan(QUERIES["bucketed_join"](spark, sf))
    assert joins(plan) == ["SortMergeJoin"] and exchanges(plan) == 0


def test_dimension_filter_prunes_partitions(spark, sf):
    from etlkit.queries import QUERIES
    assert "dynamicpruning" in final_part(final_plan(QUERIES["join_dpp"](spark, sf)))


def test_collected_statistics_reach_the_optimizer(spark, tables, conf):
    from etlkit.sources.catalog import collect_stats, drop_table, register_external_table
    conf(spark__sql__cbo__enabled="true", spark__sql__cbo__joinReorder__enabled="true")
    for name in ("lineitem", "orders", "part"):
        register_external_table(spark, f"c_{name}", f"/root/testdata/sf0.001/{name}.parquet")
    collect_stats(spark, ["c_lineitem", "c_orders", "c_part"])
    star = spark.sql("""SELECT p_type, sum(l_quantity) AS q FROM c_lineitem
        JOIN c_orders ON l_orderkey = o_orderkey JOIN c_part ON l_partkey = p_partkey
        GROUP BY p_type""")
    cost = star._jdf.queryExecution().stringWithStats()
    assert "rowCount=" in cost
    for name in ("lineitem", "orders", "part"):
        drop_table(spark, f"c_{name}")
