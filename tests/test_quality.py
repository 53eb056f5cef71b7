import math

import pytest
from pyspark.sql import functions as F

from etlkit.operators.metrics import (
    aggregate_metrics, count_where, distinct_counts, exact_sum, salted_aggregate,
)
from etlkit.operators.nulls import handle_null_values, remove_duplicates
from etlkit.operators.quality import (
    check_data_quality, check_rules, quality_report, split_by_rules, validate_required_columns,
)

MIXED = ("i int, d double, s string, day date, ts timestamp, n timestamp_ntz, b boolean, "
         "m decimal(10,2)")


@pytest.fixture
def mixed(spark):
    rows = [(1, 0.0, "", True, 1), (2, -0.0, " ", None, 1), (None, float("nan"), "é", False, None),
            (1, None, None, True, 2), (1, math.inf, "", None, 2), (2, float("nan"), "x", True, 3)]
    raw = spark.createDataFrame(rows, "i int, d double, s string, b boolean, m int")
    return raw.select(
        "i", "d", "s", F.date_add(F.lit("2024-01-01").cast("date"), "m").alias("day"),
        F.lit("2024-01-01").cast("timestamp").alias("ts"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("n"), "b",
        F.col("m").cast("decimal(10,2)").alias("m"))


def test_required_columns(mixed):
    validate_required_columns(mixed, ["i", "d"])
    with pytest.raises(ValueError, match=r"Missing required columns: \['id', 'email'\]"):
        validate_required_columns(mixed, ["id", "i", "email"])


def test_report_equals_one_count_per_column(mixed):
    report = quality_report(mixed)
    assert report["total_rows"] == 6
    for name, kind in mixed.dtypes:
        missing = F.col(name).isNull() | (F.isnan(name) if kind == "double" else F.lit(False))
        nulls = mixed.filter(missing).count()
        assert report["columns"][name] == {
            "null_count": nulls, "null_percentage": nulls / 6 * 100,
            "distinct_count": mixed.select(name).distinct().count(),
            "completeness": (6 - nulls) / 6 * 100,
        }, name


def test_approximate_report_equals_exact_on_little_data(mixed):
    exact = {tuple(r) for r in check_data_quality(mixed).collect()}
    assert {tuple(r) for r in check_data_quality(mixed, approximate=True).collect()} == exact


@pytest.mark.parametrize("approximate", [False, True])
def test_report_of_empty_frame(mixed, approximate):
    empty = quality_report(mixed.limit(0), ["i", "d"], approximate)
    assert empty["total_rows"] == 0
    assert empty["columns"]["d"] == {
        "null_count": 0, "null_percentage": 0.0, "distinct_count": 0, "completeness": 0.0}


def test_rule_checks_count_unknown_as_failed(mixed):
    rows = {r.rule: r for r in check_rules(mixed, {"small": "i < 2", "all": F.lit(True)}, 8).collect()}
    assert (rows["small"].checked, rows["small"].failed, rows["small"].passed) == (6, 3, False)
    assert rows["all"].passed and rows["row_count"].failed == 2


def test_split_keeps_every_row(mixed):
    good, bad = split_by_rules(mixed, {"i": "i = 1", "s": "s IS NOT NULL"})
    assert good.columns == mixed.columns and good.count() == 2
    assert sorted(r.violations for r in bad.collect()) == ["i", "i", "i", "s"]


@pytest.mark.parametrize("approximate", [False, True])
def test_distinct_counts_take_null_as_a_value(mixed, approximate):
    counts = {r[0]: r[1] for r in distinct_counts(mixed, ["i", "s"], approximate).collect()}
    assert counts == {"i": 3, "s": 5}


def test_aggregate_metrics(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 3.0)], "k string, v double")
    result = aggregate_metrics(df, ["k"], {"v": ["sum", "count"]}, "m_")
    assert result.columns == ["k", "m_v_sum", "m_v_count"]
    assert {tuple(r) for r in result.collect()} == {("a", 1.0, 1), ("b", 3.0, 1)}
    assert aggregate_metrics(df.limit(0), ["k"], {"v": "max"}).collect() == []
    with pytest.raises(ValueError, match="Unsupported aggregation function: median"):
        aggregate_metrics(df, ["k"], {"v": "median"})


def test_exact_sum_of_large_small_and_negative_amounts(spark):
    values = [0.1] * 10 + [-0.07, 1e12, -3.25, 123456789.01, -1e12, None]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    assert df.agg(exact_sum(F.col("v"))).first()[0] == 123456786.69
    many = spark.range(0, 100000, 1, 4).select(F.lit(9e13).alias("v"))
    assert many.agg(exact_sum(F.col("v"))).first()[0] == 9e18
    assert df.limit(0).agg(exact_sum(F.col("v"))).first()[0] is None


def test_one_pass_counts_equal_looped_counts(tables):
    events = tables("events")
    kinds = [r[0] for r in events.select("event_type").distinct().collect()]
    row = events.agg(*count_where(**{k: F.col("event_type") == k for k in kinds})).first()
    assert row.asDict() == {k: events.filter(F.col("event_type") == k).count() for k in kinds}


def test_salted_aggregate_equals_plain_with_copies_and_null_keys(spark):
    rows = [("hot", 1)] * 500 + [(None, 2)] * 20 + [("cold", None), ("cold", 7)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(6)
    metrics = {"v": ["sum", "count", "min", "max", "avg"]}
    plain = {tuple(r) for r in aggregate_metrics(df, ["k"], metrics).collect()}
    assert {tuple(r) for r in salted_aggregate(df, ["k"], metrics, 5).collect()} == plain
    with pytest.raises(ValueError, match="not mergeable"):
        salted_aggregate(df, ["k"], {"v": "stddev"})


def test_null_strategies(spark):
    df = spark.createDataFrame([(1, None, None), (2, 5, "x")], "id int, v int, s string")
    assert handle_null_values(df, "drop", subset=["v"]).count() == 1
    assert handle_null_values(df, "fill").first()[:] == (1, 0, None)
    filled = handle_null_values(df, "fill", {"v": 9, "s": "?"}, subset=["s"]).first()
    assert filled[:] == (1, None, "?")
    assert handle_null_values(df, "fill", {"v": 9}, subset=["s"]).first()[:] == (1, None, None)
    with pytest.raises(ValueError, match="Unsupported null handling strategy"):
        handle_null_values(df, "interpolate")
    with pytest.raises(ValueError, match="order_by"):
        handle_null_values(df, "forward_fill")


def test_duplicates(spark):
    df = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 2), (1, None, 3), (None, "c", 4), (None, "d", 5)],
        "k int, s string, at int")
    first = remove_duplicates(df, ["k"], "first", ["at"])
    last = remove_duplicates(df, ["k"], "last", ["at"])
    assert first.columns == df.columns
    assert {tuple(r) for r in first.collect()} == {(1, "a", 1), (None, "c", 4)}
    assert {tuple(r) for r in last.collect()} == {(1, None, 3), (None, "d", 5)}
    assert remove_duplicates(df.union(df)).count() == 5
    assert remove_duplicates(df, ["k"]).count() == 2
    with pytest.raises(ValueError, match="keep"):
        remove_duplicates(df, ["k"], "any")
