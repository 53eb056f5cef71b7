import pytest
from pyspark.sql import functions as F

from etlkit.functions import udfs
from etlkit.operators.columns import (
    add_audit_columns, composite_key, create_date_dimensions, first_match,
    standardize_column_names, threshold_flags,
)
from etlkit.operators.rules import apply_business_rules


def named(spark, *names):
    return spark.createDataFrame([tuple(range(len(names)))], list(names))


@pytest.mark.parametrize("convention, expected", [
    ("snake_case", ["first_name", "last_name", "x", "n", "1st", "a_b_c"]),
    ("camelCase", ["firstName", "lastName", "x", "n", "1st", "aBC"]),
    ("lower", ["first_name", "last-name", "__x__", "ünï", "1st", "a__b..c"]),
])
def test_standardize(spark, convention, expected):
    df = named(spark, "First Name", "Last-Name", "__x__", "Ünï", "1st", "a  b..c")
    assert standardize_column_names(df, convention).columns == expected


@pytest.mark.parametrize("names", [("a b", "a-b"), ("a", "__"), ("A", "a_")])
def test_standardize_collision(spark, names):
    with pytest.raises(ValueError, match="collide"):
        standardize_column_names(named(spark, *names))


def test_standardize_unknown_convention(spark):
    with pytest.raises(ValueError, match="Unsupported naming convention"):
        standardize_column_names(named(spark, "a"), "kebab")


def test_audit(spark):
    row = add_audit_columns(named(spark, "a"), "2024-03-01 10:00:00").first()
    assert (str(row.load_timestamp), row.source_system, row.load_id) == (
        "2024-03-01 10:00:00", "pyspark_etl", "batch_load")
    now = add_audit_columns(named(spark, "a"), source_system="s", load_id="7").first()
    assert now.load_timestamp is not None and (now.source_system, now.load_id) == ("s", "7")


@pytest.mark.parametrize("value, kind", [
    ("2024-11-05", "date"), ("2024-11-05 23:59:59", "timestamp"),
    ("2024-11-05 23:59:59", "timestamp_ntz"), ("2024-11-05", "string")])
def test_date_dimensions(spark, value, kind):
    df = spark.createDataFrame([(value,), (None,)], "d string").select(F.col("d").cast(kind))
    first, empty = create_date_dimensions(df, "d", quarter=True).collect()
    assert first[1:] == (2024, 11, 5, 4, "2024-11-05")
    assert empty[1:] == (None,) * 5


def test_date_dimensions_of_bad_text_are_null(spark):
    df = spark.createDataFrame([("soon",)], "d string")
    assert create_date_dimensions(df, "d").first()[1:] == (None,) * 4


def test_first_match_order_and_default(spark):
    df = spark.createDataFrame([(1,), (20,), (None,)], "n int")
    label = first_match({"big": "n > 10", "any": F.col("n") > 0}, "none")
    assert [r[0] for r in df.select(label).collect()] == ["any", "big", "none"]
    assert df.select(first_match({}, "none")).distinct().collect() == [("none",)]


def test_composite_key_and_flags(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 5.0)], "k string, v double")
    assert [r[0] for r in df.select(composite_key("k", "v")).collect()] == ["a_1.0", None]
    flags = threshold_flags(df, "v", [0, 2.5])
    assert flags.columns == ["k", "v", "above_0", "above_2.5"]
    assert [tuple(r)[2:] for r in flags.collect()] == [(1, 0), (1, 1)]


def test_rules_in_order(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 200.0), (3, None)], "id int, v double")
    rules = {
        "known": {"type": "filter", "condition": F.col("v").isNotNull()},
        "double": {"type": "derive_column", "column": "w", "expression": F.col("v") * 2},
        "size": {"type": "categorize", "column": "w",
                 "categories": {"L": "w > 100", "M": F.col("w") > 50}},
        "none": {"type": "categorize", "column": "id", "categories": {}},
    }
    assert [tuple(r) for r in apply_business_rules(df, rules).orderBy("id").collect()] == [
        (1, 10.0, 20.0, "Other", "Other"), (2, 200.0, 400.0, "L", "Other")]


def test_unknown_rule_type(spark):
    with pytest.raises(ValueError, match="unknown rule types"):
        apply_business_rules(named(spark, "a"), {"x": {"type": "explode"}})


def test_udfs_take_nulls_like_built_ins(spark):
    df = spark.createDataFrame([("é", 5.0), (None, None), ("b", 500.0)], "s string, v double")
    bounds = {"high": 100.0}
    row = df.select(
        udfs.upper_udf("s").alias("u"), F.upper("s").alias("nu"),
        udfs.size_category_udf(bounds, "low")("v").alias("c"),
        udfs.size_category(F.col("v"), bounds, "low").alias("nc"),
        udfs.key_udf("s", "v").alias("k"), udfs.key("s", "v").alias("nk"))
    for r in row.collect():
        assert (r.u, r.c, r.k) == (r.nu, r.nc, r.nk)


def test_broadcast_lookup_beyond_limit_joins(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    lookup = spark.createDataFrame([(1, 10), (3, None), (None, 99)], "key int, name int")
    small = udfs.broadcast_lookup(df, "k", lookup, "key", "name", "n")
    large = udfs.broadcast_lookup(df, "k", lookup, "key", "name", "n", limit_bytes=0)
    assert small.dtypes == large.dtypes
    expected = {(1, "10"), (2, "unknown"), (3, "unknown"), (None, "unknown")}
    assert set(map(tuple, small.collect())) == set(map(tuple, large.collect())) == expected
