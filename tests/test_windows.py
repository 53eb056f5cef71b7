import random

import pytest
from pyspark.sql import Window, functions as F

from etlkit.operators import windows
from etlkit.operators.sizing import hot_keys
from etlkit.operators.windows import forward_fill, number_rows
from plan_asserts import initial_plan


@pytest.fixture
def series(spark):
    draw = random.Random(3)
    rows = []
    for i in range(600):
        key = None if i % 50 == 0 else ("hot" if i % 3 == 0 else f"k{draw.randrange(9)}")
        value = draw.random() if draw.random() < 0.3 else None
        rows.append((i, key, draw.randrange(400), value, "x" if value and value > 0.5 else None))
    df = spark.createDataFrame(rows, "id int, key string, minute int, v double, s string")
    at = F.timestamp_seconds(F.col("minute") * 60 + 1_700_000_000)
    return df.withColumn("ts", at).repartition(5)


def plain_fill(df, keys):
    window = (Window.partitionBy(*keys).orderBy("ts", "id")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumns({c: F.last(c, True).over(window) for c in ("v", "s")})


@pytest.mark.parametrize("share", [0.0001, 0.2, 2.0], ids=["all hot", "one hot", "none hot"])
def test_forward_fill_equals_plain_window(series, share):
    filled = forward_fill(series, ["v", "s"], ["key"], ["ts", "id"], share=share)
    assert filled.columns == series.columns
    assert set(filled.collect()) == set(plain_fill(series, ["key"]).collect())


def test_forward_fill_without_keys(series):
    filled = forward_fill(series, ["v", "s"], [], ["ts", "id"])
    assert set(filled.collect()) == set(plain_fill(series, []).collect())


def test_forward_fill_of_empty_frame(series):
    empty = forward_fill(series.limit(0), ["v"], ["key"], ["ts", "id"])
    assert empty.schema.names == series.schema.names and empty.count() == 0


def test_numeric_and_null_order(series):
    gaps = series.withColumn("at", F.when(F.col("id") % 7 != 0, F.col("minute")))
    filled = forward_fill(gaps, ["v"], ["key"], ["at", "id"], share=0.0001)
    window = Window.partitionBy("key").orderBy("at", "id")
    expected = gaps.withColumn("v", F.last("v", True).over(window.rowsBetween(Window.unboundedPreceding, 0)))
    assert set(filled.collect()) == set(expected.collect())


@pytest.mark.parametrize("share", [0.0001, 0.2, 2.0])
def test_number_rows_equals_row_number(series, share):
    numbered = number_rows(series, ["key"], ["ts", "id"], share=share, name="n")
    window = Window.partitionBy("key").orderBy("ts", "id")
    expected = series.withColumn("n", F.row_number().over(window).cast("long"))
    assert set(numbered.collect()) == set(expected.collect())


def test_a_hot_key_at_one_moment_is_spread(spark):
    """One key with 90% of the rows, all of one date, is cut into chunks of like size."""
    rows = spark.range(20_000).selectExpr(
        "id", "case when id % 10 = 0 then id else -1 end as key", "date'2024-01-01' as day",
        "case when id % 13 = 0 then id end as v").repartition(6)
    hot = hot_keys(rows, ["key"], 0.2)
    cut = windows._with_chunks(rows, ["key"], ["day", "id"], hot)
    sizes = [r["count"] for r in cut.filter("key = -1").groupBy("__chunk").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 2.5 * 18_000 / len(sizes)
    assert cut.filter("key <> -1 AND __chunk IS NOT NULL").count() == 0
    ordered = cut.filter("key = -1").groupBy("__chunk").agg(F.min("id").alias("low"), F.max("id").alias("high")) \
        .orderBy("__chunk").collect()
    assert all(a["high"] < b["low"] for a, b in zip(ordered, ordered[1:]))
    numbered = number_rows(rows, ["key"], ["day", "id"], share=0.2)
    expected = rows.withColumn("row_number", F.row_number().over(Window.partitionBy("key").orderBy("day", "id")).cast("long"))
    assert numbered.exceptAll(expected).count() == 0 and numbered.count() == 20_000
    assert initial_plan(numbered).count("Exchange hash") <= 3  # the data once, the table of chunks twice
