import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from etlkit.operators.bitmaps import DistinctStore

SCHEMA = "day int, `user id` long, price double, name string, raw binary, seen timestamp"


def some(n, seed):
    rng = random.Random(seed)

    def maybe(value):
        return None if rng.random() < 0.1 else value
    return [(maybe(rng.randrange(3)), maybe(rng.randrange(40)), maybe(rng.choice([0.0, -0.0, 1.5, float("nan")])),
             maybe(rng.choice(["", "null", "=", "a", "A"])), maybe(rng.choice([b"", b"\0", b"a"])),
             maybe(datetime(2024, 1, rng.randrange(1, 9)))) for _ in range(n)]


@pytest.fixture
def store(spark, tmp_path):
    return DistinctStore(spark, str(tmp_path / "s"), ["user id", "price", "name", "raw", "seen"], ["day", "name"])


def counted(df):
    return {tuple(r) for r in df.collect()}


def plain(df, columns, by):
    found = set()
    for c in columns:
        for r in df.select(*[F.col(f"`{b}`").alias(f"g{i}") for i, b in enumerate(by)],
                           F.col(f"`{c}`").alias("v")).distinct().groupBy(
                               *[f"g{i}" for i in range(len(by))]).count().collect():
            found.add((*r[:len(by)], c, r[len(by)]))
    return found


def test_every_grouping_of_every_load_equals_plain_counts(spark, store):
    batches = [spark.createDataFrame(some(n, n), SCHEMA) for n in (60, 90, 40)]
    for i, batch in enumerate(batches):
        store.add(batch, i)
    for chosen in ([1, 2], [0, 1, 2]):
        rows = batches[chosen[0]]
        for i in chosen[1:]:
            rows = rows.unionAll(batches[i])
        for by in ([], ["name", "day"]):
            assert counted(store.counts(by, chosen)) == plain(rows, store.columns, by)


def test_values_beyond_one_bucket(spark, tmp_path):
    store = DistinctStore(spark, str(tmp_path / "s"), ["id"], ["half"])
    rows = spark.range(100_000).selectExpr("id % 70000 AS id", "id < 50000 AS half")
    store.add(rows, 0)
    store.add(spark.range(69_990, 70_010).selectExpr("id", "true AS half"), 1)
    assert counted(store.counts()) == {("id", 70_010)}
    assert counted(store.counts(["half"])) == {(True, "id", 50_020), (False, "id", 50_000)}
    plan = store.counts()._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_loads_repeat_and_ones_that_died_are_written_anew(spark, store, tmp_path):
    store.add(spark.createDataFrame(some(30, 1), SCHEMA), 0)
    before = counted(store.counts())
    store.add(spark.createDataFrame(some(30, 2), SCHEMA), 0)
    assert counted(store.counts()) == before
    store.add(spark.createDataFrame(some(30, 2), SCHEMA), 1)
    (tmp_path / "s/bitmaps/load=1/_SUCCESS").unlink()
    assert store.loads() == [0] and counted(store.counts()) == before
    store.add(spark.createDataFrame(some(30, 1), SCHEMA), 1)
    assert counted(store.counts()) == before


def test_empty_loads_and_wrong_names(spark, store, tmp_path):
    with pytest.raises(ValueError, match="no load"):
        store.counts()
    store.add(spark.createDataFrame([], SCHEMA), 7)
    assert counted(store.counts()) == set()
    for wrong in ({"by": ["price"]}, {"loads": [8]}):
        with pytest.raises(ValueError, match="not in the store"):
            store.counts(**wrong)
    with pytest.raises(ValueError, match="uses itself"):
        DistinctStore(spark, str(tmp_path), ["a"], ["Bucket"])
    nested = DistinctStore(spark, str(tmp_path / "n"), ["a"])
    with pytest.raises(TypeError, match="array"):
        nested.add(spark.range(1).selectExpr("array(id) AS a"), 0)
