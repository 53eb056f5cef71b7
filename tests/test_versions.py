import pytest
from pyspark.sql import functions as F, types as T

from etlkit.sources.versions import IncompatibleSchema, VersionedTable, widens


def schema(text):
    return T._parse_datatype_string(text)


@pytest.fixture
def store(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def three(spark, store):
    store.declare(schema("id int, name string, size int"))
    store.append(spark.createDataFrame([(1, "a", 5), (None, None, None)], "id int, name string, size int"))
    store.declare(schema("id long, label string, size int, price decimal(6,2)"), renamed={"label": "name"})
    store.append(spark.createDataFrame([(2**40, "b", 6)], "id long, label string, size int")
                 .withColumn("price", F.lit("1.50").cast("decimal(6,2)")))
    store.declare(schema("id long, label string, price decimal(8,3), brand string"), defaults={"brand": "none"})
    store.append(spark.createDataFrame([(3, "c", "x")], "id int, label string, brand string")
                 .withColumn("price", F.lit("2.5").cast("decimal(4,1)")))
    return store


def test_three_versions_read_as_one(spark, store):
    got = [(r[0], r[1], None if r[2] is None else float(r[2]), r[3]) for r in three(spark, store).read().collect()]
    assert sorted(got, key=str) == sorted(
        [(1, "a", None, "none"), (None, None, None, "none"), (2**40, "b", 1.5, "none"), (3, "c", 2.5, "x")], key=str)
    assert store.read().schema == store.schema() == schema(
        "id long, label string, price decimal(8,3), brand string")
    assert store.changes() == [
        (2, "widened", "id"), (2, "renamed", "label"), (2, "added", "price"),
        (3, "widened", "price"), (3, "added", "brand"), (3, "dropped", "size")]


def test_newer_rows_read_as_an_older_version(spark, store):
    store.declare(schema("id int, note string"))
    store.append(spark.createDataFrame([(1, "a")], "id int, note string"))
    store.declare(schema("id int, extra string"))
    store.append(spark.createDataFrame([(2, "e")], "id int, extra string"))
    assert rows(store.read(1)) == [(1, "a"), (2, None)]
    store.declare(schema("id long, extra string"))
    store.append(spark.createDataFrame([(2**40, "e")], "id long, extra string"))
    with pytest.raises(IncompatibleSchema, match="may not fit int"):
        store.read(1)
    assert rows(store.read()) == [(1, None), (1099511627776, "e"), (2, "e")]


def test_a_name_used_anew_is_a_new_column(spark, store):
    store.declare(schema("id int, code int"))
    store.append(spark.createDataFrame([(1, 7)], "id int, code int"))
    store.declare(schema("id int"))
    store.declare(schema("id int, code string"), defaults={"code": "new"})
    store.append(spark.createDataFrame([(2, "x")], "id int, code string"))
    assert rows(store.read()) == [(1, "new"), (2, "x")]
    assert rows(store.read(1)) == [(1, 7), (2, None)]


def test_names_can_be_exchanged(spark, store):
    store.declare(schema("a int, b int"))
    store.append(spark.createDataFrame([(1, 2)], "a int, b int"))
    store.declare(schema("a int, b int"), renamed={"a": "b", "b": "a"})
    assert rows(store.read()) == [(2, 1)]


@pytest.mark.parametrize("change, options", [
    ("id int, v int", {}), ("id string, v long", {}), ("id long, v double", {}), ("id int, v long, V int", {}),
    ("id int, w long", {"renamed": {"w": "x"}}), ("id int, v long, w long", {"renamed": {"w": "v"}}),
    ("id int, v long", {"defaults": {"v": 1}}), ("id int, v long", {"defaults": {"z": 1}}),
])
def test_incompatible_versions_raise_and_change_nothing(spark, store, change, options):
    store.declare(schema("id int, v long"))
    with pytest.raises(IncompatibleSchema):
        store.declare(schema(change), **options)
    assert store.version() == 1 and store.schema() == schema("id int, v long")


def test_rows_must_fit_the_version(spark, store):
    with pytest.raises(IncompatibleSchema, match="never declared"):
        store.append(spark.range(1))
    store.declare(schema("id int"))
    for wrong in [spark.range(1), spark.range(1).selectExpr("1 AS id", "2 AS more"),
                  spark.range(1).selectExpr("1 AS id", "2 AS id")]:
        with pytest.raises(IncompatibleSchema):
            store.append(wrong)
    assert store.read().count() == 0 and store.declare(schema("id int")) == 1


def test_loads_repeat_and_unfinished_ones_are_not_read(spark, store, tmp_path):
    store.declare(schema("id int"))
    one = spark.createDataFrame([(1,)], "id int")
    store.append(one, load="day1")
    store.append(one, load="day1")
    assert rows(store.read()) == [(1,)]
    (tmp_path / "t/data/version=1/load=day1/_SUCCESS").unlink()
    assert rows(store.read()) == []
    store.declare(schema("id long"))
    store.append(one, load="day1")
    assert rows(store.read()) == [(1,)]


def test_filters_and_columns_reach_the_files(spark, store):
    plan = (three(spark, store).read().filter("label = 'a'").select("label")
            ._jdf.queryExecution().executedPlan().toString())
    assert plan.count("EqualTo(name,a)") == 1 and plan.count("EqualTo(label,a)") == 2
    assert "price" not in plan and "ReadSchema: struct<name:string>" in plan


@pytest.mark.parametrize("old, new, fits", [
    ("int", "bigint", True), ("bigint", "int", False), ("int", "double", True), ("bigint", "double", False),
    ("int", "float", False), ("float", "double", True), ("int", "decimal(10,0)", True),
    ("int", "decimal(10,1)", False), ("decimal(6,2)", "decimal(8,3)", True),
    ("decimal(6,2)", "decimal(7,3)", True), ("decimal(6,2)", "decimal(6,3)", False), ("date", "timestamp", False),
    ("array<int>", "array<int>", True), ("array<int>", "array<bigint>", False), ("string", "string", True),
])
def test_widening(old, new, fits):
    kind = schema(f"a {old}, b {new}")
    assert widens(kind["a"].dataType, kind["b"].dataType) is fits
