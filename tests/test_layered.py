"""Layered tables: replays, crashes between any two steps, partitions, compaction."""

import glob
import os
from datetime import date

import pytest
from pyspark.sql import functions as F, types as T

from etlkit.sources import layered
from etlkit.sources.layered import LayeredTable
from etlkit.streaming.files import compact_updates, latest_rows, stream_files, write_batches

ROW = "k int, p string, v double"
SCHEMA = T.StructType().add("k", "integer").add("p", "string").add("v", "double")


@pytest.fixture
def table(spark, tmp_path):
    return LayeredTable(spark, f"{tmp_path}/t", SCHEMA, ["k"], "p", "op")


def load(spark, rows):
    return spark.createDataFrame(rows, f"{ROW}, op string")


def content(table):
    return sorted((tuple(r) for r in table.read().collect()), key=str)


def files(tmp_path, layer="*", part="*"):
    return sorted(glob.glob(f"{tmp_path}/t/base/layer={layer}/p={part}/*.parquet"))


FIRST = [(1, "01", 1.0, None), (2, "007", 2.0, None), (3, "2024-01-05", 3.0, None), (4, None, 4.0, None),
         (5, "", 5.0, None), (6, "a/b=c%[x] +é", 6.0, None), (None, "01", 7.0, None), (8, "quiet", 8.0, None)]
SECOND = [(1, "007", 10.0, "U"), (3, None, 3.0, "D"), (9, "1", 9.0, "I"), (None, "01", 70.0, "U"), (6, "x", 60.0, "U")]
AFTER = sorted([(1, "007", 10.0), (2, "007", 2.0), (4, None, 4.0), (5, None, 5.0), (6, "x", 60.0), (None, "01", 70.0),
                (8, "quiet", 8.0), (9, "1", 9.0)], key=str)


def test_text_partitions_keep_their_values(spark, table, tmp_path):
    table.merge(load(spark, FIRST))
    assert content(table) == sorted(((k, p or None, v) for k, p, v, _ in FIRST), key=str)
    quiet = files(tmp_path, part="quiet")
    table.merge(load(spark, SECOND))
    assert content(table) == AFTER
    table.vacuum()
    assert content(table) == AFTER
    assert files(tmp_path, part="quiet") == quiet
    assert not glob.glob(f"{tmp_path}/t/base/*/p=2024*") and not glob.glob(f"{tmp_path}/t/delta/*/*")


@pytest.mark.parametrize("kind, values", [("date", [date(2024, 1, 5), date(2024, 2, 1), None]), ("integer", [1, -7, None]), ("double", [0.5, 1e20, None])])
def test_typed_partitions(spark, tmp_path, kind, values):
    schema = T.StructType().add("k", "integer").add("p", kind)
    table = LayeredTable(spark, f"{tmp_path}/t", schema, ["k"], "p")
    table.merge(spark.createDataFrame(list(enumerate(values)), schema))
    table.merge(spark.createDataFrame([(1, values[0]), (7, values[2])], schema))
    assert sorted(map(tuple, table.read().collect()), key=str) == sorted(
        [(0, values[0]), (1, values[0]), (2, None), (7, None)], key=str)
    assert table.read().schema == schema


def test_a_replayed_load_touches_only_itself(spark, table):
    table.write_delta(load(spark, FIRST), 0)
    table.write_delta(load(spark, SECOND), 1)
    assert content(table) == AFTER
    table.compact()
    assert table.batches() == [1] and content(table) == AFTER
    table.write_delta(load(spark, SECOND), 1)
    assert content(table) == AFTER
    table.write_delta(load(spark, [(1, "01", 11.0, "U")]), 1)  # another try that saw other rows
    assert dict((k, v) for k, _, v in content(table)) == {r[0]: r[2] for r in FIRST} | {1: 11.0}
    table.write_delta(load(spark, [(1, "01", 0.0, "D")]), 0)  # folded already
    assert (1, "01", 11.0) in content(table)
    table.vacuum()
    assert (1, "01", 11.0) in content(table) and table.batches() == [1]


class Crash(Exception):
    pass


@pytest.mark.parametrize("partitioned", [True, False])
@pytest.mark.parametrize("step", ["before the layer", "after the layer", "before the marker", "within the marker"])
def test_a_crash_between_two_steps_reads_the_same(spark, tmp_path, monkeypatch, step, partitioned):
    table = LayeredTable(spark, f"{tmp_path}/t", SCHEMA, ["k"], "p" if partitioned else None, "op")
    table.merge(load(spark, FIRST))
    table.write_delta(load(spark, SECOND), 1)
    before = content(table)
    write, put = LayeredTable._write_layer, LayeredTable._put_marker

    def layer(self, rows, number, files=None):
        if step == "before the layer":
            raise Crash
        done = write(self, rows, number, files)
        if step == "after the layer":
            raise Crash
        return done

    def marker(self, found):
        if step == "before the marker":
            raise Crash
        put(self, found)
        newest = max(os.listdir(f"{tmp_path}/t/_markers"))
        if step == "within the marker" and not newest.endswith(".crc"):
            path = f"{tmp_path}/t/_markers/{newest}"
            text = open(path).read()
            os.unlink(f"{tmp_path}/t/_markers/.{newest}.crc")
            open(path, "w").write(text[:len(text) // 2])
            raise Crash

    with monkeypatch.context() as patch:
        patch.setattr(LayeredTable, "_write_layer", layer)
        patch.setattr(LayeredTable, "_put_marker", marker)
        with pytest.raises(Crash):
            table.compact(newest=True)
    assert content(table) == before
    table.compact(newest=True)
    assert content(table) == before and table.batches() == []
    table.vacuum()
    assert content(table) == before
    table.merge(load(spark, [(1, "01", 12.0, "U")]))
    assert (1, "01", 12.0) in content(table) and len(content(table)) == len(before)


def test_a_crash_within_vacuum_or_a_load_reads_the_same(spark, table, tmp_path, monkeypatch):
    table.merge(load(spark, FIRST))
    table.merge(load(spark, SECOND))
    real, calls = layered.file_system, []

    class Failing:
        def __init__(self, system):
            self.system = system

        def delete(self, path, deep):
            calls.append(path)
            if len(calls) > stop:
                raise Crash
            return self.system.delete(path, deep)

        def __getattr__(self, name):
            return getattr(self.system, name)

    for stop in range(3):
        calls.clear()
        with monkeypatch.context() as patch:
            patch.setattr(layered, "file_system", lambda *a, **k: (Failing(real(*a, **k)[0]), real(*a, **k)[1]))
            with pytest.raises(Crash):
                table.vacuum()
        assert content(table) == AFTER
    # A load that died half-way has no mark of its end.
    load(spark, [(1, "zz", 0.0, "U")]).write.parquet(f"{tmp_path}/t/delta/batch_id=2/attempt=0")
    os.unlink(f"{tmp_path}/t/delta/batch_id=2/attempt=0/_SUCCESS")
    assert content(table) == AFTER
    table.write_delta(load(spark, [(1, "zz", 1.5, "U")]), 2)
    assert (1, "zz", 1.5) in content(table)


def test_two_compactions_at_once(spark, table, monkeypatch):
    table.write_delta(load(spark, FIRST), 0)
    put = LayeredTable._put_marker

    def late(self, found):
        with monkeypatch.context() as patch:
            patch.setattr(LayeredTable, "_put_marker", put)
            table.compact(newest=True)
        names = LayeredTable._names
        with monkeypatch.context() as patch:  # the first one had listed the markers before
            patch.setattr(LayeredTable, "_names", lambda s, f: [] if f == "_markers" else names(s, f))
            put(self, found)

    monkeypatch.setattr(LayeredTable, "_put_marker", late)
    with pytest.raises(Exception, match="already exists"):
        table.compact(newest=True)
    assert content(table) == sorted(((k, p or None, v) for k, p, v, _ in FIRST), key=str)


def test_one_partition_becomes_few_files(spark, tmp_path):
    table = LayeredTable(spark, f"{tmp_path}/t", SCHEMA, ["k"], "p")
    rows = spark.range(400).selectExpr("cast(id as int) k", "case when id % 2 = 0 then '01' else null end p", "id * 0.5D v")
    table.merge(rows)
    part = rows.filter("p = '01'").repartition(5)
    (part.write.partitionBy("p").parquet(f"{tmp_path}/t/base/layer=7"))
    table._put_marker({"base": table._marker()[1]["base"] | {"p=01": 7}, "upto": 0})
    others = files(tmp_path, 0, "__HIVE*")
    assert len(files(tmp_path, 7, "01")) == 5
    table.rewrite_partition("01")
    table.vacuum()
    assert len(files(tmp_path, "*", "01")) == 1 and files(tmp_path, "*", "__HIVE*") == others
    assert {tuple(r) for r in table.read().collect()} == {tuple(r) for r in rows.collect()}
    table.rewrite_partition("missing")


def test_untouched_partitions_are_not_read(spark, table, tmp_path):
    table.merge(load(spark, [(i, f"p{i % 10}", 1.0, None) for i in range(100)]))
    table.merge(load(spark, [(3, "p3", 2.0, "U")]))
    assert len(files(tmp_path, 1)) == 1
    assert sum(v for _, _, v in content(table)) == 101.0


def test_a_stream_replays_its_newest_batch_after_compaction(spark, tmp_path):
    """The batch is written but not committed; compaction runs; the restarted stream writes it again."""
    for i in range(3):
        spark.range(10 * (i + 1)).selectExpr("id % 30 as k", "1 as n").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema

    def run():
        stream = stream_files(spark, f"{tmp_path}/in", schema, maxFilesPerTrigger=1).groupBy("k").agg(F.sum("n").alias("n"))
        write_batches(stream, f"{tmp_path}/out", f"{tmp_path}/cp")
        return stream.schema

    out = run()
    before = {tuple(r) for r in latest_rows(spark, f"{tmp_path}/out", out, ["k"]).collect()}
    assert sum(n for _, n in before) == 60 and len(before) == 30
    newest = max(map(int, (n for n in os.listdir(f"{tmp_path}/cp/commits") if n.isdigit())))
    os.unlink(f"{tmp_path}/cp/commits/{newest}")
    for extra in glob.glob(f"{tmp_path}/cp/commits/.{newest}.crc"):
        os.unlink(extra)
    compact_updates(spark, f"{tmp_path}/out", out, ["k"])
    assert {tuple(r) for r in latest_rows(spark, f"{tmp_path}/out", out, ["k"]).collect()} == before
    run()
    assert {tuple(r) for r in latest_rows(spark, f"{tmp_path}/out", out, ["k"]).collect()} == before
    log = LayeredTable(spark, f"{tmp_path}/out", out, ["k"])
    assert log.batches() == [newest]
