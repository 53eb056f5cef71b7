"""Mixing against a plain computation and its cases."""

from collections import Counter

import oracle
import pytest

from etlkit.llm import mixing
from etlkit.llm.queries import ORACLES, QUERIES


def shares(sizes: dict) -> dict:
    """Targets by repeated sharing, as the words say it."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        part = left / sum(weight[s] for s in free)
        above = {s for s in free if part * weight[s] > 3 * sizes[s]}
        if not above:
            return target | {s: part * weight[s] for s in free}
        for s in above:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= above
    return target


def test_equals_sql(spark, sf):
    assert oracle.compare(oracle.connect(sf), ORACLES["op10_mix_sources"], QUERIES["op10_mix_sources"](spark, sf)) is None


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1, "c": 1, None: 50}, {"a": 1, "b": 1000, "c": 2, "d": 3, "e": 1}, {"only": 7},
    {"a": 0, "b": 5}, {"a": 0}])
def test_targets(spark, sizes):
    rows = [("w " * n, s) for s, n in sizes.items()]
    docs = spark.createDataFrame(rows, "text string, source string")
    got = {r["source"]: r["target"] for r in mixing.source_targets(docs).collect()}
    assert got == pytest.approx(shares(sizes))


def test_taken_words_come_near_the_target_and_repeat(spark):
    docs = spark.range(20000).selectExpr(
        "id as doc_id", "repeat('w ', cast(1 + id % 50 as int)) as text",
        "case when id % 3 = 0 then 'hot' else concat('s', id % 7) end as source")
    first = mixing.copies(docs).selectExpr("doc.doc_id", "doc.source", "size", "target", "copies").collect()
    again = mixing.copies(docs.repartition(7)).selectExpr("doc.doc_id", "doc.source", "size", "target", "copies").collect()
    assert sorted(map(tuple, first), key=str) == sorted(map(tuple, again), key=str)
    taken, target = Counter(), {}
    for r in first:
        assert r["copies"] <= 3
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
    for source, words in taken.items():
        assert words == pytest.approx(target[source], rel=0.1)


def test_cases(spark):
    rows = [(1, None, "a", 1, 2.0), (2, "", None, 1, 2.0), (None, "x y", None, 1, 2.0), (3, "p q r", "a", 1, 2.0),
            (3, "p q r", "a", 1, 2.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, target double")
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    counts = Counter(tuple(r) for r in out.collect())
    assert set(counts) <= set(rows)
    assert mixing.mixed(docs.limit(0)).collect() == []
