"""Top products against brute force."""

import numpy as np
import oracle
import pytest

from etlkit.llm import top_products as tp
from etlkit.llm.queries import ORACLES, QUERIES


def brute(rows, k=10, every=100):
    fine = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    if not fine:
        return []
    out = []
    for q in sorted({i for i, _ in fine if i % every == 0}):
        for own in [v for i, v in fine if i == q][:1]:
            scored = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in fine if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return out


def found(frame):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in frame.collect())


def test_query_equals_sql(spark, sf):
    assert oracle.compare(oracle.connect(sf), ORACLES["op8_top_products"], QUERIES["op8_top_products"](spark, sf)) is None


@pytest.mark.parametrize("kind", ["clusters", "lengths", "equal", "negative", "large"])
def test_equals_brute_force(spark, kind):
    rng = np.random.default_rng(7)
    v = rng.normal(size=(1500, 8))
    if kind == "clusters":
        v = v[rng.integers(0, 12, 1500)] + 0.05 * rng.normal(size=(1500, 8))
    if kind == "lengths":
        v *= rng.pareto(1.0, (1500, 1))
    if kind == "equal":
        v[::2] = v[0]
    if kind == "negative":
        v = -np.abs(v)
        v[::100] *= -1
    if kind == "large":
        v *= 1e5
    rows = [(int(i), x) for i, x in enumerate(v.tolist())]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(tp.top_products(docs, block=6)) == brute(rows)


def test_cases(spark):
    rows = [(0, [1.0, 2.0]), (100, None), (200, [float("nan"), 1.0]), (300, [None, 1.0]), (400, []), (None, [1.0, 1.0]),
            (500, [float("inf"), 0.0]), (5, [0.0, 0.0]), (6, [1.0, 2.0]), (7, [1.0, 2.0]), (6, [1.0, 2.0]), (600, [0.0, 0.0])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, length string")
    assert found(tp.top_products(docs)) == sorted(brute(rows))
    assert tp.top_products(docs.limit(0)).collect() == []
    assert tp.top_products(docs.filter("vec_id = 5")).collect() == []


def test_vectors_of_several_widths_raise(spark):
    rows = spark.createDataFrame([(100, [1.0, 2.0]), (1, [1.0]), (2, None)], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="1 to 2 components"):
        tp.top_products(rows)
