"""Scores against a computation in plain Python, and the cases."""

import math
from collections import Counter

import pytest

from etlkit.llm import lm_scoring as lm
from etlkit.llm.queries import QUERIES
from etlkit.llm.shingles import word_hashes


def brute(rows, targets):
    """(words, target loss, background loss) of each (id, text), with counts in dictionaries."""
    coded = []
    for _, text in rows:
        classes, cells, _ = lm.classes_and_cells(*word_hashes([text]))
        coded.append((classes.tolist(), cells.tolist()[1:]))
    uni, bi = [Counter(), Counter()], [Counter(), Counter()]
    for (i, _), (classes, cells) in zip(rows, coded):
        for m in (0, 1) if i in targets and i is not None else (1,):
            uni[m].update(classes)
            bi[m].update(cells)
    scale = [1.0, sum(uni[0].values()) / max(1, sum(uni[1].values()))]
    out = []
    for (i, _), (classes, cells) in zip(rows, coded):
        losses = []
        for m in (0, 1):
            inside = m == 1 or (i in targets and i is not None)
            own_u, own_b = (Counter(classes), Counter(cells)) if inside else (Counter(), Counter())
            total = (sum(uni[m].values()) - sum(own_u.values())) * scale[m]
            loss = 0.0
            for k, c in enumerate(classes):
                p = ((uni[m][c] - own_u[c]) * scale[m] + 1) / (total + len(uni[1]))
                if k:
                    pair = (bi[m][cells[k - 1]] - own_b[cells[k - 1]]) * scale[m]
                    before = (uni[m][classes[k - 1]] - own_u[classes[k - 1]]) * scale[m]
                    p = (pair + lm.PRIOR * p) / (max(before, pair) + lm.PRIOR)
                loss -= math.log(p)
            losses.append(loss / len(classes) if classes else None)
        out.append((i, len(classes), *losses))
    return out


def same(found, want):
    got = sorted(((r["doc_id"], r["n_words"], r["target_loss"], r["background_loss"]) for r in found), key=str)
    assert [g[:2] for g in got] == [w[:2] for w in sorted(want, key=str)]
    for g, w in zip(got, sorted(want, key=str)):
        for x, y in zip(g[2:], w[2:]):
            assert x == y if y is None else x == pytest.approx(y, rel=1e-6)


def test_query_equals_brute_force(spark, sf, tables):
    rows = [(r["doc_id"], r["text"]) for r in tables("documents").collect()]
    good = {r["doc_id"] for r in tables("labels").filter("quality = 1").collect()}
    found = QUERIES["op5_lm_scores"](spark, sf).collect()
    same(found, brute(rows, good))
    assert all(r["score"] == r["target_loss"] - r["background_loss"] for r in found)


def test_target_like_documents_score_lower(spark):
    good = [f"the cat {w} on the mat and sleeps" for w in ("sits", "lies", "stands", "naps")] * 5
    bad = [f"buy {w} pills now cheap offer click" for w in ("red", "blue", "green", "pink")] * 20
    rows = list(enumerate(good + bad + ["the cat naps on the mat", "buy pink pills now"]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    targets = spark.createDataFrame([(i,) for i in range(10)], "doc_id long")
    score = {r["doc_id"]: r["score"] for r in lm.difference_scores(docs, targets).collect()}
    assert score[len(rows) - 2] < 0 < score[len(rows) - 1]
    assert max(score[i] for i in range(10, 20)) < min(score[i] for i in range(20, 100))


def test_cases(spark):
    rows = [(1, "a b a b"), (1, "a b a b"), (2, None), (3, ""), (None, "a c"), (4, "w " * 40000), (5, "one")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, target int, named string")
    targets = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (77, 1)], "doc_id long, quality int")
    same(lm.difference_scores(docs, targets).collect(), brute(rows, {1}))
    same(lm.difference_scores(docs, targets.limit(0)).collect(), brute(rows, set()))
    assert lm.difference_scores(docs.limit(0), targets).collect() == []


def test_counts_are_those_of_real_words_and_pairs(spark, monkeypatch):
    """A word in every text, next to more others than any table of fixed size would keep apart."""
    monkeypatch.setattr(lm, "RANGE_BYTES", 1 << 16)
    rows = [(i, " ".join(f"the w{i}x{k}" for k in range(400))) for i in range(2500)]
    rows += [(-1, rows[0][1]), (-2, "the unseen")]
    uni, bi = Counter(), Counter()
    for _, text in rows:
        words = text.split()
        uni.update(words)
        bi.update(zip(words, words[1:]))
    found = {r["doc_id"]: r for r in lm.difference_scores(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(8),
        spark.createDataFrame([(i,) for i in range(-2, 2500)], "doc_id long")).collect()}
    for i, text in (rows[0], rows[7], rows[1234], rows[-1], rows[-2]):
        words = text.split()
        own_u, own_b = Counter(words), Counter(zip(words, words[1:]))
        total, loss = sum(uni.values()) - len(words), 0.0
        for k, w in enumerate(words):
            p = (uni[w] - own_u[w] + 1) / (total + len(uni))
            if k:
                pair = (words[k - 1], w)
                seen = bi[pair] - own_b[pair]
                p = (seen + lm.PRIOR * p) / (max(uni[words[k - 1]] - own_u[words[k - 1]], seen) + lm.PRIOR)
            loss -= math.log(p)
        assert found[i]["background_loss"] == pytest.approx(loss / len(words), rel=1e-9)
        assert found[i]["target_loss"] == pytest.approx(loss / len(words), rel=1e-9)
