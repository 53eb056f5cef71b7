"""Quality rules: counts by plain loops, estimates by a plain computation, cases."""

import itertools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from etlkit.llm import quality_rules as rules
from etlkit.llm.queries import QUERIES
from etlkit.llm.text_statistics import COUNTS, text_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    repeated = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += bool(WORD.search(line)) and line in seen
        seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated))


PARTS = st.sampled_from(["a", "b", "é", "日本", "#", "x|y", " ", " ", "\n", "\t", "\x1c", " ", "a b c d e f g h ", "a b\n", "\0"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.none() | st.lists(PARTS, max_size=40).map("".join), max_size=6))
def test_counts(texts):
    found = text_counts(texts)
    assert list(zip(*(found[n].tolist() for n in COUNTS))) == [brute_counts(t) for t in texts]


def vector(counts):
    words, chars, symbols, dup, repeat = counts
    shares = [math.asin(math.sqrt(min(1.0, x / words))) for x in (symbols, dup, repeat)]
    return [math.floor(v * 1024 + 0.5) for v in (math.log(chars / words), *shares)]


def brute_estimate(x):
    """Reweighted estimate of the rows of ``x``, by the words of the module's docstring."""
    def middle(v):
        return np.sort(v)[(len(v) + 1) // 2 - 1]

    noise = np.eye(4) * rules.NOISE * 1024**2
    mid = np.array([middle(x[:, i]) for i in range(4)])
    scale = np.array([max(1.4826 * middle(np.abs(x[:, i] - mid[i])), math.sqrt(rules.NOISE) * 1024) for i in range(4)])
    z = (x - mid) / scale
    norm = (z**2).sum(axis=1)
    unit = np.array([r / math.sqrt(n) if n > 0 else r * 0 for r, n in zip(z, norm)])
    bent = np.cov(np.tanh(z).T, bias=True)
    width = np.sqrt(np.maximum(np.diag(bent), 1e-6))
    found = []
    for shape in (np.eye(4), 4 * unit.T @ unit / len(x), bent / np.outer(width, width)):
        mean, scatter, last = mid.astype(float), shape * np.outer(scale, scale) + noise, None
        det = math.inf
        for step in range(rules.STEPS):
            d = np.einsum("ni,ij,nj->n", x - mean, np.linalg.inv(scatter), x - mean)
            steps = np.array([math.floor(math.log2(v) * 16) if v > 0 else -(1 << 20) for v in d])
            near = steps <= np.sort(steps)[math.ceil(0.75 * len(x)) - 1]
            mean, scatter = x[near].mean(axis=0), np.cov(x[near].T, bias=True) * rules.consistency(near.mean()) + noise
            det, before = np.linalg.slogdet(scatter)[1], det
            if step < 2:
                tried = det
            if last is not None and (near == last).all() or det >= before - rules.LEAST_GAIN:
                break
            last = near
        found.append((round(tried, 9), len(found), mean, scatter))
    _, _, mean, scatter = min(found, key=lambda f: f[:2])
    near = np.einsum("ni,ij,nj->n", x - mean, np.linalg.inv(scatter), x - mean) <= rules.chi_square_quantile(0.975, 4)
    return x[near].mean(axis=0), np.cov(x[near].T, bias=True) * rules.consistency(0.975) + noise


def test_query_equals_a_plain_computation(spark, sf, tables):
    docs = tables("documents").collect()
    counts = {r["doc_id"]: brute_counts(r["text"]) for r in docs}
    failed = {i: c[0] < 20 or 100 * c[4] > 30 * c[0] for i, c in counts.items()}
    groups = defaultdict(list)
    for r in docs:
        if not failed[r["doc_id"]]:
            groups[r["lang"], r["source"]].append(r["doc_id"])
    kept, limit = {}, rules.chi_square_quantile(0.999, 4)
    for own in groups.values():
        x = np.array([vector(counts[i]) for i in own])
        mean, scatter = brute_estimate(x)
        d = np.einsum("ni,ij,nj->n", x - mean, np.linalg.inv(scatter), x - mean)
        kept |= dict(zip(own, d <= limit))
    found = QUERIES["op13_quality_rules"](spark, sf).collect()
    assert {r["doc_id"]: tuple(r[c] for c in COUNTS) for r in found} == counts
    assert {r["doc_id"]: r["base_failed"] for r in found} == failed
    assert {r["doc_id"]: r["kept"] for r in found} == {i: bool(kept.get(i, False)) for i in counts}
    assert 0 < sum(r["kept"] for r in found) < len(found)


def vectors(spark, x, lang="en", source="s"):
    rows = [(lang, source, *map(int, v)) for v in x]
    return spark.createDataFrame(rows, "lang string, source string, x0 long, x1 long, x2 long, x3 long")


def test_no_smaller_determinant_exists_and_outliers_stay_out(spark):
    random = np.random.default_rng(5)
    x = np.r_[random.normal([1600, 30, 5, 5], [150, 200, 300, 250], (9, 4)), random.normal([1600, 1500, 900, 5], 10, (3, 4))]
    x = np.round(x).astype(int)
    row = rules.estimates(vectors(spark, x)).first()
    noise = np.eye(4) * rules.NOISE * 1024**2
    best = min(itertools.combinations(range(12), 9), key=lambda s: np.linalg.slogdet(np.cov(x[list(s)].T, bias=True) + noise)[1])
    assert best == tuple(range(9))
    mean, whiten = np.array(row["mean"]), np.zeros((4, 4))
    whiten[np.tril_indices(4)] = row["whiten"]
    far = np.sqrt((((x - mean) @ whiten.T) ** 2).sum(axis=1))
    assert far[9:].min() > 3 * far[:9].max()
    assert row["n"] == 9


def test_the_order_and_number_of_partitions_change_nothing(spark):
    random = np.random.default_rng(6)
    x = np.round(random.standard_t(2, (3000, 4)) * 200)
    rows = vectors(spark, x).union(vectors(spark, x[:500] * 2, None, None))
    first = {r["lang"]: r.asDict() for r in rules.estimates(rows.repartition(3)).collect()}
    assert first == {r["lang"]: r.asDict() for r in rules.estimates(rows.repartition(11, "x1")).collect()}
    assert set(first) == {"en", None}


@pytest.mark.parametrize("degrees, share, value", [(4, 0.975, 11.143), (4, 0.999, 18.467), (5, 0.95, 11.070), (1, 0.95, 3.841), (6, 0.5, 5.348)])
def test_chi_square(degrees, share, value):
    assert rules.chi_square_quantile(share, degrees) == pytest.approx(value, abs=1e-3)


def test_cases(spark):
    plain = [" ".join(f"word{(i * 7 + j * j) % 9973}" for j in range(60)) for i in range(30)]
    rows = [(i, t, "en", "a", 1, "x") for i, t in enumerate(plain)]
    rows += [(50, None, "en", "a", 1, "x"), (51, "", None, None, 1, "x"), (52, "a b " * 40, "en", "a", 1, "x"),
             (53, "w### " * 3 + " ".join(f"@@{i}###$$" for i in range(60)), "en", "a", 1, "x"),
             (None, plain[0], None, "a", 1, "x"), (0, plain[0], "en", "a", 1, "x"),
             (54, " ".join(f"long{i}" for i in range(100000)), "en", "a", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int, distance string")
    found = rules.judged(docs).collect()
    assert len(found) == len(rows)
    kept = {r["doc_id"]: r["kept"] for r in found}
    assert [i for i in kept if not kept[i]] == [50, 51, 52, 53] or not {50, 51, 52, 53} & {i for i in kept if kept[i]}
    assert all(kept[i] for i in range(30)) and kept[None] and kept[54]
    assert {r["doc_id"] for r in found if r["base_failed"]} == {50, 51, 52}
    assert all((r["distance"] is None) == r["base_failed"] for r in found)
    out = rules.kept(docs)
    assert out.columns == docs.columns
    assert Counter(out.collect()) == Counter(r for r in docs.collect() if kept[r["doc_id"]])
    assert rules.judged(docs.limit(0)).collect() == [] and rules.kept(docs.limit(0)).collect() == []
    assert all(not r["kept"] for r in rules.judged(docs.filter("doc_id in (50, 51)")).collect())
