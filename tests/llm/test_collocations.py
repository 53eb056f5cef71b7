"""Collocations against SQL and plain counting; filters against dictionaries."""

import re
import tracemalloc
from collections import Counter
from fractions import Fraction

import numpy as np
import oracle
import pytest
from hypothesis import given, settings, strategies as st

from etlkit.llm import collocations, quotient_filters as filters
from etlkit.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_equals_sql(spark, sf):
    sf = f"/root/testdata/{sf}"
    found = QUERIES["op12_collocations"](spark, sf)
    assert oracle.compare(oracle.connect(sf), ORACLES["op12_collocations"], found) is None
    assert sf.endswith("0.001") or found.count() > 100


def brute(docs, least, top):
    counts, sizes = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, 5):
                counts.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    found = {key: a for key, a in counts.items() if a >= least and len(key[1]) > 1}
    out = []
    for (lang, p), a in found.items():
        if any(100 * b >= 80 * a for (other, q), b in found.items()
               if other == lang and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))):
            continue
        cuts = [(int(Fraction(2000000 * a, counts[lang, p[:k]] + counts[lang, p[k:]])), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, " ".join(p), a, counts[lang, p[:k]], counts[lang, p[k:]], sizes[lang], score))
    ranked = []
    for lang in sizes:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i + 1, *r[1:]) for i, r in enumerate(own[:top])]
    return sorted(ranked)


def rows(frame):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in frame.collect())


def texts(seed, n):
    random = np.random.default_rng(seed)
    words = np.array(["a", "b", "c", "De", "f.", "g,h", "é", "i\tj", "k\n", "l\x0b", "x" * 50, "\x00", "m\x85", ".."])
    return [(random.choice(["en", "de", None, ""]), " ".join(random.choice(words, random.integers(0, 40)))) for _ in range(n)]


def test_equals_plain_counting(spark):
    data = [*texts(1, 300), ("en", None), (None, None), ("de", "")]
    docs = spark.createDataFrame([(l, t, 1, "x") for l, t in data], "lang string, text string, n int, word string")
    assert rows(collocations.collocations(docs, least=6, top=40)) == brute(data, 6, 40)
    assert collocations.collocations(docs.limit(0)).collect() == []
    assert collocations.collocations(docs, least=10**6).collect() == []


def test_many_small_blocks_merge_in_levels(spark):
    data = texts(2, 200) + [("en", "long words in a row " * 20000)]
    docs = spark.createDataFrame(data, "lang string, text string").repartition(23)
    want = brute(data, 5, 2000)
    assert rows(collocations.collocations(docs, least=5, fan_bits=2)) == want
    assert rows(collocations.collocations(docs, least=5)) == want


IDS = st.lists(st.tuples(*[st.integers(0, (1 << 20) - 1)] * 4), min_size=1, max_size=60)


@settings(max_examples=200, deadline=None)
@given(st.lists(IDS, min_size=1, max_size=4), st.sampled_from([20, 24, 32]), st.sampled_from([1, 255, 256, 300, 1 << 40]))
def test_filters_lose_nothing(shards, bits, times):
    want, kept = Counter(), []
    for n, shard in enumerate(shards):
        ids = np.array(shard, np.uint64)
        left, right = filters.permuted(ids, bits)
        assert (filters.restored(left, right, bits) == ids).all()
        entries = filters.Entries(left, right, np.full(len(ids), times + n, np.int64))
        for row in ids.tolist():
            want[tuple(row)] += times + n
        for value, own in filters.split(entries, bits, 0, 8):
            kept.append((value, filters.packed(filters.merged([own], bits, 8), bits, 8)))
    found = Counter()
    for value in {v for v, _ in kept}:
        parts = [filters.unpacked(row, v, bits, 8) for v, row in kept if v == value]
        whole = filters.merged(parts, bits, 8)
        assert (np.diff(whole.left.astype(object)) >= 0).all()
        found.update(dict(zip(map(tuple, filters.restored(whole.left, whole.right, bits).tolist()), whole.counts.tolist())))
    assert found == want


def test_a_filter_takes_little_room():
    random = np.random.default_rng(3)
    ids = random.integers(1, 1 << 17, (100_000, 4)).astype(np.uint64)
    left, right = filters.permuted(ids, 17)
    entries = filters.Entries(left, right, np.ones(len(ids), np.int64))
    size = sum(len(part) for _, own in filters.split(entries, 17, 0, 8)
               for part in filters.packed(filters.merged([own], 17, 8), 17, 8).values() if isinstance(part, bytes))
    assert size < 9.5 * len(ids)


def test_counting_a_block_takes_a_few_times_its_numbers():
    ids = np.random.default_rng(1).integers(0, 30_000, 200_000).astype(np.uint64)
    tracemalloc.start()
    entries = collocations.block_entries(ids, 16)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert entries.counts.sum() > 500_000 and peak < 250 * len(ids)
