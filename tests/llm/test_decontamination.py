"""Tilings against a plain greedy tiling, planted passages and the cases."""

import random
import re

import numpy as np
from hypothesis import given, settings, strategies as st

from pyspark.sql import functions as F

from etlkit.llm import decontamination as dc
from etlkit.llm.queries import QUERIES


def plain_tiling(doc, item, least=dc.SEED):
    """Covered words by the textbook procedure: scan all pairs for the longest unmarked run."""
    free_d, free_i, covered = [True] * len(doc), [True] * len(item), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                k = 0
                while (i + k < len(item) and d + k < len(doc) and item[i + k] == doc[d + k]
                       and free_i[i + k] and free_d[d + k]):
                    k += 1
                if k > best[0]:
                    best = (k, i, d)
        k, i, d = best
        if k < least:
            return covered
        covered += k
        for j in range(k):
            free_i[i + j] = free_d[d + j] = False


def array(values):
    return np.array([v * 0x9E3779B97F4A7C15 + (1 << 63) & 0xFFFFFFFFFFFFFFFF for v in values], np.uint64)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=40), st.lists(st.integers(1, 3), max_size=25))
def test_tiles_are_maximal_matches(doc, item):
    found = dc.tiles(array(doc), array(item))
    free_d, free_i = [True] * len(doc), [True] * len(item)
    for d, i, n in found:
        assert n >= dc.SEED and doc[d:d + n] == item[i:i + n]
        for j in range(n):
            assert free_d[d + j] and free_i[i + j]
            free_d[d + j] = free_i[i + j] = False
    for d in range(len(doc) - 4):
        for i in range(len(item) - 4):
            if all(free_d[d:d + 5]) and all(free_i[i:i + 5]):
                assert doc[d:d + 5] != item[i:i + 5]


def test_covers_as_much_as_the_plain_tiling():
    rng = random.Random(2)
    for _ in range(60):
        item = [rng.randrange(1, 200) for _ in range(40)]
        cuts = sorted(rng.sample(range(40), 3))
        parts = [item[a:b] for a, b in zip([0, *cuts], [*cuts, 40])]
        rng.shuffle(parts)
        doc = []
        for part in parts:
            doc += [rng.randrange(1, 200) for _ in range(rng.randrange(8))] + part
        got = sum(n for _, _, n in dc.tiles(array(doc), array(item)))
        assert got == plain_tiling(doc, item)


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def test_query_finds_the_planted_passages(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: words(r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r["item_id"]: words(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    whole = {(d, i) for d, own in docs.items() for i, item in items.items()
             if " " + " ".join(item) + " " in " " + " ".join(own) + " "}
    rows = QUERIES["op2_decontamination"](spark, sf).collect()
    assert whole and whole <= {(r["doc_id"], r["item_id"]) for r in rows}
    assert all(r["coverage"] >= dc.COVERAGE and r["covered"] <= r["item_words"] for r in rows)


def test_cases_and_blocks(spark):
    passage = [f"Word{i}," for i in range(30)]
    turned = passage[20:] + ["between", "them"] + passage[8:20] + passage[:8]
    some = " ".join(passage[:10]) + " other words " * 20
    rows = [(1, " ".join(passage).lower().replace(",", ";")), (2, " ".join(turned)), (3, some), (4, None), (5, ""),
            (None, "x " * 40000 + " ".join(passage) + " y" * 40000), (6, " ".join(passage)), (6, " ".join(passage))]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, found int")
    items = spark.createDataFrame(
        [(10, " ".join(passage), 1), (11, None, 1), (12, "", 1), (13, "too few words", 1), (None, "nowhere in any of these documents", 1),
         (14, " ".join(passage), 1)], "item_id long, text string, doc int")
    want = sorted([(d, i) for d in (1, 2, None, 6, 6) for i in (10, 14)], key=str)
    for block_words in (dc.BLOCK_WORDS, 20):
        got = dc.contaminated(docs, items, block_words=block_words).collect()
        assert sorted([(r["doc_id"], r["item_id"]) for r in got], key=str) == want
    left = dc.clean(docs, items)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [3, 4, 5]
    assert dc.contaminated(docs.limit(0), items).collect() == []
    assert dc.contaminated(docs, items.limit(0)).collect() == []
    assert dc.clean(docs, items.limit(0)).count() == len(rows)


SHORT = [(1, "alpha"), (2, "beta gamma"), (3, "one two three four"), (4, "one two three four five six"), (4, "beta gamma"),
         (None, "alpha"), (5, ""), (6, None), (7, "...")]


def test_short_items_are_found_whole(spark):
    texts = {1: "x Alpha, y alpha", 2: "beta. Gamma!", 3: "one two three x four", 4: "zero one two three four five", 5: "gamma beta", 6: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    items = spark.createDataFrame(SHORT, "item_id long, text string")
    for block_words in (10**6, 3):
        found = dc.contaminated(docs, items, block_words=block_words).collect()
        got = sorted((r["doc_id"], r["item_id"] or 0, r["item_words"], r["covered"], tuple(map(tuple, r["tiles"]))) for r in found)
        assert got == [(1, 0, 1, 1, ((1, 0, 1),)), (1, 1, 1, 1, ((1, 0, 1),)), (2, 2, 2, 2, ((0, 0, 2),)), (2, 4, 2, 2, ((0, 0, 2),)),
                       (4, 3, 4, 4, ((1, 0, 4),)), (4, 4, 6, 5, ((1, 0, 5),))]
        left = dc.clean(docs.withColumn("found", F.lit(7)), items, block_words=block_words)
        assert left.columns == ["doc_id", "text", "found"] and sorted(r["doc_id"] for r in left.collect()) == [3, 5, 6]
    assert dc.clean(docs, items.limit(0)).count() == 6 and dc.clean(docs.limit(0), items).count() == 0
    assert dc.contaminated(docs, items.limit(0)).count() == 0
