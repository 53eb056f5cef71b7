"""The forward pass against enumeration, held-out accuracy and the cases."""

import math
import zlib

import numpy as np
import public_tokenizers
import pytest

from etlkit.llm import language_id, worker_tables
from etlkit.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")


def enumerate_cuts(lattice, logp, word):
    """(log-probability, pieces) of every way to cut the word."""
    if not word:
        return [(0.0, [])]
    out = []
    for end in range(1, len(word) + 1):
        if word[:end] in lattice.pieces:
            piece = lattice.pieces.index(word[:end])
        elif end > 1:
            continue
        else:
            piece = lattice.size
        out += [(logp[piece] + value, [piece, *rest]) for value, rest in enumerate_cuts(lattice, logp, word[end:])]
    return out


@pytest.mark.parametrize("word", ["▁the", "▁tionthe", "▁żółć", "▁a", "▁日本x", "▁information"])
def test_sums_all_segmentations(word):
    lattice = language_id.lattice(PATH)
    rng = np.random.default_rng(1)
    logp = np.log(rng.dirichlet(np.ones(lattice.size + 1), 2)).T
    scores = language_id.word_scores(lattice, logp, [word, "▁zz", word + "s"])
    for column in (0, 1):
        cuts = enumerate_cuts(lattice, logp[:, column], word)
        total = sum(math.exp(v) for v, _ in cuts)
        assert scores[0, column] == pytest.approx(math.log(total))
        expected = np.zeros(lattice.size + 1)
        for value, pieces in cuts:
            np.add.at(expected, pieces, 5 * math.exp(value) / total)
        got = language_id.expected_counts(lattice, logp[:, column], [word], np.array([5]))
        assert got == pytest.approx(expected)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = QUERIES["op1_language_id"](spark, sf).collect()
    assert len(found) == len(docs)
    right = held = 0
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
        if r["held_out"]:
            held += 1
            right += r["lang_pred"] == docs[r["doc_id"]]["lang"]
    assert held > 150 and right / held > 0.97


def test_cases(spark):
    rows = [(i, text, lang, "x") for i, (text, lang) in enumerate(
        [("the house of the king", "en"), ("la maison du roi est belle", "fr")] * 40)]
    rows += [(1000, None, "en", "x"), (1001, "", None, "x"), (1002, "123 !?", "fr", "x"), (None, "the house", None, "x"),
             (1003, "the house " * 30000, None, "x"), (1004, "z" * 20000, None, "x"), (1, "la maison", "fr", "x"),
             (1, "la maison", "fr", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    got = language_id.predictions(docs, PATH).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert by[1000] == by[1001] == by[1002] == ("und", 0.0)
    assert by[None][0] == by[1003][0] == "en" and by[1][0] == "fr" and by[1004][0] in ("en", "fr")
    kept = language_id.identified(docs, PATH)
    assert kept.columns == docs.columns and kept.count() >= len(rows) - 4
    assert language_id.predictions(docs.limit(0), PATH).collect() == []
    no_labels = language_id.predictions(docs.withColumn("lang", docs["lang_pred"].substr(9, 1)).filter("doc_id > 999").selectExpr(
        "doc_id", "text", "cast(null as string) as lang"), PATH).collect()
    assert {r["lang_pred"] for r in no_labels} == {"und"}


def test_a_worker_returns_the_memory_of_a_table_that_another_replaces(monkeypatch):
    returned = []
    monkeypatch.setattr(worker_tables, "_kept", {})
    monkeypatch.setattr(worker_tables, "give_back", lambda: returned.append(dict(worker_tables._kept)))
    assert worker_tables.worker_table("a", lambda: 1) == worker_tables.worker_table("a", lambda: 2) == 1
    returned.clear()
    assert worker_tables.worker_table("b", lambda: 3) == 3 and returned == [{}]


def test_workers_let_the_lattice_go_with_the_scores():
    import gc

    model = language_id.Model(PATH, [], np.zeros((0, 0)), np.zeros(0))
    before = sum(isinstance(o, language_id.Lattice) for o in gc.get_objects())
    scorer = language_id._scorer(model)
    assert scorer.lattice.size == language_id.lattice(PATH).size
    scorer = None
    worker_tables.forget_tables()
    language_id.lattice.cache_clear()
    gc.collect()
    assert sum(isinstance(o, language_id.Lattice) for o in gc.get_objects()) <= before
    assert not any(isinstance(o, language_id.Scorer) for o in gc.get_objects())
