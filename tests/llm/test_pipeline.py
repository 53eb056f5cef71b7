"""The pipeline's stages against brute force, one by one, on whole tables."""

from collections import Counter

import public_tokenizers
import pytest
from test_near_duplicates import brute as near_groups
from test_token_files import expected as token_rows

import corpus_pipeline
from etlkit.llm import language_id
from etlkit.workspace import new_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The documents before the first stage and after each one."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        path = new_path(spark, f"test-{name}")
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def ids(frame):
    return sorted(r["doc_id"] for r in frame.select("doc_id").collect())


def test_names_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_duplicates", "decontamination", "mix_sources", "token_files"]
    assert all(step.schema == steps[0].schema for step in steps[:-1])


def test_language_stage_keeps_what_has_a_language(steps):
    found = language_id.predictions(steps[0], public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert ids(steps[1]) == sorted(r["doc_id"] for r in found if r["lang_pred"] != "und" and r["score"] >= 0.5)
    assert len(ids(steps[1])) >= 0.98 * len(ids(steps[0]))


def test_one_document_of_each_group_stays(steps):
    groups = near_groups([(r["doc_id"], r["text"]) for r in steps[1].collect()])
    assert ids(steps[2]) == sorted({d for d, n, c in groups if d == c or not n})


def test_contaminated_documents_go(steps, tables):
    items = [" ".join(r["text"].split()) for r in tables("benchmark").collect()]
    leaks = {r["doc_id"] for r in steps[2].collect() if any(i in " ".join(r["text"].split()) for i in items)}
    kept = set(ids(steps[3]))
    assert leaks and not leaks & kept and len(kept) >= 0.9 * (len(ids(steps[2])) - len(leaks))


def test_mix_and_tokens(steps):
    rows = [(r["doc_id"], r["text"]) for r in steps[4].collect()]
    assert max(Counter(i for i, _ in rows).values()) <= 3 and {i for i, _ in rows} <= set(ids(steps[3]))
    assert [tuple(r) for r in steps[5].orderBy("start").collect()] == token_rows(rows)


def test_run_equals_the_stages(spark, steps):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, steps[-1].collect()))
