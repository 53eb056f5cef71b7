"""Counts against the library."""

import public_tokenizers
import sentencepiece
from hypothesis import given, settings, strategies as st

from etlkit.llm import token_counts
from etlkit.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
COUNTER = token_counts.PieceCounter(PATH)

ALPHABET = st.sampled_from(list("abcdetheringsn  \n\t.,19éñ日本▁") + ["the", " th", "\0", "<s>", "<0x41>", "😀", "     "])


@settings(max_examples=500, deadline=None)
@given(st.lists(ALPHABET).map("".join) | st.text())
def test_equals_the_library(text):
    assert COUNTER.count([text]) == [len(LIBRARY.encode(text))]


@settings(max_examples=100, deadline=None)
@given(st.lists(ALPHABET, max_size=200).map("".join))
def test_both_ways_of_merging_agree(text):
    symbols = COUNTER._symbols("▁" + text.replace(" ", "▁"))
    assert COUNTER._merge_long(list(symbols)) == COUNTER._merge([symbols])[0]


def test_long_runs():
    texts = [" " * 5000, "ab" * 9000, "x" * 3000 + " " * 700 + "the end", "日本語" * 2000, "the\n" * 3000, "-" * 4001]
    assert COUNTER.count(texts) == [len(LIBRARY.encode(t)) for t in texts]


def test_query(spark, sf, tables):
    texts = {r["doc_id"]: r["text"] for r in tables("documents").collect()}
    found = QUERIES["op3_token_counts"](spark, sf).collect()
    assert len(found) == len(texts)
    for r in found:
        n = len(LIBRARY.encode(texts[r["doc_id"]]))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 4096)


def test_cases(spark):
    rows = [(1, None, 5), (None, "", 5), (2, "a b", 5), (2, "a b", 5), (3, "word " * 50000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = [(r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"])
           for r in token_counts.token_counts(docs, PATH).collect()]
    want = [(i, len((t or "").encode()), n := len(LIBRARY.encode(t or "")), n > 4096) for i, t, _ in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert token_counts.token_counts(docs.limit(0), PATH).collect() == []
