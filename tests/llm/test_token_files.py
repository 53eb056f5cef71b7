"""Token files against the library on whole texts, and the streams' round trip."""

import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from etlkit.llm import byte_tokens, token_files
from etlkit.llm.byte_tokens import encoder
from etlkit.llm.queries import QUERIES
from etlkit.workspace import new_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def expected(rows):
    """Brute force over (doc_id, text) rows in ascending order of the id."""
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300)))
def test_streams_round_trip(values):
    control, data = token_files.pack(np.array(values, np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert token_files.unpack(control, data, len(values)).tolist() == values


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab é.,'s1 \n\t 　  <|endoftext|>")) | st.text())
def test_ids_equal_the_library(text):
    ids = np.frombuffer(encoder(PATH).encode([text])[0], "<u2").tolist()
    assert ids == LIBRARY.encode(text, add_special_tokens=False).ids


def test_special_strings_and_long_runs():
    texts = ["a <|endoftext|> b", "x" * 5000, "a  b   c \n d\n\n e", "", " ", " lead", "trail ", "it's we'll"]
    for text, ids in zip(texts, encoder(PATH).encode(texts)):
        assert np.frombuffer(ids, "<u2").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_query_equals_brute_force(spark, sf, tables):
    rows = [tuple(r) for r in tables("documents").select("doc_id", "text").collect()]
    found = QUERIES["op4_token_files"](spark, sf).orderBy("start").collect()
    assert [tuple(r) for r in found] == expected(rows)


def test_nulls_ties_repeats_and_clashing_names(spark):
    rows = [(3, "a b", 1, 0), (None, "null id", 1, 0), (1, None, 1, 0), (1, "", 1, 0), (3, "a b", 1, 0),
            (2, "word " * 30000, 1, 0), (0, "<|endoftext|>", 1, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int, `ids` int")
    folder = new_path(spark, "test-tokens")
    token_files.write_tokens(docs, folder, PATH)
    found = token_files.read_tokens(spark, folder).orderBy("start").collect()
    got = [(r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in found]
    assert got == expected([r[:2] for r in rows])


def test_no_rows(spark):
    folder = new_path(spark, "test-tokens")
    token_files.write_tokens(spark.createDataFrame([], "doc_id long, text string"), folder, PATH)
    assert token_files.read_tokens(spark, folder).collect() == []


def test_tables_that_fill_up_and_pieces_of_every_kind_give_the_ids_of_the_library(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(8)
    ends = ["", ".", ",", ".\nThe", "!?", "\n", "\u00e9", "\u4e16", "'s", "12", "  ", "\t", ".,", "\u00aa"]
    texts = [" ".join(rng.choice(["", "ab", "Cd", "e"]) + str(rng.choice(["", "xy", n % 37])) + rng.choice(ends)
                      for n in range(rng.randrange(60))) for _ in range(300)]
    monkeypatch.setattr(byte_tokens, "KEPT_PIECES", 150)
    monkeypatch.setattr(byte_tokens, "KEPT_PARTS", 60)
    made = byte_tokens.TextEncoder(path)
    got = [ids for i in range(0, 300, 10) for ids in made.encode(texts[i:i + 10])]
    assert got == made.whole(texts)
    assert made.kept.old and not made.kept.missing


def test_a_word_goes_to_the_library_once_with_and_without_a_point():
    made = byte_tokens.TextEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    asked, of_lines = [], made._of_lines
    made._of_lines = lambda lines: asked.extend(lines) or of_lines(lines)
    made.encode(["first word word. word, words. words"] * 2)
    assert sorted(asked) == [" word", " words", "first"] and not set(made.parts) - {"first"}
