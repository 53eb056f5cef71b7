"""Spelling variants against counting by hand and comparing all pairs."""

import re
from collections import Counter
from zlib import crc32

from hypothesis import given, settings, strategies as st

from etlkit.llm import spelling_variants as variants
from etlkit.llm.queries import QUERIES


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_counts(docs, every=199):
    counts = Counter()
    for name, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if name is None else name}:{run}".encode())
            counts[run if h % every else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def brute(counts):
    """(word, form, root, n, n_near, form_n), with words compared that share letters left after one deletion."""
    by_cut = {}
    for w in counts:
        for cut in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            by_cut.setdefault(cut, set()).add(w)
    near = {w: set() for w in counts}
    for own in by_cut.values():
        for a in own:
            near[a] |= {b for b in own if one_edit(a, b)}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda o: (-counts[o], o), default=None)
        if best and counts[best] >= 5 * n:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w) or "", root(w), n, len(near[w]), counts[form[w]] if w in form else 0) for w, n in counts.items())


def rows(frame):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in frame.collect())


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(brute_counts(docs))
    found = rows(QUERIES["op11_spelling_variants"](spark, sf))
    assert found == want
    assert any(f for _, f, *_ in want) and any(n > 1 for *_, n, _ in want)


WORDS = st.text("abéz", min_size=6, max_size=9)


@settings(max_examples=300, deadline=None)
@given(WORDS, WORDS, st.integers(0, 8), st.sampled_from(["a", "é", "q", ""]), st.booleans())
def test_words_one_edit_apart_share_a_key(word, other, at, letter, replace):
    at = min(at, len(word))
    changed = word[:at] + letter + word[at + replace:]
    for other in (changed, other):
        if len(other) >= 6 and one_edit(word, other):
            a, b = set(variants._keys(word)), set(variants._keys(other))
            meet = {(0, 0), (1, 2), (2, 1)}
            assert any((s, t) in meet for k, s in a for j, t in b if k == j)


def test_pairs_and_chains(spark):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 7, "bbbbbb": 9, "aaaaaac": 5, "bbbbbbb": 45, "zzzzzz": 5,
              "éaaaab": 5, "aaaaaé": 25}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = rows(variants.spelling_variants(words))
    assert found == brute(counts)
    assert {w: r for w, _, r, *_ in found}["aaaaaa"] == "aaaabb"


def test_crowded_words(spark):
    counts = {f"{a}{b}cdef{c}": 5 + i for i, (a, b, c) in enumerate((a, b, c) for a in "abcdefgh" for b in "xyzuvw" for c in "mnopqr")}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows(variants.spelling_variants(words)) == brute(counts)


def test_cases(spark):
    data = [(1, None, 3), (2, "", 3), (None, "Häuser häuser HÄUSER " * 3, 3), (4, "häusers " * 30, 3), (4, "häusers " * 30, 3),
            (5, "x" * 100000 + " " + "letters " * 20000, 3), (6, "5 . ,", 3)]
    docs = spark.createDataFrame(data, "doc_id long, text string, word int")
    want = brute_counts([d[:2] for d in data])
    found = {r["word"]: r["n"] for r in variants.word_counts(docs, slip_every=199).collect()}
    assert found == want
    assert rows(variants.spelling_variants(variants.word_counts(docs, slip_every=199))) == brute(want)
    assert variants.spelling_variants(variants.word_counts(docs.limit(0))).collect() == []
