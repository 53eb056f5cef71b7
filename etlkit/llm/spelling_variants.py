"""Spelling variants: words one edit apart, and the form that each most likely stands for.

Words are counted over all texts. A word is the multiset of its letters, a binary vector with
one dimension per letter and occurrence; an edit changes at most two of them. Pairs come from
PartEnum signatures: dimensions are dealt to ``parts``, and for each choice of ``tolerance`` parts
to leave out, what the vector holds in the others is a signature. Vectors that differ in at most
``tolerance`` dimensions share one. Signatures are joined for equality and each pair that meets is
verified by its edit distance, so the pairs are exact.

Two facts about an edit sharpen a signature. Words of one length differ by a replaced letter (two
dimensions), others by one letter more (one dimension), so lengths belong to it and each
case has its own signatures. And one edit leaves the first ``END`` or the last ``END`` letters of
words of twice as many as they are, so each signature is taken with either end.

Cases: null and empty texts have no words; a null id counts as empty text in ``slip_every``; ties
between forms go to the smaller word; repeated rows count as often as they occur; texts of any
length are read whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from etlkit.llm.common import pick, slices
from etlkit.llm.shingles import LOWER
from etlkit.operators.reuse import staged

LEAST_LETTERS, LEAST_COUNT = 6, 5
# A form is at least so many times as frequent as its variant.
FORM_RATIO = 5
END = 3
# (parts, tolerance) for words of one length, and for words whose lengths differ by one.
SAME, LONGER = (5, 2), (3, 1)
# Distinct words a task holds before it passes their counts on.
HELD_WORDS = 200_000

_RUNS = re.compile("[a-zÀ-ÿ]+")


def _slips(runs: list[str], name: str, every: int) -> Iterator[tuple[str, str]]:
    """(run, run without a letter) of the runs whose hash with ``name`` is a multiple of ``every``."""
    seed = crc32(f"{name}:".encode())
    for run in set(runs):
        value = crc32(run.encode(), seed)
        if not value % every:
            at = value % len(run)
            yield run, run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS,
                least_count: int = LEAST_COUNT, slip_every: int | None = None) -> DataFrame:
    """``word, n`` of the runs of letters in lower case (A-Z only), over all texts.

    ``slip_every`` puts errors in: of the distinct runs of a document, those with a hash divisible
    by it lose the letter that the hash names. Counts are summed in each task before the shuffle.
    """
    rows = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("string"), "text")

    def passed(counts: Counter) -> pa.RecordBatch:
        found = [(w, n) for w, n in counts.items() if len(w) >= least_letters and n > 0]
        return pa.record_batch({"word": pa.array([w for w, _ in found], pa.string()),
                                "n": pa.array([n for _, n in found], pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for part in slices(batches, "text"):
            for name, own in zip(part["doc_id"].to_pylist(), part["text"].to_pylist()):
                if not own:
                    continue
                runs = _RUNS.findall(own.encode().translate(LOWER).decode())
                counts.update(runs)
                for old, new in _slips(runs, name or "", slip_every) if slip_every else ():
                    n = runs.count(old)
                    counts[old] -= n
                    counts[new] += n
            if len(counts) > HELD_WORDS:
                yield passed(counts)
                counts = Counter()
        yield passed(counts)

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(
        F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def signatures(word: str, parts: int, tolerance: int) -> list[tuple]:
    """What the letter multiset holds in all but ``tolerance`` of ``parts``, for each choice."""
    seen, held = Counter(), [[] for _ in range(parts)]
    for letter in sorted(word):
        seen[letter] += 1
        held[(ord(letter) * 31 + seen[letter] * 7) % parts].append(letter)
    cells = ["".join(part) for part in held]
    return [(kept, *(cells[p] for p in kept)) for kept in combinations(range(parts), parts - tolerance)]


def _keys(word: str) -> Iterator[tuple[int, int]]:
    """(key, side): words of one length meet on side 0, others with 1 the shorter and 2 the longer."""
    ends = ("<" + word[:END], ">" + word[-END:])
    same, longer = signatures(word, *SAME), signatures(word, *LONGER)
    for side, length, own in ((0, len(word), same), (1, len(word) + 1, longer), (2, len(word), longer)):
        for end in ends:
            for signature in own:
                name = repr((side > 0, length, end, signature))
                yield np.uint64(xxhash.xxh3_64_intdigest(name)).astype(np.int64).item(), side


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 2000):
            part = batch.slice(start, 2000)
            found = [list(_keys(w)) for w in part["word"].to_pylist()]
            at = np.repeat(np.arange(part.num_rows), [len(f) for f in found])
            yield pa.record_batch({
                "key": pa.array([k for f in found for k, _ in f], pa.int64()),
                "side": pa.array([s for f in found for _, s in f], pa.int32()),
                "word": part["word"].take(pa.array(at)), "n": part["n"].take(pa.array(at))})


def near_pairs(words: DataFrame) -> DataFrame:
    """``word, n, other, other_n``: all pairs of ``words`` one edit apart, each in both directions.

    ``words`` has distinct ``word`` of at least twice ``END`` letters, and ``n``.
    """
    signed = staged(words.select("word", "n").mapInArrow(_signed, "key long, side int, word string, n long"), "signed")
    left = signed.filter("side < 2")
    right = signed.filter("side != 1").select(
        "key", F.col("side").alias("other_side"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    sides = F.when(F.col("side") == 0, (F.col("other_side") == 0) & (F.col("word") < F.col("other"))).otherwise(
        F.col("other_side") == 2)
    met = left.join(right, (left["key"] == right["key"]) & sides & (F.levenshtein("word", "other", 1) == 1))
    pairs = met.select("word", "n", "other", "other_n").distinct()
    return pairs.union(pairs.select("other", "other_n", "word", "n"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: the last word on the way along forms.

    Each round doubles the way, and a form is ``FORM_RATIO`` times as frequent as its variant, so
    rounds grow with the logarithm of the logarithm of the largest count.
    """
    roots = staged(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not roots.filter("moved").isEmpty():
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = staged(roots.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
    return roots.select("word", "root")


def spelling_variants(words: DataFrame, form_ratio: int = FORM_RATIO) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for each row of ``words`` (``word, n``). Runs jobs."""
    words = staged(words, "words")
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word")))
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    found = words.join(near, "word", "left")
    taken = -F.col("best.n") >= form_ratio * F.col("n")
    found = staged(found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, F.col("best.word")).alias("form"), F.when(taken, -F.col("best.n")).alias("form_n")), "forms")
    return found.join(_roots(found.filter("form IS NOT NULL")), "word", "left").withColumn(
        "root", F.coalesce("root", "word"))
