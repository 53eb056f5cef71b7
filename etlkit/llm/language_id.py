"""Language identification with unigram models that sum over all segmentations.

A model holds, per language, a probability for each piece of a fixed public vocabulary. The
probability of a word is the sum over all ways to cut it into pieces, computed by a forward
pass; the words of a text multiply. Probabilities are trained by expectation maximisation
on the word counts of a bounded sample of labelled rows per language.

Cases: a text that is null or has no letter is ``und`` with score 0; a character outside
the vocabulary counts alike in all languages; equal scores go to the language that sorts
first; texts of any length are scored whole; without any labelled row every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from etlkit.llm.common import pick, slices, text_slices
from etlkit.llm.pieces import SPACE, read_pieces
from etlkit.llm.worker_tables import give_back, worker_table
from etlkit.operators.reuse import staged

UNDETERMINED = "und"
# Labelled rows learned from per language: a sample by hash of the id, of about this size.
ROWS_PER_LANGUAGE = 2000
ROUNDS = 3
# Added to a piece's expected count, shared out like the pieces of all languages together.
SMOOTHING = 200.0
# Log-probability of a character that no piece covers.
UNSEEN = -16.0
# Words kept per Python worker with their scores; the table is emptied when full.
KEPT = 700_000
# Cells of a forward table (words x positions) filled together.
BATCH_CELLS = 1 << 18

_LETTERS = r"\p{L}[\p{L}\p{M}]*"
_WORDS = regex.compile(_LETTERS)
# Byte table: ASCII characters that are no letters become white space.
_APART = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


class Lattice:
    """The letter-only pieces of a public file as a prefix tree, walked by whole arrays."""

    def __init__(self, path: str):
        own = regex.compile(rf"{SPACE}?[\p{{L}}\p{{M}}]*")
        self.pieces = [p for p, _ in read_pieces(path) if own.fullmatch(p) and p == p.lower()]
        self.size = len(self.pieces)
        states = {p[:i]: 0 for p in self.pieces for i in range(1, len(p) + 1)}
        states = {prefix: state for state, prefix in enumerate(sorted(states), 1)}
        letters = {c: i for i, c in enumerate(sorted({c for p in self.pieces for c in p if len(p) > 1}), 1)}
        # Characters of longer pieces have columns in the table of steps; the others are pieces
        # of one character or none.
        self.columns = np.zeros(0x110000, np.int32)
        self.columns[[ord(c) for c in letters]] = list(letters.values())
        self.steps = np.zeros((len(states) + 1, len(letters) + 1), np.int32)
        for prefix, state in states.items():
            if prefix[-1] in letters and (len(prefix) == 1 or prefix[:-1] in states):
                self.steps[states.get(prefix[:-1], 0), letters[prefix[-1]]] = state
        self.piece_at = np.full(len(states) + 1, -1, np.int64)
        self.single = np.full(0x110000, self.size, np.int32)
        for i, piece in enumerate(self.pieces):
            self.piece_at[states[piece]] = i
            if len(piece) == 1:
                self.single[ord(piece)] = i

    def arcs(self, words: list[str]):
        """(end, word, begin, piece) of all pieces found in the words, sorted by end and word.

        A single character without a piece gets the number ``size``.
        """
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        row = np.repeat(np.arange(len(words)), lengths)
        ends = np.cumsum(lengths)
        begin = np.arange(len(codes)) - np.repeat(ends - lengths, lengths)
        columns, left = self.columns[codes], lengths[row] - begin
        found = [(begin + 1, row, begin, self.single[codes].astype(np.int64))]
        at, state, span = np.arange(len(codes)), self.steps[0, columns], 1
        while True:
            go = (state > 0) & (left[at] > span)
            at, state = at[go], state[go]
            if not len(at):
                break
            state = self.steps[state, columns[at + span]]
            span += 1
            piece = self.piece_at[state]
            hit = np.flatnonzero(piece >= 0)
            own = at[hit]
            found.append((begin[own] + span, row[own], begin[own], piece[hit]))
        arcs = [np.concatenate(parts) for parts in zip(*found)]
        order = np.argsort(arcs[0] * len(words) + arcs[1], kind="stable")
        return [a[order] for a in arcs]


def _log_sums(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Log of the sum of exponentials of each run of rows."""
    top = np.maximum.reduceat(values, begins, axis=0)
    lengths = np.diff(np.r_[begins, len(values)])
    return top + np.log(np.add.reduceat(np.exp(values - np.repeat(top, lengths, axis=0)), begins, axis=0))


def _passes(table: np.ndarray, into, out_of, rows, values) -> None:
    """Fill ``table[row, into]`` from ``table[row, out_of]`` along arcs sorted by (into, row)."""
    turns = np.flatnonzero(np.r_[True, into[1:] != into[:-1], True])
    for start, stop in zip(turns[:-1].tolist(), turns[1:].tolist()):
        row = rows[start:stop]
        begins = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        sums = _log_sums(table[row, out_of[start:stop]] + values[start:stop], begins)
        table[row[begins], into[start]] = sums


def _chunks(words: list[str]) -> Iterator[list[int]]:
    """Positions of words of like length, so that a table of them is small and full."""
    part, width = [], 0
    for i in sorted(range(len(words)), key=lambda i: len(words[i])):
        width = len(words[i]) + 1
        if part and (len(part) + 1) * width > BATCH_CELLS:
            yield part
            part = []
        part.append(i)
    if part:
        yield part


def word_scores(lattice: Lattice, logp: np.ndarray, words: list[str]) -> np.ndarray:
    """Log-probability of each word (with its space mark) in each language: the forward pass."""
    scores = np.zeros((len(words), logp.shape[1]))
    for part in _chunks(words):
        own = [words[i] for i in part]
        end, row, begin, piece = lattice.arcs(own)
        table = np.full((len(own), max(map(len, own)) + 1, logp.shape[1]), -np.inf)
        table[:, 0] = 0.0
        _passes(table, end, begin, row, logp[piece])
        scores[part] = table[np.arange(len(own)), [len(w) for w in own]]
    return scores


def expected_counts(lattice: Lattice, logp: np.ndarray, words: list[str], counts: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations: forward and backward pass."""
    total = np.zeros(lattice.size + 1)
    for part in _chunks(words):
        own = [words[i] for i in part]
        end, row, begin, piece = lattice.arcs(own)
        values = logp[piece][:, None]
        shape = (len(own), max(map(len, own)) + 1, 1)
        forward, backward = np.full(shape, -np.inf), np.full(shape, -np.inf)
        lengths = np.array([len(w) for w in own])
        forward[:, 0] = 0.0
        _passes(forward, end, begin, row, values)
        backward[np.arange(len(own)), lengths] = 0.0
        order = np.lexsort((row, -begin))
        _passes(backward, begin[order], end[order], row[order], values[order])
        share = np.exp(forward[row, begin] + values + backward[row, end] - forward[row, lengths[row]])[:, 0]
        total += np.bincount(piece, share * counts[part][row], len(total))
    return total


@lru_cache(maxsize=2)
def lattice(path: str) -> Lattice:
    """One lattice per vocabulary, for the driver; workers let theirs go with their tables."""
    return Lattice(path)


def learnable(doc_id: str = "doc_id") -> Column:
    """Whether a row may be learned from; false for the held-out quarter, null without an id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 != 2


def word_table(docs: DataFrame, doc_id: str, text: str, lang: str, rows: int) -> DataFrame:
    """``lang, word, n`` over the sample of labelled rows. Runs a job over the labels."""
    labelled = pick(docs, doc_id=doc_id, text=text, lang=lang).filter("lang is not null").filter(learnable())
    sizes = labelled.groupBy("lang").count().collect()  # one row per language
    if not sizes:
        return labelled.selectExpr("lang", "text AS word", "0L AS n").limit(0)
    part = F.create_map(*chain.from_iterable((F.lit(r["lang"]), F.lit(rows / r["count"])) for r in sizes))
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)).cast("double") / float(1 << 40)
    words = labelled.filter(chance < part[F.col("lang")]).select(
        "lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(_LETTERS), F.lit(0))).alias("word"))
    return words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))


def _expectation(path: str, languages: list[str], logp: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(logp.shape)
        for batch in batches:
            table = batch.to_pandas()
            for language, rows in table.groupby("lang"):
                column = languages.index(language)
                total[:, column] += expected_counts(
                    worker_table(f"lattice:{path}", lambda: Lattice(path)), logp[:, column], [SPACE + w for w in rows["word"]], rows["n"].to_numpy())
        piece, language = np.nonzero(total)
        yield pa.record_batch({"piece": piece, "language": language, "n": total[piece, language]})

    return run


class Model:
    def __init__(self, path: str, languages: list[str], logp: np.ndarray, prior: np.ndarray):
        self.path, self.languages, self.logp, self.prior = path, languages, logp, prior
        self.key = uuid4().hex


def train(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          rows_per_language: int = ROWS_PER_LANGUAGE, rounds: int = ROUNDS) -> Model:
    """Fit the model. Runs a job per round over the sample's distinct words.

    Each task sends its expected counts, one per piece and language at most; the sums that
    come to the driver are as many as the model holds.
    """
    words = staged(word_table(docs, doc_id, text, lang, rows_per_language), "words")
    found = words.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").collect()
    languages, size = [r["lang"] for r in found], lattice(path).size
    prior = np.log(np.array([r["n"] for r in found], float) / max(1, sum(r["n"] for r in found)))
    logp = np.full((size + 1, len(languages)), -np.log(size))
    logp[size] = UNSEEN
    for _ in range(rounds if languages else 0):
        counted = words.mapInArrow(_expectation(path, languages, logp), "piece long, language long, n double")
        counts = np.zeros(logp.shape)
        for row in counted.groupBy("piece", "language").agg(F.sum("n").alias("n")).collect():
            counts[row["piece"], row["language"]] = row["n"]
        counts[size] = 0
        together = counts.sum(axis=1, keepdims=True) + 1.0
        counts += SMOOTHING * together / together.sum()
        # Rounded: sums of doubles differ in their last bits with the order of the tasks.
        logp = np.round(np.log(counts / counts[:size].sum(axis=0)), 6)
        logp[size] = UNSEEN
    return Model(path, languages, logp, prior)


class Scorer:
    """Scores texts word by word; each word is scored once and kept."""

    def __init__(self, model: Model):
        self.model, self.kept, self.lattice = model, {}, Lattice(model.path)
        self.scores = np.zeros((0, len(model.languages) + 1))  # last column: words

    def _learn(self, pieces: list[bytes]) -> None:
        if len(self.kept) + len(pieces) > KEPT:
            self.kept, self.scores = {}, self.scores[:0]
        found = [[w] if (w := p.decode()).isalpha() else _WORDS.findall(w) for p in pieces]
        words = sorted(set(chain.from_iterable(found)))
        rows = {w: i for i, w in enumerate(words)}
        known = word_scores(self.lattice, self.model.logp, [SPACE + w for w in words])
        known = np.c_[known, np.ones(len(words))]
        owner = np.repeat(np.arange(len(pieces)), [len(f) for f in found])
        used = known[[rows[w] for w in chain.from_iterable(found)]]
        added = np.stack([np.bincount(owner, used[:, c], len(pieces)) for c in range(known.shape[1])], axis=1)
        start = len(self.kept)
        self.kept.update(zip(pieces, range(start, start + len(pieces))))
        self.scores = np.concatenate([self.scores, added])

    def predict(self, texts: list[str]) -> pd.DataFrame:
        cut = [t.lower().encode().translate(_APART).split() for t in texts]
        flat = list(chain.from_iterable(cut))
        if new := set(flat) - self.kept.keys():
            if len(self.kept) + len(new) > KEPT:
                new = set(flat)
            self._learn(sorted(new))
        at = np.fromiter(map(self.kept.__getitem__, flat), np.int64, len(flat))
        owner = np.repeat(np.arange(len(texts)), [len(c) for c in cut])
        totals = np.stack([np.bincount(owner, self.scores[at, c], len(texts))
                           for c in range(self.scores.shape[1])], axis=1)
        totals, words = totals[:, :-1] + self.model.prior, totals[:, -1]
        best = totals.argmax(axis=1)
        sure = 1 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
        names = np.array([*self.model.languages, UNDETERMINED], object)
        return pd.DataFrame({"lang_pred": names[np.where(words > 0, best, len(names) - 1)],
                             "score": np.where(words > 0, sure, 0.0)})


def _scorer(model: Model) -> Scorer:
    return worker_table(f"language:{model.key}", lambda: Scorer(model))


def language(text: Column, model: Model) -> Column:
    """``lang_pred`` and ``score`` (probability of that language) of a text column."""
    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            if not model.languages:
                yield pd.DataFrame({"lang_pred": [UNDETERMINED] * len(texts), "score": [0.0] * len(texts)})
                continue
            scorer = _scorer(model)
            yield pd.concat([scorer.predict(part) for part in text_slices(texts)]
                            or [pd.DataFrame({"lang_pred": [], "score": []})], ignore_index=True)

    return predict.asNondeterministic()(text)


def predictions(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                **options) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row, by a model trained on ``docs``."""
    model = train(docs, path, doc_id, text, lang, **options)
    found = pick(docs, doc_id=doc_id, text=text).select(
        "doc_id", F.coalesce(~learnable(), F.lit(False)).alias("held_out"),
        language(F.col("text"), model).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def identified(docs: DataFrame, path: str, least: float = 0.5, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose language is found with a score of at least ``least``.

    Runs the jobs of ``train``. Rows pass through Python in slices of a few megabytes, so none wait
    for others in the JVM.
    """
    model = train(docs, path, text=text, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            if model.languages:
                found = _scorer(model).predict([t or "" for t in part[text].to_pylist()])
                yield part.filter(pa.array((found["lang_pred"] != UNDETERMINED) & (found["score"] >= least)))
        give_back()

    return docs.mapInArrow(run, docs.schema)
