"""Cross-entropy difference of a target and a background n-gram model.

Both models are bigram models over one vocabulary with Dirichlet smoothing towards their
unigrams. The background model counts all documents, the target model those named as target,
and background counts are scaled to the target's number of words, so that smoothing weighs
alike in both. A document's score is its loss per word under the target model less that under
the background model: the lower, the more it is like the target. A document's own words are
taken out of the counts first.

Words and pairs are counted each for itself, by 63 bits of their hash and one that tells them
apart. Texts are read once and kept as blocks: a block's distinct words, and its texts as numbers
of these. A block sends its counts, sorted and packed by range of the hash; a range sums them over
all blocks and sends each block the sums in the block's own order, without the n-grams. Blocks and
sums then meet and texts are scored. So what is counted grows with the corpus, no text is
shuffled, and no task holds more than a block or a range.

Smoothing counts each word of the vocabulary, which is measured, once more in both models.

Cases: a null or empty text has no words and null losses; repeated rows are counted and scored
each; a null id is never a target; without target documents the target model is uniform and
the score tells nothing; texts of any length are scored whole; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from etlkit.llm.common import pick, slices
from etlkit.llm.shingles import mix, word_hashes
from etlkit.llm.worker_tables import forget_tables
from etlkit.operators.reuse import measured, observed, staged
from etlkit.operators.sizing import broadcast_if_small
from etlkit.session import options

# Weight of the unigram estimate, in observations of the preceding word.
PRIOR = 4.0
# Text of a block of documents, and text per range of n-grams, in bytes.
BLOCK_BYTES, RANGE_BYTES = 3 << 20, 6 << 20

_TIGHT = {"spark.sql.parquet.compression.codec": "zstd"}
_SCORES = "doc_id long, n_words long, target_loss double, background_loss double"
_BLOCK = ("block long, doc_ids array<long>, targets array<boolean>, lengths binary, names binary, numbers binary, "
          "bytes long, n_words long, n_target long")
_PACKED = "block long, part long, grams binary, n binary, target binary"
_SUMS = "block long, part long, n binary, target binary, vocabulary long"


def classes_and_cells(words: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(each word, each word with the one before, whether a text begins there), as hashes."""
    begins = np.zeros(len(words), bool)
    begins[borders[:-1][np.diff(borders) > 0]] = True
    pairs = mix(np.r_[np.zeros(min(1, len(words)), np.uint64), words[:-1]] * np.uint64(0x9E3779B97F4A7C15) + words)
    classes, cells = mix(words) & ~np.uint64(1), pairs | np.uint64(1)
    return classes.view(np.int64), cells.view(np.int64), begins


class _Block:
    """Texts on their way into a block."""

    def __init__(self):
        self.ids, self.targets, self.parts, self.lengths, self.bytes = [], [], [], [], 0

    def add(self, part: pa.RecordBatch) -> None:
        texts = part["text"].to_pylist()
        flat, borders = word_hashes(texts)
        self.ids += part["doc_id"].to_pylist()
        self.targets += part["target"].to_pylist()
        self.parts.append(flat)
        self.lengths.append(np.diff(borders))
        self.bytes += sum(len(t) for t in texts if t)

    def row(self, block: int) -> pa.RecordBatch:
        flat, lengths = np.concatenate(self.parts), np.concatenate(self.lengths)
        names, number, times = np.unique(flat, return_inverse=True, return_counts=True)
        often = np.argsort(-times, kind="stable")  # frequent words get small numbers
        place = np.empty(len(often), np.uint32)
        place[often] = np.arange(len(often), dtype=np.uint32)
        return pa.record_batch({
            "block": pa.array([block], pa.int64()), "doc_ids": pa.array([self.ids], pa.list_(pa.int64())),
            "targets": pa.array([self.targets], pa.list_(pa.bool_())),
            "lengths": pa.array([_planes(lengths, 4)], pa.binary()), "names": pa.array([names[often].tobytes()], pa.binary()),
            "numbers": pa.array([_planes(place[number], 4)], pa.binary()), "bytes": pa.array([self.bytes], pa.int64()),
            "n_words": pa.array([len(flat)], pa.int64()),
            "n_target": pa.array([int(lengths[np.array(self.targets, bool)].sum())], pa.int64())})


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of about BLOCK_BYTES of text, one row of the input at least."""
    now, block = _Block(), TaskContext.get().partitionId() << 32
    for part in slices(batches, "text"):
        now.add(part)
        if now.bytes >= BLOCK_BYTES:
            yield now.row(block)
            now, block = _Block(), block + 1
    if now.ids:
        yield now.row(block)
    forget_tables()


def _grams(row: dict) -> tuple:
    """(classes, cells, borders of the texts, distinct n-grams, their counts, their target counts)."""
    lengths = _values(row["lengths"], 4).astype(np.int64)
    borders = np.r_[0, np.cumsum(lengths)]
    words = np.frombuffer(row["names"], np.uint64)[_values(row["numbers"], 4)]
    classes, cells, begins = classes_and_cells(words, borders)
    chosen = np.repeat(np.array(row["targets"], bool), lengths)
    grams = np.r_[classes, cells[~begins]].view(np.uint64)
    chosen = np.r_[chosen, chosen[~begins]].astype(np.int64)
    names, n, of_target = _summed(grams, np.ones(len(grams), np.int64), chosen)
    return classes, cells, borders, names, n, of_target


def _summed(grams: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct n-grams, sorted, and the sums of their counts."""
    if not len(grams):
        return grams, *counts
    order = np.argsort(grams, kind="stable")
    grams = grams[order]
    first = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
    return grams[first], *(np.add.reduceat(c[order], first) for c in counts)


def _count(parts: int):
    """A block's counts, one row per range of n-grams."""
    borders = np.array([(p << 64) // parts for p in range(1, parts)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                _, _, _, grams, n, of_target = _grams(row)
                cuts = [0, *np.searchsorted(grams, borders).tolist(), len(grams)]
                rows = [(p, b, e) for p, (b, e) in enumerate(zip(cuts[:-1], cuts[1:])) if b < e]
                yield _pack([(row["block"], p, grams[b:e], n[b:e], of_target[b:e]) for p, b, e in rows])

    return run


def _planes(values: np.ndarray, width: int = 8) -> bytes:
    """Values of ``width`` bytes by byte, all lowest bytes first: what is small compresses."""
    return values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()


def _values(planes: bytes, width: int = 8) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, -1).T).view(f"<u{width}").reshape(-1)


def _pack(rows: list[tuple]) -> pa.RecordBatch:
    """Rows ``block, part`` with sorted n-grams, as differences, and their counts."""
    grams = [_planes(np.diff(r[2], prepend=np.uint64(0))) for r in rows]
    n, target = ([_planes(r[i], 4) for r in rows] for i in (3, 4))
    return pa.record_batch({
        "block": pa.array([r[0] for r in rows], pa.int64()), "part": pa.array([r[1] for r in rows], pa.int64()),
        "grams": pa.array(grams, pa.binary()), "n": pa.array(n, pa.binary()), "target": pa.array(target, pa.binary())})


def _sum(table: pa.Table) -> pa.Table:
    """For each block, in its order, the sums of the range's n-grams; 0 where no other block has it.

    ``vocabulary`` adds up to the distinct words of the range.
    """
    packed = [(np.cumsum(_values(grams), dtype=np.uint64), _values(n, 4).astype(np.int64), _values(target, 4).astype(np.int64))
              for grams, n, target in zip(*(table[c].to_pylist() for c in ("grams", "n", "target")))]
    grams, n, target, held = _summed(*(np.concatenate(c) for c in zip(*packed)),
                                     np.ones(sum(len(g) for g, _, _ in packed), np.int64))
    shared, ns, targets = held > 1, [], []
    for own, _, _ in packed:
        at = np.searchsorted(grams, own)
        ns.append(_planes(np.where(shared[at], n[at], 0)))
        targets.append(_planes(np.where(shared[at], target[at], 0)))
    words = int((grams & np.uint64(1) == 0).sum())
    return pa.table({
        "block": table["block"], "part": table["part"], "n": pa.array(ns, pa.binary()),
        "target": pa.array(targets, pa.binary()),
        "vocabulary": pa.array([words] + [0] * (len(packed) - 1), pa.int64())})


def _loss(singles: np.ndarray, pairs: np.ndarray, words: int, vocabulary: int, scale: float) -> float:
    """Mean negative log-probability of a text's words, by counts of each word and pair in the
    model, the text's own left out, and how many words those are of."""
    counts, pairs = np.maximum(singles, 0) * scale, np.maximum(pairs, 0) * scale
    chance = (counts + 1) / (max(words, 0) * scale + vocabulary)
    history = np.maximum(counts[:-1], pairs)
    chance[1:] = (pairs + PRIOR * chance[1:]) / (history + PRIOR)
    return float(-np.log(chance).mean())


def _own(values: np.ndarray) -> np.ndarray:
    """How often each value occurs in the array."""
    _, at, counts = np.unique(values, return_inverse=True, return_counts=True)
    return counts[at]


def _score(everything: int, chosen: int, vocabulary: int):
    """Scores of a block's texts, with the sums of n-grams that other blocks hold as well."""
    scale = chosen / everything if everything else 1.0

    def run(block: pa.Table, sums: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        classes, cells, borders, grams, n, of_target = _grams(row)
        if sums.num_rows:
            sums = sums.sort_by("part")
            total, total_target = (np.concatenate([_values(v).view(np.int64) for v in sums[c].to_pylist()]) for c in ("n", "target"))
            n, of_target = np.where(total > 0, total, n), np.where(total > 0, total_target, of_target)
        # A pair across two texts is in no count, and in no text either.
        last = max(0, len(grams) - 1)
        single, pair = (np.minimum(np.searchsorted(grams, v.view(np.uint64)), last) for v in (classes, cells))
        losses = []
        for begin, end, own in zip(borders[:-1].tolist(), borders[1:].tolist(), row["targets"]):
            if begin == end:
                losses.append((None, None))
                continue
            c, p = single[begin:end], pair[begin + 1:end]
            own_c, own_p = _own(c), _own(p)
            left = (1, end - begin) if own else (0, 0)
            losses.append((
                _loss(of_target[c] - left[0] * own_c, of_target[p] - left[0] * own_p, chosen - left[1], vocabulary, 1.0),
                _loss(n[c] - own_c, n[p] - own_p, everything - (end - begin), vocabulary, scale)))
        return pa.table({
            "doc_id": pa.array(row["doc_ids"], pa.int64()), "n_words": pa.array(np.diff(borders), pa.int64()),
            "target_loss": pa.array([t for t, _ in losses], pa.float64()),
            "background_loss": pa.array([b for _, b in losses], pa.float64())})

    return run


def scored(rows: DataFrame) -> DataFrame:
    """Losses of rows ``doc_id, text, target``. Runs jobs that stage the blocks and count them."""
    blocks, sizes = observed(
        rows.mapInArrow(_blocks, _BLOCK), "lm-blocks", F.sum("bytes").alias("bytes"),
        F.sum("n_words").alias("words"), F.sum("n_target").alias("target"))
    with options(rows.sparkSession, _TIGHT):
        blocks = staged(blocks, "lm-blocks")
    sizes = measured(sizes)
    parts = (sizes.get("bytes") or 0) // RANGE_BYTES + 1
    kept = blocks.select("block", "doc_ids", "targets", "lengths", "names", "numbers")
    counts = kept.mapInArrow(_count(parts), _PACKED)
    sums, found = observed(counts.groupBy("part").applyInArrow(_sum, _SUMS), "lm-sums", F.sum("vocabulary").alias("vocabulary"))
    with options(rows.sparkSession, _TIGHT):
        sums = staged(sums, "lm-sums")
    sums = sums.select(F.col("block").alias("of"), "part", "n", "target")
    return kept.groupBy("block").cogroup(sums.groupBy("of")).applyInArrow(
        _score(sizes.get("words") or 0, sizes.get("target") or 0, measured(found).get("vocabulary") or 0), _SCORES)


def difference_scores(docs: DataFrame, targets: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, target_loss, background_loss, score`` of every row. Runs jobs.

    ``targets`` holds the ids (``doc_id``) of target documents; it is broadcast only if it
    measures small.
    """
    ids = targets.select(F.col("doc_id").cast("long").alias("named")).filter("named IS NOT NULL").distinct()
    rows = pick(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = rows.join(broadcast_if_small(ids), F.col("doc_id") == F.col("named"), "left").select(
        "doc_id", "text", F.col("named").isNotNull().alias("target"))
    return scored(rows).withColumn(
        "score", F.col("target_loss") - F.col("background_loss"))
