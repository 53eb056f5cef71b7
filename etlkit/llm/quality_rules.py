"""Quality rules: fixed limits, then robust multivariate outliers per language and source.

A text fails the base rule if it has fewer than ``MIN_WORDS`` words or if more than
``MOST_REPEATED`` of its words lie in repeated windows. Of the rest, each becomes a vector of
transformed statistics: the log of its mean word length, and the arcsine of the square root of
its symbols, repeated lines and repeated words per word. Each language and source gets a
reweighted minimum-covariance-determinant estimate of location and scatter from all its
vectors, and vectors beyond the cutoff by Mahalanobis distance are rejected.

The estimate is found as in deterministic MCD: three starting scatters (robust scales alone,
spatial signs, hyperbolic tangents), then concentration steps, each of which takes the nearest
``SHARE`` of a group's vectors and estimates anew from them; the start with the smallest
determinant goes on until nothing moves or the determinant falls no more. A step is one aggregation for all groups at once: vectors
are summed by distance class (a sixteenth of an octave), so a group of any size is a few hundred
rows after the map side, and the nearest share ends with a class. Vectors are whole multiples of
1/``UNIT``, so sums are exact and do not depend on the order of tasks.

Every scatter has ``NOISE`` added to its diagonal, the sampling variance of these statistics in a
text of ``MIN_WORDS`` words. So statistics that are the same in most texts leave it regular.

Cases: null or empty texts have no words and fail the base rule; null languages and sources
form groups of their own; a group of any size, one text included, has an estimate; repeated rows
count as often as they occur and are judged alike; texts of any length are read whole; an empty
table gives an empty result; other columns are ignored by ``judged`` and carried by ``kept``.
"""

from __future__ import annotations

import math
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from etlkit.llm.text_statistics import COUNTS, with_counts
from etlkit.operators.reuse import staged
from etlkit.operators.sizing import is_small

MIN_WORDS = 20
# Percent of the words that may lie in repeated windows.
MOST_REPEATED = 30
# The part of a group that the determinant is minimised over.
SHARE = 0.75
# Chi-square quantiles: vectors that the reweighted estimate uses, and vectors that are kept.
REWEIGHT, CUTOFF = 0.975, 0.999
UNIT = 1024
NOISE = 1 / (4 * MIN_WORDS)
# Steps with all starts; steps at most.
TRIAL_STEPS, STEPS = 2, 40
# A step that lowers the log determinant by less is a group's last one.
LEAST_GAIN = 1e-6

_N = 4
_PAIRS = list(combinations_with_replacement(range(_N), 2))
_CLASSES = 16
_FINE = 1 << 20
_GROUP = ["lang", "source"]
_ESTIMATE = ("start int, mean array<double>, whiten array<double>, det double, n long, taken long, "
             "sign string, moved boolean")
_X = [f"x{i}" for i in range(_N)]


def chi_square(x: float, degrees: int) -> float:
    """Probability that a chi-square variable is at most ``x``."""
    value, at = (math.erf(math.sqrt(x / 2)), 1) if degrees % 2 else (1 - math.exp(-x / 2), 2)
    while at < degrees:
        value -= (x / 2) ** (at / 2) * math.exp(-x / 2) / math.gamma(at / 2 + 1)
        at += 2
    return value


def chi_square_quantile(share: float, degrees: int) -> float:
    """By bisection; 60 halvings of an interval that doubles until it holds the value."""
    low, high = 0.0, 1.0
    while chi_square(high, degrees) < share:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < share else (low, middle)
    return high


def consistency(share: float) -> float:
    """Factor that makes the scatter of the nearest ``share`` of normal vectors that of all."""
    if share >= 1:
        return 1.0
    return share / chi_square(chi_square_quantile(share, _N), _N + 2)


def base_failed() -> Column:
    words = F.col("n_words")
    return (words < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * words)


def _vector() -> list[Column]:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")

    def share(count: str) -> Column:
        return F.asin(F.sqrt(F.least(F.lit(1.0), F.col(count) / words)))

    length = F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words)
    values = [length, share("n_symbols"), share("n_dup_lines"), share("n_repeat_words")]
    return [F.round(v * UNIT).cast("long").alias(x) for v, x in zip(values, _X)]


def _estimate(start: int, mean: np.ndarray, scatter: np.ndarray, n: int, taken: int, sign: str, moved: bool) -> dict:
    """A row of ``_ESTIMATE``; ``whiten`` is the lower triangle that turns ``x - mean`` into unit scatter."""
    scatter = scatter + np.eye(_N) * NOISE * UNIT**2
    lower = np.linalg.cholesky(scatter)
    whiten = np.linalg.inv(lower)
    return {"start": start, "mean": mean.tolist(), "whiten": whiten[np.tril_indices(_N)].tolist(),
            "det": float(2 * np.log(np.diag(lower)).sum()), "n": n, "taken": taken, "sign": sign, "moved": moved}


def _rows(group: pa.Table | pa.RecordBatch, rows: list[dict], schema: pa.Schema) -> pa.Table:
    """``rows`` with the key of ``group``."""
    key = {name: group[name][0].as_py() for name in _GROUP} if group.num_rows else {}
    return pa.Table.from_pylist([key | row for row in rows], schema)


_ARROW = pa.schema([
    ("lang", pa.string()), ("source", pa.string()), ("start", pa.int32()), ("mean", pa.list_(pa.float64())),
    ("whiten", pa.list_(pa.float64())), ("det", pa.float64()), ("n", pa.int64()), ("taken", pa.int64()),
    ("sign", pa.string()), ("moved", pa.bool_())])
_CENTERS = pa.schema([
    ("lang", pa.string()), ("source", pa.string()), ("mid", pa.list_(pa.float64())), ("scale", pa.list_(pa.float64()))])


def _middle(values: np.ndarray, times: np.ndarray) -> float:
    order = np.argsort(values, kind="stable")
    return float(values[order][np.searchsorted(np.cumsum(times[order]), (times.sum() + 1) // 2)])


def _center(group: pa.Table) -> pa.Table:
    """Median and median deviation per coordinate, from how often each value occurs."""
    axis, value, times = (group[c].to_numpy() for c in ("axis", "value", "times"))
    mid, scale = [], []
    for i in range(_N):
        own, n = value[axis == i], times[axis == i]
        mid.append(_middle(own, n))
        spread = 1.4826 * _middle(np.abs(own - mid[-1]), n)
        scale.append(max(spread, math.sqrt(NOISE) * UNIT))
    return _rows(group, [{"mid": mid, "scale": scale}], _CENTERS)


def _square(values: list) -> np.ndarray:
    out = np.zeros((_N, _N))
    for (i, j), value in zip(_PAIRS, values):
        out[i, j] = out[j, i] = value
    return out


def _starts(group: pa.Table) -> pa.Table:
    """Three scatters around the medians."""
    row = group.to_pylist()[0]
    n, mid, scale = row["n"], np.array(row["mid"]), np.array(row["scale"])
    signs = _square([row[f"s{k}"] for k in range(len(_PAIRS))]) * _N / (n * _FINE)
    bent = _square([row[f"t{k}"] for k in range(len(_PAIRS))]) / (n * _FINE)
    mean = np.array([row[f"m{i}"] for i in range(_N)]) / (n * _FINE)
    bent -= np.outer(mean, mean)
    width = np.sqrt(np.maximum(np.diag(bent), 1e-6))
    shapes = [np.eye(_N), signs, bent / np.outer(width, width)]
    return _rows(group, [
        _estimate(start, mid, shape * np.outer(scale, scale), n, 0, "", True) | {"det": math.inf}
        for start, shape in enumerate(shapes)], _ARROW)


def _moments(group: pa.Table, upto: int) -> tuple[int, np.ndarray, np.ndarray, str]:
    """(rows, mean, scatter, text that tells equal sums) of the first ``upto`` classes.

    From exact sums: Python's whole numbers, divided once.
    """
    def total(name: str) -> int:
        return sum(group[name].slice(0, upto).to_pylist())

    n, sums = total("rows"), [total(f"a{i}") for i in range(_N)]
    products = [total(f"b{k}") for k in range(len(_PAIRS))]
    scatter = _square([(n * p - sums[i] * sums[j]) / (n * n) for p, (i, j) in zip(products, _PAIRS)])
    return n, np.array([s / n for s in sums]), scatter, repr((n, sums, products))


def _concentrated(group: pa.Table) -> pa.Table:
    """One concentration step from the sums by distance class."""
    group = group.sort_by("class")
    counts = np.cumsum(group["rows"].to_numpy())
    upto = int(np.searchsorted(counts, math.ceil(SHARE * int(counts[-1])))) + 1
    taken, mean, scatter, sign = _moments(group, upto)
    n, before = int(counts[-1]), group["det"][0].as_py()
    row = _estimate(group["start"][0].as_py(), mean, scatter * consistency(taken / n), n, taken, sign, False)
    row["moved"] = sign != group["sign"][0].as_py() and row["det"] < before - LEAST_GAIN
    return _rows(group, [row], _ARROW)


def _reweighted(group: pa.Table) -> pa.Table:
    taken, mean, scatter, sign = _moments(group, 1)
    # The share that is cut away from normal vectors is known.
    return _rows(group, [_estimate(
        group["start"][0].as_py(), mean, scatter * consistency(REWEIGHT), taken, taken, sign, False)], _ARROW)


def _with(rows: DataFrame, table: DataFrame, small: bool) -> DataFrame:
    """Rows with their group's row of ``table``: broadcast if measured small."""
    table = table.withColumnsRenamed({g: f"__{g}" for g in _GROUP})
    on = [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in _GROUP]
    return rows.join(F.broadcast(table) if small else table, on).drop(*[f"__{g}" for g in _GROUP])


def squared_distance() -> Column:
    """Squared Mahalanobis distance of the vector columns under ``mean`` and ``whiten``."""
    out, at = F.lit(0.0), 0
    for i in range(_N):
        part = F.lit(0.0)
        for j in range(i + 1):
            part = part + F.get("whiten", F.lit(at)) * (F.col(_X[j]) - F.get("mean", F.lit(j)))
            at += 1
        out = out + part * part
    return out


def _summed(rows: DataFrame, by: list[str]) -> DataFrame:
    sums = [F.sum(x).alias(f"a{i}") for i, x in enumerate(_X)]
    products = [F.sum(F.col(_X[i]) * F.col(_X[j])).alias(f"b{k}") for k, (i, j) in enumerate(_PAIRS)]
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *sums, *products)


def _schema(columns: str) -> str:
    return f"lang string, source string, {columns}"


def estimates(vectors: DataFrame) -> DataFrame:
    """One row per group with its reweighted estimate. Runs a few jobs per step.

    ``vectors`` has ``lang, source`` and the vector's columns, and is read once per step.
    """
    axes = F.explode(F.array(*[F.struct(F.lit(i).alias("axis"), F.col(x).alias("value")) for i, x in enumerate(_X)]))
    values = vectors.select(*_GROUP, axes.alias("v")).groupBy(*_GROUP, "v.axis", "v.value").agg(
        F.count(F.lit(1)).alias("times"))
    centers = staged(values.groupBy(*_GROUP).applyInArrow(
        _center, _schema("mid array<double>, scale array<double>")), "centers")
    small = is_small(centers, 4 << 20)  # an estimate takes a few times as much

    z = [(F.col(x) - F.get("mid", F.lit(i))) / F.get("scale", F.lit(i)) for i, x in enumerate(_X)]
    placed = _with(vectors, centers, small).select(
        *_GROUP, "mid", "scale", *[c.alias(f"z{i}") for i, c in enumerate(z)])
    zs = [F.col(f"z{i}") for i in range(_N)]
    norm = sum((c * c for c in zs), F.lit(0.0))
    bent = [F.tanh(c) for c in zs]

    def fine(value: Column, name: str) -> Column:
        return F.sum(F.round(value * _FINE).cast("long")).alias(name)

    shapes = placed.groupBy(*_GROUP, "mid", "scale").agg(
        F.count(F.lit(1)).alias("n"),
        *[fine(bent[i], f"m{i}") for i in range(_N)],
        *[fine(F.when(norm > 0, zs[i] * zs[j] / norm).otherwise(0.0), f"s{k}") for k, (i, j) in enumerate(_PAIRS)],
        *[fine(bent[i] * bent[j], f"t{k}") for k, (i, j) in enumerate(_PAIRS)])
    now = staged(shapes.groupBy(*_GROUP).applyInArrow(_starts, _schema(_ESTIMATE)), "estimates")

    d2 = squared_distance()
    classes = F.when(d2 > 0, F.floor(F.log2(d2) * _CLASSES)).otherwise(F.lit(-(1 << 20))).cast("int")
    for step in range(STEPS):
        moving = now.filter("moved")
        if moving.isEmpty():
            break
        placed = _with(vectors, moving.select(*_GROUP, "start", "mean", "whiten", "sign", "det"), small)
        summed = _summed(placed.withColumn("class", classes), [*_GROUP, "start", "sign", "det", "class"])
        moved = summed.groupBy(*_GROUP, "start", "sign", "det").applyInArrow(_concentrated, _schema(_ESTIMATE))
        after = now.filter("NOT moved").union(moved)
        if step == TRIAL_STEPS - 1:
            fields = [c for c in now.columns if c not in _GROUP]
            after = after.groupBy(*_GROUP).agg(
                F.min_by(F.struct(*fields), F.struct("det", "start")).alias("e")).select(*_GROUP, "e.*")
        now = staged(after, "estimates")

    near = _with(vectors, now.select(*_GROUP, "start", "mean", "whiten"), small).filter(
        d2 <= chi_square_quantile(REWEIGHT, _N))
    summed = _summed(near.withColumn("sign", F.lit("")), [*_GROUP, "start", "sign"])
    return staged(summed.groupBy(*_GROUP).applyInArrow(_reweighted, _schema(_ESTIMATE)), "estimates")


def _judged(counted: DataFrame) -> DataFrame:
    """``counted`` with ``base_failed``, ``distance`` (null where the base rule failed) and ``kept``."""
    vectors = counted.withColumn("base_failed", base_failed()).withColumns(dict(zip(_X, _vector())))
    good = staged(vectors.filter("NOT base_failed").select(*_GROUP, *_X), "vectors")
    found = estimates(good).select(*_GROUP, "mean", "whiten")
    small = is_small(found)
    found = found.withColumnsRenamed({g: f"__{g}" for g in _GROUP})
    on = [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in _GROUP]
    # Left: a group in which every text fails the base rule has no estimate.
    joined = vectors.join(F.broadcast(found) if small else found, on, "left")
    distance = F.when(~F.col("base_failed"), F.sqrt(squared_distance()))
    limit = math.sqrt(chi_square_quantile(CUTOFF, _N))
    return joined.withColumn("distance", distance).withColumn(
        "kept", F.coalesce(F.col("distance") <= limit, F.lit(False))).drop(
        *_X, "mean", "whiten", *[f"__{g}" for g in _GROUP])


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
           source: str = "source") -> DataFrame:
    """``doc_id``, ``lang``, ``source``, the counts, ``base_failed``, ``distance`` and ``kept`` of every row.

    Runs jobs. Texts are read once; the counts are staged.
    """
    counted = staged(with_counts(docs, text, doc_id=doc_id, lang=lang, source=source), "counts")
    return _judged(counted).select("doc_id", *_GROUP, *COUNTS, "base_failed", "distance", "kept")


def kept(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass both the base rule and the distance. Runs jobs.

    A row is found again by its text, language and source: equal ones are judged alike. Only a
    digest of the text is joined.
    """
    digest = F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256)
    marked = docs.select(digest.alias("digest"), *[F.col(f"`{c}`").alias(n) for n, c in
                                                  (("text", text), ("lang", lang), ("source", source))])
    counted = staged(with_counts(marked, "text", digest="digest", lang="lang", source="source"), "counts")
    passed = _judged(counted).filter("kept").select("digest", *_GROUP).distinct()
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"))
    on = [F.sha2(F.coalesce(F.col(f"doc.`{text}`"), F.lit("")), 256) == F.col("digest"),
          F.col(f"doc.`{lang}`").eqNullSafe(F.col("lang")), F.col(f"doc.`{source}`").eqNullSafe(F.col("source"))]
    return rows.join(passed, on, "left_semi").select("doc.*")
