"""Join values to the bands ``[low, high)`` that contain them.

Bands that measure small are broadcast: each is cut into two or three bins of its own width's power
of two, and a value joins on its bin of each such power. A wide band among narrow ones costs
one power more and no bin of the others.

Beyond that a plane is swept. Values and bands go to ranges of one axis, cut at quantiles of
both, a band to every range that it reaches. Each range is sorted and swept once: bands open and
close as the sweep passes their ends, and values meet the open ones. A band that is carried
through a whole range matches all of its values, so copies and work stay in proportion to
the rows and the result, however the widths differ. A value that holds many rows spreads over
the ranges that its quantiles name.

Both ways compare bounds as doubles, ends included; exact bounds are checked afterwards.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from etlkit.operators.ranks import place
from etlkit.operators.reuse import staged
from etlkit.operators.sizing import BROADCAST_LIMIT_BYTES, broadcast_if_small, is_small, row_salt, shuffle_partitions

# Pairs put together at once.
_PAIRS = 1 << 16
_SPREAD = 1 << 20
_HUGE = 1e308


def _axis(value: Column, default: float) -> Column:
    """A bound or value as a double; NaN, which is above all numbers, as infinity."""
    number = value.cast("double")
    return F.when(F.isnan(number), F.lit(math.inf)).otherwise(F.coalesce(number, F.lit(default)))


def band_join(
    df: DataFrame,
    value: str,
    bands: DataFrame,
    low: str,
    high: str,
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Inner join ``df`` to every band with ``low <= value < high``; bounds are numeric.

    While the bands measure small, ``df`` is not shuffled; beyond that it is shuffled once, to
    be swept by Arrow batches. A null bound is an open end. Runs small jobs over ``bands`` and,
    before a sweep, one over the value column.
    """
    met = candidates(df, value, bands, low, high, limit_bytes)
    at, start, end = F.col(f"fact.`{value}`"), F.col(f"band.`{low}`"), F.col(f"band.`{high}`")
    inside = (start.isNull() | (at >= start)) & (end.isNull() | (at < end))
    return met.filter(inside).select("fact.*", "band.*")


def candidates(
    df: DataFrame, value: str, bands: DataFrame, low: str, high: str, limit_bytes: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """``fact`` and ``band`` as structs: all pairs that match and others that nearly do."""
    facts = df.filter(F.col(value).isNotNull()).select(
        F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("fact"), _axis(F.col(value), 0.0).alias("__axis"))
    ranged = bands.select(
        F.struct(*[bands[f"`{c}`"] for c in bands.columns]).alias("band"),
        _axis(F.col(low), -math.inf).alias("__from"), _axis(F.col(high), math.inf).alias("__to"))
    ranged = ranged.filter(F.col("__from") <= F.col("__to"))
    cut = staged(_binned(ranged), "bands")
    if is_small(cut, limit_bytes):
        return _by_bins(facts, cut, ranged, limit_bytes)
    return _by_sweep(facts, ranged)


def _ends(ranged: DataFrame) -> tuple[Column, Column]:
    """The least and the largest finite end."""
    end = F.explode(F.array("__from", "__to")).alias("end")
    found = ranged.select(end).filter(F.abs("end") != math.inf).agg(
        F.min("end").alias("a"), F.max("end").alias("b")).first()
    return F.lit(float(found["a"] or 0.0)), F.lit(float(found["b"] or 0.0))


def _clamped(axis: str, ends: tuple[Column, Column]) -> Column:
    return F.least(F.greatest(F.col(axis), ends[0]), ends[1])


def _bin(number: Column, level: Column) -> Column:
    # Beyond the range of a long, bins are its last ones on both sides.
    return F.floor(number / F.pow(F.lit(2.0), level))


def _binned(ranged: DataFrame) -> DataFrame:
    """Each band once for each bin that it reaches: two or three, of its width's power of two."""
    ends = _ends(ranged)
    start, end = _clamped("__from", ends), _clamped("__to", ends)
    width = F.least(end - start, F.lit(_HUGE))
    level = F.when(width > 0, F.floor(F.log2(width)).cast("int")).otherwise(F.lit(0))
    leveled = ranged.select("band", level.alias("__level"), start.alias("__start"), end.alias("__end"))
    bins = F.sequence(_bin(F.col("__start"), F.col("__level")), _bin(F.col("__end"), F.col("__level")))
    return leveled.select("band", "__level", F.explode(bins).alias("__bin"))


def _by_bins(facts: DataFrame, cut: DataFrame, ranged: DataFrame, limit_bytes: int) -> DataFrame:
    levels = sorted(r["__level"] for r in cut.select("__level").distinct().collect())  # powers of two of doubles
    if not levels:
        return facts.join(cut, F.lit(False)).select("fact", "band")
    level = F.explode(F.array(*map(F.lit, levels))) if len(levels) > 1 else F.lit(levels[0])
    keyed = facts.withColumn("__axis", _clamped("__axis", _ends(ranged))).withColumn("__level", level)
    keyed = keyed.withColumn("__bin", _bin(F.col("__axis"), F.col("__level")))
    return keyed.join(broadcast_if_small(cut, limit_bytes), ["__level", "__bin"]).select("fact", "band")


def _quantiles(facts: DataFrame, ranged: DataFrame, ranges: int) -> list[float]:
    """Ascending cuts that leave about as many values and band ends in each range; a value that
    holds several ranges' rows is named several times."""
    axis = facts.select("__axis").union(ranged.select(F.explode(F.array("__from", "__to"))))
    shares = [i / ranges for i in range(1, ranges)]
    if not shares:
        return []
    row = axis.filter(F.abs("__axis") != math.inf).agg(
        F.percentile_approx("__axis", shares, 10 * ranges).alias("cuts")).first()
    return [float(c) for c in row["cuts"] or []]


def _by_sweep(facts: DataFrame, ranged: DataFrame) -> DataFrame:
    ranges = shuffle_partitions(facts)
    bounds = _quantiles(facts, ranged, ranges)
    first, last = place(bounds, F.col("__axis"), False), place(bounds, F.col("__axis"), True)
    spread = F.pmod(row_salt(facts, _SPREAD), last - first + 1)
    kinds = {name: frame.schema[name].dataType for frame, name in ((facts, "fact"), (ranged, "band"))}
    none = {name: F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()}
    values = facts.select(
        (first + spread).cast("int").alias("range"), F.col("__axis").alias("axis"), F.lit(1).alias("side"),
        F.lit(None).cast("double").alias("until"), "fact", none["band"])
    reached = F.sequence(place(bounds, F.col("__from"), False), place(bounds, F.col("__to"), True))
    opened = ranged.select(
        F.explode(reached).alias("range"), F.col("__from").alias("axis"), F.lit(0).alias("side"),
        F.col("__to").alias("until"), none["fact"], "band")
    rows = values.union(opened).repartitionById(ranges, "range").sortWithinPartitions("range", "axis", "side")
    return rows.mapInArrow(_sweep, T.StructType([T.StructField(n, k) for n, k in kinds.items()]))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of values and open bands, from rows sorted by range, axis and side (bands first).

    What is kept from batch to batch are the bands that are still open.
    """
    now, start, until, opened = None, np.zeros(0), np.zeros(0), None
    for batch in batches:
        ranges = batch["range"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(ranges)) + 1).tolist(), len(ranges)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            part = batch.slice(a, b - a)
            if ranges[a] != now:
                now, start, until, opened = ranges[a], np.zeros(0), np.zeros(0), None
            axis, side = part["axis"].to_numpy(), part["side"].to_numpy()
            own = np.flatnonzero(side == 0)
            if len(own):
                start, until = np.r_[start, axis[own]], np.r_[until, part["until"].take(own).to_numpy()]
                new = part["band"].take(own)
                opened = pa.concat_arrays([opened, new]) if opened is not None else new
            facts = np.flatnonzero(side == 1)
            if opened is not None and len(facts):
                yield from _pairs(part["fact"].take(facts), axis[facts], opened, start, until)
                still = until >= axis[-1]
                start, until, opened = start[still], until[still], opened.filter(pa.array(still))


def _pairs(facts: pa.Array, axis: np.ndarray, opened: pa.Array, start: np.ndarray, until: np.ndarray) -> Iterator[pa.RecordBatch]:
    low, high = np.searchsorted(axis, start, "left"), np.searchsorted(axis, until, "right")
    met = np.flatnonzero(high > low)
    low, times = low[met], (high - low)[met]
    total = np.cumsum(times)
    at = 0
    while at < len(met):
        done = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + _PAIRS, "right")))
        n = times[at:to]
        begins = np.repeat(low[at:to] - (total[at:to] - n - done), n)
        yield pa.record_batch([facts.take(pa.array(begins + np.arange(len(begins)))),
                               opened.take(pa.array(np.repeat(met[at:to], n)))], ["fact", "band"])
        at = to
