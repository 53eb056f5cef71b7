"""Sessions that are reported once, when a timer closes them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.query import StreamingQuery

from etlkit.session import options
from etlkit.streaming.files import with_event_time, write_batches

# Timers need a store with an order of its own.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
_PART = "key string, first long, last long, events long, cents long"
_CLOSED = ["key", "first", "last", "events", "cents"]
_PACKED = pa.schema([("key", pa.string()), *((c, pa.int64()) for c in _CLOSED[1:])])
# Groups that keys are dealt to. Each costs a few calls to the state store in a batch, whatever it holds.
GROUPS = 1024
# Rows that are merged into a group's sessions at once, at least.
_MERGE_ROWS = 1 << 16


def _combine(gap: int):
    """Merge the events of one Arrow batch, so that a busy key sends sessions and not events."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            batch = batch.sort_values(["key", "at"], kind="stable", ignore_index=True)
            key, at = batch["key"], batch["at"].to_numpy()
            before = key.shift()
            same = ((key == before) | (key.isna() & before.isna())).to_numpy(dtype=bool)
            same[0] = False
            starts = np.flatnonzero(~same | (np.diff(at, prepend=at[0]) >= gap))
            ends = np.append(starts[1:], len(at))
            yield pd.DataFrame({
                "key": key.to_numpy()[starts], "first": at[starts], "last": at[ends - 1], "events": ends - starts,
                "cents": np.add.reduceat(batch["cents"].to_numpy(), starts)})

    return run


def _merged(parts: list[pd.DataFrame], gap: int) -> pd.DataFrame:
    """Parts of sessions of any keys as whole sessions."""
    joined = pd.concat(parts, ignore_index=True)
    if joined.empty:
        return joined
    code = pd.factorize(joined["key"], use_na_sentinel=False)[0]
    order = np.lexsort((joined["first"].to_numpy(), code))
    code, joined = code[order], joined.iloc[order]
    first, until = joined["first"].to_numpy(), joined["last"].groupby(code).cummax().to_numpy()
    starts = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (first[1:] >= until[:-1] + gap)])
    return pd.DataFrame({
        "key": joined["key"].to_numpy()[starts], "first": first[starts],
        "last": np.maximum.reduceat(joined["last"].to_numpy(), starts),
        **{c: np.add.reduceat(joined[c].to_numpy(), starts) for c in ("events", "cents")}})


class _Sessions(StatefulProcessor):
    """Open sessions of a group of keys in one value, with a timer where the first of them ends."""

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "due long, packed binary")

    def _ends(self, sessions: pd.DataFrame) -> np.ndarray:
        """The first whole milliseconds at which no event can join any more."""
        return -(-(sessions["last"].to_numpy() + self.gap) // 1000)

    def _held(self) -> tuple[int | None, pd.DataFrame]:
        due, packed = self.open.get() or (None, None)
        if due is None:
            return None, _PACKED.empty_table().to_pandas()
        return due, pa.ipc.open_stream(packed).read_all().to_pandas()

    def _hold(self, sessions: pd.DataFrame, before: int | None) -> None:
        """Keep the sessions, and one timer for them, in place of the one at ``before``."""
        due = int(self._ends(sessions).min()) if len(sessions) else None
        if before is not None and before != due:
            self.handle.deleteTimer(before)
        if due is None:
            self.open.clear()
            return
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _PACKED) as stream:
            stream.write_table(pa.Table.from_pandas(sessions, _PACKED, preserve_index=False))
        self.open.update((due, sink.getvalue().to_pybytes()))
        if before != due:
            self.handle.registerTimer(due)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        due, sessions = self._held()
        waiting, n = [], 0
        for batch in rows:
            waiting.append(batch[_CLOSED])
            n += len(batch)
            if n > max(_MERGE_ROWS, len(sessions)):
                sessions, waiting, n = _merged([sessions, *waiting], self.gap), [], 0
        self._hold(_merged([sessions, *waiting], self.gap) if waiting else sessions, due)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due, sessions = self._held()
        done = self._ends(sessions) < max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs() + 1)
        # Spark itself removes the timer that went off.
        self._hold(sessions[~done], None if due == expiredTimerInfo.getExpiryTimeInMs() else due)
        if done.any():
            yield sessions[done]

    def close(self) -> None:
        pass


def closed_sessions(
    df: DataFrame, key: str, time_column: str, value: str, gap_seconds: int, lateness: str,
    groups: int = GROUPS,
) -> DataFrame:
    """Stream of ``key, window_start, window_end, events, total``: each session once, when the
    watermark (``time_column`` less ``lateness``) has passed its end, ``gap_seconds`` after its last event.

    The state holds open sessions only, at most ``lateness`` / gap of a key, in a RocksDB store (start
    the stream with ``write_sessions``). Keys share it in ``groups``, each with its sessions in one value
    and a timer for the first that ends, so calls to the store grow with the groups and not with the
    sessions; the number must stay the same for a checkpoint, and a task works on one group at a time.
    Events are merged per Arrow batch before the shuffle. A
    null key is a key like others; events without a time are left out, ones without a
    value count as 0. An event behind the watermark is dropped, and counted, unless it
    came in one Arrow batch with a later one of its session. Totals are exact in cents.
    """
    gap = gap_seconds * 1_000_000
    timed = with_event_time(df, time_column).filter(F.col(time_column).isNotNull())
    events = timed.select(
        F.col(key).cast("string").alias("key"), F.unix_micros(time_column).alias("at"),
        F.coalesce(F.round(F.col(value) * 100), F.lit(0)).cast("long").alias("cents"))
    parts = events.mapInPandas(_combine(gap), _PART).withColumn("seen", F.timestamp_micros("last"))
    grouped = parts.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups)))
    closed = grouped.withWatermark("seen", lateness).groupBy("group").transformWithStateInPandas(
        _Sessions(gap), _PART, "append", "EventTime")
    return closed.select(
        F.col("key").cast(df.schema[key].dataType).alias(key), F.timestamp_micros("first").alias("window_start"),
        F.timestamp_micros(F.col("last") + gap).alias("window_end"), "events", (F.col("cents") / 100).alias("total"))


def write_sessions(df: DataFrame, path: str, checkpoint: str, **settings) -> StreamingQuery:
    """``write_batches`` of closed sessions, with the state store that their timers need."""
    with options(df.sparkSession, ROCKSDB):
        return write_batches(df, path, checkpoint, "append", **settings)
