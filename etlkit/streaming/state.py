"""Keyed state over streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from etlkit.operators.sizing import is_hot, salts_for
from etlkit.streaming.files import with_event_time

TOTALS_SCHEMA = "key long, salt int, part long, events long, total_cents long"


def _add_to_totals(idle_ms: int | None):
    def run(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        part, events, cents = state.get if state.exists else (None, 0, 0)
        newest = 0
        for batch in batches:
            part = int(batch["at"].min()) if part is None else part
            newest = max(newest, int(batch["at"].max()))
            events += len(batch)
            cents += int(batch["cents"].sum())
        state.update((part, events, cents))
        if idle_ms is not None:
            state.setTimeoutTimestamp(max(newest, state.getCurrentWatermarkMs()) + idle_ms)
        key = pd.array([None if pd.isna(group[0]) else group[0]], dtype="Int64")
        yield pd.DataFrame({"key": key, "salt": [group[1]], "part": [part], "events": [events], "total_cents": [cents]})

    return run


def running_totals(
    df: DataFrame, key: str, value: str, row_id: str,
    hot: dict[int, float] | None = None, salts: int | None = None,
    time_column: str | None = None, lateness: str | None = None, idle_ms: int | None = None,
) -> DataFrame:
    """Running event count and exact total of ``value`` per key, emitted on each update.

    ``hot`` names busy keys (see ``hot_keys``, run on stored events): their state is
    kept per (key, salt) so that several tasks share them. ``merge_totals`` adds the
    parts up, also when a later run salts differently. Amounts travel as whole cents.

    With ``idle_ms`` the state of a key goes when its events are that far behind the
    watermark (``time_column`` less ``lateness``); events that come later start a new
    ``part``, named by its first event's time in milliseconds. Without it state is kept.
    """
    cents = F.round(F.col(value) * 100).cast("long")
    spread = F.pmod(F.xxhash64(row_id), F.lit(salts or salts_for(df, hot or {}))).cast("int")
    salt = F.when(is_hot(df, [key], hot or {}), spread).otherwise(F.lit(0))
    columns = [F.col(key).cast("long").alias("key"), salt.alias("salt"), cents.alias("cents")]
    timeout = GroupStateTimeout.NoTimeout
    if idle_ms is None:
        rows = df.select(*columns, F.lit(0).cast("long").alias("at"))
    else:
        if not (time_column and lateness):
            raise ValueError("idle_ms needs time_column and lateness")
        timeout = GroupStateTimeout.EventTimeTimeout
        timed = with_event_time(df, time_column).withWatermark(time_column, lateness)
        rows = timed.select(*columns, F.unix_millis(time_column).alias("at"), time_column)
    return rows.groupBy("key", "salt").applyInPandasWithState(
        _add_to_totals(idle_ms), TOTALS_SCHEMA, "part long, events long, cents long", "update", timeout)


def merge_totals(parts: DataFrame) -> DataFrame:
    """Totals per key from the latest row of each (key, salt, part)."""
    return parts.groupBy("key").agg(
        F.sum("events").alias("events"),
        (F.sum("total_cents") / 100).alias("total"))
