"""Event-time windows over streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from etlkit.streaming.files import with_event_time


def time_span(df: DataFrame, column: str) -> str:
    """How far a stored row can lie behind the newest one, whatever order its files come in:
    a watermark delay that drops nothing of ``df``. Runs one aggregate job."""
    time = F.col(column).cast("timestamp")
    found = df.agg((F.unix_micros(F.max(time)) - F.unix_micros(F.min(time))).alias("micros")).first()
    return f"{(found['micros'] or 0) // 1_000_000 + 1} seconds"


def _flatten(grouped: DataFrame) -> DataFrame:
    rest = [c for c in grouped.columns if c != "window"]
    return grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def windowed_aggregate(
    df: DataFrame,
    time_column: str,
    metrics: Sequence[Column],
    size: str,
    slide: str | None = None,
    keys: Sequence[str] = (),
    watermark: str | None = None,
) -> DataFrame:
    """Metrics per tumbling or, with ``slide``, sliding window and key.

    A watermark bounds the state and drops rows whose window it has passed.
    Works on streams and on batches.
    """
    timed = with_event_time(df, time_column)
    if watermark:
        timed = timed.withWatermark(time_column, watermark)
    window = F.window(time_column, size, slide) if slide else F.window(time_column, size)
    return _flatten(timed.groupBy(window.alias("window"), *keys).agg(*metrics))


def session_aggregate(
    df: DataFrame,
    time_column: str,
    metrics: Sequence[Column],
    gap: str,
    keys: Sequence[str],
    watermark: str | None = None,
) -> DataFrame:
    """Metrics per key and session, a session ending after ``gap`` without events.

    Queries started through ``streaming.files`` merge sessions per task before the
    shuffle, so a busy key sends sessions rather than events.
    """
    timed = with_event_time(df, time_column)
    if watermark:
        timed = timed.withWatermark(time_column, watermark)
    window = F.session_window(time_column, gap).alias("window")
    return _flatten(timed.groupBy(*keys, window).agg(*metrics))
