"""Streams over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from etlkit.operators.metrics import exact_sum
from etlkit.operators.sizing import hot_keys
from etlkit.queries.registry import query, table
from etlkit.streaming.files import compact_updates, latest_rows, stream_files, write_batches, write_stream
from etlkit.streaming.sessions import closed_sessions, write_sessions
from etlkit.streaming.state import merge_totals, running_totals
from etlkit.streaming.windows import session_aggregate, time_span, windowed_aggregate
from etlkit.workspace import new_path

COUNTS_SQL = "count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total"
# Running totals of a user without events for so long make room.
IDLE_MS = 7 * 86_400_000


def counts():
    return [F.count(F.lit(1)).alias("events"), exact_sum(F.col("value")).alias("total")]


def events_stream(spark, sf):
    return stream_files(spark, f"{sf}/events.parquet", table(spark, sf, "events").schema)


def _plain(df):
    """Window bounds without a time zone."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in df.columns
                           if c in ("window_start", "window_end")})


def _as_read(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def _complete(spark, df, label):
    base = new_path(spark, label)
    write_batches(df, f"{base}/out", f"{base}/checkpoint", "complete")
    return _plain(spark.read.schema(_as_read(df.schema)).parquet(f"{base}/out"))


def _lateness(spark, sf):
    return time_span(table(spark, sf, "events"), "ts")


def _updates(spark, df, label, keys):
    base = new_path(spark, label)
    write_batches(df, f"{base}/out", f"{base}/checkpoint", "update")
    compact_updates(spark, f"{base}/out", _as_read(df.schema), keys)
    return latest_rows(spark, f"{base}/out", _as_read(df.schema), keys)


@query("stream_passthrough", "SELECT * FROM events")
def stream_passthrough(spark, sf):
    base = new_path(spark, "stream-copy")
    write_stream(events_stream(spark, sf), f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out")


@query("stream_tumbling", f"""
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       event_type, {COUNTS_SQL}
FROM events GROUP BY ALL""")
def stream_tumbling(spark, sf):
    hourly = windowed_aggregate(
        events_stream(spark, sf), "ts", counts(), "1 hour", keys=["event_type"], watermark=_lateness(spark, sf))
    return _plain(_updates(spark, hourly, "stream-hourly", ["window_start", "window_end", "event_type"]))


@query("stream_sliding", f"""
WITH w AS (SELECT date_trunc('hour', ts) AS s, value FROM events
           UNION ALL SELECT date_trunc('hour', ts) - INTERVAL 1 HOUR, value FROM events)
SELECT s AS window_start, s + INTERVAL 2 HOUR AS window_end, {COUNTS_SQL} FROM w GROUP BY s""")
def stream_sliding(spark, sf):
    sliding = windowed_aggregate(
        events_stream(spark, sf), "ts", counts(), "2 hours", "1 hour", watermark=_lateness(spark, sf))
    return _plain(_updates(spark, sliding, "stream-sliding", ["window_start", "window_end"]))


@query("stream_session", f"""
WITH g AS (SELECT user_id, ts, value, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts)
                  + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
     s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n FROM g)
SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 6 HOUR AS window_end, {COUNTS_SQL}
FROM s GROUP BY user_id, n""")
def stream_session(spark, sf):
    sessions = session_aggregate(
        events_stream(spark, sf), "ts", counts(), "6 hours", ["user_id"], watermark=_lateness(spark, sf))
    return _complete(spark, sessions, "stream-session")


@query("stream_closed_sessions", f"""
WITH g AS (SELECT user_id, ts, value, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts)
                  + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
     s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n FROM g)
SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 6 HOUR AS window_end, {COUNTS_SQL}
FROM s GROUP BY user_id, n
HAVING ceil(epoch_us(max(ts) + INTERVAL 6 HOUR) / 1000)
       < (SELECT floor(epoch_us(max(ts) - INTERVAL 2 DAY) / 1000) FROM events)""")
def stream_closed_sessions(spark, sf):
    """Sessions over by the watermark, two days behind the newest event, each reported once by its timer."""
    base = new_path(spark, "stream-closed")
    closed = closed_sessions(events_stream(spark, sf), "user_id", "ts", "value", 6 * 3600, "2 days")
    write_sessions(closed, f"{base}/out", f"{base}/checkpoint")
    return _plain(latest_rows(spark, f"{base}/out", _as_read(closed.schema), ["user_id", "window_start"]))


@query("stream_late_drop", """
WITH w AS (SELECT date_trunc('hour', ts) AS window_start, event_type FROM events),
     m AS (SELECT max(ts) - INTERVAL 10 DAY AS mark FROM events WHERE event_type IS DISTINCT FROM 'error')
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS events
FROM w, m WHERE event_type IS DISTINCT FROM 'error' OR window_start + INTERVAL 1 HOUR > mark GROUP BY window_start""")
def stream_late_drop(spark, sf):
    """Error events arrive after all others; those behind the watermark are dropped."""
    base, events = new_path(spark, "stream-late"), table(spark, sf, "events")
    arrivals = f"{base}/arrivals"
    error = F.col("event_type").eqNullSafe("error")
    for wave in (~error, error):
        events.filter(wave).write.mode("append").parquet(arrivals)
        hourly = windowed_aggregate(
            stream_files(spark, arrivals, events.schema), "ts",
            [F.count(F.lit(1)).alias("events")], "1 hour", watermark="10 days")
        write_batches(hourly, f"{base}/out", f"{base}/checkpoint", "update", late="drop")
    return _plain(latest_rows(
        spark, f"{base}/out", _as_read(hourly.schema), ["window_start", "window_end"]))


@query("stream_state_running_total", """
SELECT user_id AS key, count(*) AS events,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM events GROUP BY user_id""")
def stream_state_running_total(spark, sf):
    busy = hot_keys(table(spark, sf, "events"), ["user_id"])
    totals = running_totals(events_stream(spark, sf), "user_id", "value", "event_id", busy,
                            time_column="ts", lateness=_lateness(spark, sf), idle_ms=IDLE_MS)
    parts = _updates(spark, totals, "stream-totals", ["key", "salt", "part"])
    return merge_totals(parts)


@query("stream_upsert", """
SELECT user_id, count(*) AS events, max(event_id) AS last_event FROM events GROUP BY user_id""")
def stream_upsert(spark, sf):
    """Current row per user, kept by idempotent micro-batch writes."""
    current = events_stream(spark, sf).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("events"), F.max("event_id").alias("last_event"))
    return _updates(spark, current, "stream-upsert", ["user_id"])
