"""File streams: sources, runs and sinks that can be replayed."""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from etlkit.session import options
from etlkit.sources.layered import BATCH, LayeredTable

# Seconds that the reports of an ended run may still take to arrive.
REPORT_SECONDS = 120
FILES_PER_BATCH = 1000


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet", **settings: Any
) -> DataFrame:
    """Stream of the files under ``path``, which may also name a single file.

    A micro-batch takes ``FILES_PER_BATCH`` files, or what ``maxFilesPerTrigger`` or
    ``maxBytesPerTrigger`` say.
    """
    if "maxBytesPerTrigger" not in settings:
        settings = {"maxFilesPerTrigger": FILES_PER_BATCH, **settings}
    # A one-letter glob makes Spark list the path instead of requiring a folder.
    trimmed = path.rstrip("/")
    listed = f"{trimmed[:-1]}[{trimmed[-1]}]"
    return spark.readStream.format(format).schema(schema).options(**settings).load(listed)


def with_event_time(df: DataFrame, column: str) -> DataFrame:
    """Give ``column`` the type that watermarks accept."""
    if isinstance(df.schema[column].dataType, T.TimestampType):
        return df
    return df.withColumn(column, F.col(column).cast("timestamp"))


# A busy key's events merge to sessions in each task before they are shuffled.
LOCAL_SESSION_MERGE = {
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def _trigger(writer, trigger: dict[str, Any] | None):
    return writer.trigger(**(trigger or {"availableNow": True}))


def _finish(query: StreamingQuery, trigger: dict[str, Any] | None) -> StreamingQuery:
    if not trigger or "availableNow" in trigger:
        query.awaitTermination()
    return query


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    format: str = "parquet",
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Append a stream to files, each row once even across restarts.

    ``trigger`` is ``{"processingTime": "1 minute"}`` or, by default,
    ``{"availableNow": True}``, which processes what is there and returns.
    """
    writer = df.writeStream.format(format).outputMode("append").option(
        "checkpointLocation", checkpoint)
    return _finish(_trigger(writer, trigger).start(path), trigger)


def write_batches(
    df: DataFrame,
    path: str,
    checkpoint: str,
    output_mode: str = "update",
    trigger: dict[str, Any] | None = None,
    late: str = "fail",
) -> StreamingQuery:
    """Write each micro-batch under its own number, so that a replay replaces it: in ``update``
    mode as the loads of a ``LayeredTable``, which ``latest_rows`` reads.

    In ``complete`` mode each batch holds the whole result, so it replaces everything.
    A run that ends having dropped rows behind its watermark raises, unless ``late`` is ``drop``.
    Dropped rows are counted from every batch's report as it comes.
    """
    spark = df.sparkSession

    def save(batch: DataFrame, batch_id: int) -> None:
        if output_mode == "complete":
            batch.withColumn(BATCH, F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(path)
        else:
            LayeredTable(batch.sparkSession, path, batch.schema, ()).write_delta(batch, batch_id)

    reports = DroppedRows()
    spark.streams.addListener(reports)
    try:
        query = for_each_batch(df, save, checkpoint, output_mode, trigger)
        if late == "fail" and not query.isActive and (lost := reports.of(query)):
            raise ValueError(f"{lost} rows or partial aggregates came later than the watermark allows")
    finally:
        spark.streams.removeListener(reports)
    return query


class DroppedRows(StreamingQueryListener):
    """Rows dropped behind watermarks, summed per run over the reports of all its batches.

    Spark itself keeps only the last reports. An aggregation that combines before its shuffle
    drops, and counts, what it has combined.
    """

    def __init__(self):
        self._dropped: dict[str, int] = {}
        self._ended: dict[str, threading.Event] = {}

    def _end(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        run, states = str(event.progress.runId), event.progress.stateOperators
        self._dropped[run] = self._dropped.get(run, 0) + sum(s.numRowsDroppedByWatermark for s in states)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def of(self, query: StreamingQuery) -> int:
        """The count of an ended run; its end is the last thing reported."""
        run = str(query.runId)
        if not self._end(run).wait(REPORT_SECONDS):
            raise TimeoutError(f"the reports of run {run} did not come to their end")
        return self._dropped.get(run, 0)


def for_each_batch(
    df: DataFrame,
    save: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "update",
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Hand each micro-batch to ``save(batch, batch_id)``, which must be safe to repeat."""
    writer = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    with options(df.sparkSession, LOCAL_SESSION_MERGE):
        query = _trigger(writer.foreachBatch(save), trigger).start()
    return _finish(query, trigger)


def compact_updates(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> None:
    """Fold all but the newest batch of such a table, which a restarted stream may write again,
    and remove what is no longer read. The table reads the same after every step."""
    log = LayeredTable(spark, path, schema, keys)
    log.compact()
    log.vacuum()


def latest_rows(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """Current row per key of a table written by ``write_batches`` in update mode."""
    return LayeredTable(spark, path, schema, keys).read()
