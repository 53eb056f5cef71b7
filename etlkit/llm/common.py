"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, functions as F

from etlkit.operators.reuse import staged
from etlkit.session import options

# Words are runs of anything but ASCII white space; bytes.split() cuts at the same six bytes.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
# Text taken into Python lists at once, so that a batch of very long texts stays small.
SLICE_BYTES = 2 << 20


def word_count(text: str) -> Column:
    """Number of words of a string column; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the given names: other columns of any name stay out."""
    return df.select(*[df[f"`{old}`"].alias(new) for new, old in columns.items()])


# Rows handed to Python at once where they are whole documents.
FEW_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder, with few rows at a time on their way through Python."""
    with options(df.sparkSession, FEW_ROWS):
        return staged(df, label)


def text_bytes(column: pa.Array) -> np.ndarray:
    """Bytes of each text of a column; 0 for null."""
    return pa.compute.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)


def cut(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose sizes make about ``most`` each, one row at least."""
    start, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about SLICE_BYTES of ``column``, one row at least."""
    for batch in batches:
        yield from cut(batch, text_bytes(batch[column]), SLICE_BYTES)


def text_slices(texts) -> Iterator[list[str]]:
    """A series of texts as lists of about SLICE_BYTES characters; null becomes empty."""
    part, held = [], 0
    for text in texts.tolist():
        text = text or ""
        part.append(text)
        held += len(text)
        if held > SLICE_BYTES:
            yield part
            part, held = [], 0
    if part:
        yield part
