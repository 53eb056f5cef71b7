"""Extract, transform and load one table."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, types as T

from etlkit.operators.columns import (
    add_audit_columns, create_date_dimensions, standardize_column_names,
)
from etlkit.operators.quality import quality_report, validate_required_columns
from etlkit.operators.reuse import measured, observed
from etlkit.sources.tables import TableStore

logger = logging.getLogger(__name__)

Step = Callable[[DataFrame], DataFrame]
DATE_WORDS = ("date", "timestamp")
DATED_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)


def first_date_dimensions(df: DataFrame) -> DataFrame:
    """Date dimensions of the first column named like a date; skipped if it cannot be one."""
    named = [f for f in df.schema.fields if any(w in f.name.lower() for w in DATE_WORDS)]
    if not named:
        return df
    if not isinstance(named[0].dataType, DATED_TYPES):
        logger.warning("no date dimensions: %s is %s", named[0].name,
                       named[0].dataType.simpleString())
        return df
    return create_date_dimensions(df, named[0].name)


def standard_steps(load_timestamp: str | None = None) -> list[Step]:
    return [
        standardize_column_names,
        lambda df: add_audit_columns(df, load_timestamp),
        first_date_dimensions,
    ]


class EtlJob:
    """Read a table, check and transform it, write it to another table."""

    def __init__(
        self,
        store: TableStore,
        required_columns: Sequence[str] = ("id",),
        load_timestamp: str | None = None,
        extra_steps: Sequence[Step] = (),
        quality: str = "approximate",
    ):
        if quality not in ("exact", "approximate", "none"):
            raise ValueError(f"unknown quality mode {quality!r}")
        self.store = store
        self.required_columns = list(required_columns)
        self.steps = [*standard_steps(load_timestamp), *extra_steps]
        self.quality = quality

    def extract_data(self, source_table: str, filter_condition: str | None = None) -> DataFrame:
        return self.store.read_table(source_table, filter_condition=filter_condition)

    def transform_data(self, df: DataFrame) -> DataFrame:
        """Required columns, then every step in order; stays lazy."""
        validate_required_columns(df, self.required_columns)
        for step in self.steps:
            df = df.transform(step)
        return df

    def load_data(self, df: DataFrame, target_table: str, mode: str = "overwrite",
                  partition_by: str | None = None) -> dict[str, Any]:
        return self.store.write_table(df, target_table, mode=mode, partition_by=partition_by)

    def run(
        self,
        source_table: str,
        target_table: str,
        filter_condition: str | None = None,
        mode: str = "overwrite",
        partition_by: str | None = None,
    ) -> dict[str, Any]:
        """Run all steps; returns rows read and written and the quality report.

        Rows are counted by the write itself. Errors are logged and raised again.
        """
        try:
            raw = self.extract_data(source_table, filter_condition)
            validate_required_columns(raw, self.required_columns)
            report = None
            if self.quality != "none":
                report = quality_report(raw, approximate=self.quality == "approximate")
            counted, read = observed(raw, f"read {source_table}")
            written = self.load_data(self.transform_data(counted), target_table, mode, partition_by)
            result = {"rows_in": measured(read).get("rows", 0), "rows_out": written["rows"],
                      "table": written["table"], "quality": report}
            logger.info("loaded %s: %s rows in, %s rows out", result["table"],
                        result["rows_in"], result["rows_out"])
            return result
        except Exception:
            logger.exception("load of %s from %s failed", target_table, source_table)
            raise
