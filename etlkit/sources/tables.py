"""Tables by name: read, write, query and describe."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from etlkit.operators.layout import BALANCED_WRITE, balanced, range_layout
from etlkit.operators.reuse import measured, observed
from etlkit.session import options as session_options
from etlkit.settings import WarehouseSettings

FILE_FORMATS = ("parquet", "orc", "json", "csv")
MODES = ("overwrite", "append", "error", "ignore")


def resolve_table_id(table_id: str, project: str = "", dataset: str = "") -> str:
    """Complete ``table`` to project.dataset.table and ``dataset.table`` to project.dataset.table.

    Ids with two or more dots are taken as they are; empty defaults are left out.
    """
    dots = table_id.count(".")
    prefix = {0: [project, dataset], 1: [project]}.get(dots, [])
    return ".".join([*filter(None, prefix), table_id])


class TableStore:
    """Tables of one format.

    ``table``: catalog tables. File formats (parquet, orc, json, csv): folders
    under ``base_path``, one level per part of the table id; an id that ends in the
    format's name (``orders.parquet``) is a file name. Anything else is the
    name of an installed connector that takes the options ``table``, ``query``,
    ``parentProject``, ``partitionField`` and ``clusteredFields``.
    """

    def __init__(self, spark: SparkSession, settings: WarehouseSettings | None = None):
        self.spark = spark
        self.settings = settings or WarehouseSettings.from_env()
        self.format = self.settings.format
        self.by_path = self.format in FILE_FORMATS
        if self.by_path and not self.settings.base_path:
            raise ValueError(f"format {self.format!r} needs base_path")

    def resolve(self, table_id: str) -> str:
        return resolve_table_id(table_id, self.settings.project, self.settings.dataset)

    def path(self, table_id: str) -> str:
        base = self.settings.base_path.rstrip("/")
        if table_id.endswith(f".{self.format}"):
            return f"{base}/{table_id}"
        return "/".join([base, *self.resolve(table_id).split(".")])

    def _connector_options(self, **named: Any) -> dict[str, Any]:
        found = {
            "parentProject": self.settings.parent_project or self.settings.project,
            "temporaryGcsBucket": self.settings.temp_bucket,
            **named,
        }
        return {key: value for key, value in found.items() if value not in (None, "")}

    def read_table(
        self,
        table_id: str,
        columns: Sequence[str] | None = None,
        filter_condition: str | None = None,
        schema: Any = None,
        **options: Any,
    ) -> DataFrame:
        """Read a table; the filter may use columns that ``columns`` leaves out."""
        if self.format == "table":
            df = self.spark.read.options(**options).table(self.resolve(table_id))
        else:
            reader = self.spark.read.format(self.format)
            if schema is not None:
                reader = reader.schema(schema)
            if self.by_path:
                df = reader.options(**options).load(self.path(table_id))
            else:
                named = self._connector_options(table=self.resolve(table_id))
                df = reader.options(**{**named, **options}).load()
        if filter_condition:
            df = df.filter(filter_condition)
        return df.select(*columns) if columns else df

    def execute_query(
        self,
        query: str,
        args: Mapping[str, Any] | None = None,
        views: Mapping[str, DataFrame] | None = None,
        **options: Any,
    ) -> DataFrame:
        """Run SQL text. A connector runs it remotely; otherwise Spark does.

        ``args`` bind ``:name`` markers and ``views`` bind ``{name}`` to frames.
        """
        if self.format == "table" or self.by_path:
            return self.spark.sql(query, args=dict(args or {}), **(views or {}))
        # A connector keeps the result of a remote query in a table of its own.
        named = self._connector_options(
            query=query, viewsEnabled="true", materializationDataset=self.settings.dataset,
            materializationProject=self.settings.parent_project or self.settings.project)
        return self.spark.read.format(self.format).options(**{**named, **options}).load()

    def write_table(
        self,
        df: DataFrame,
        table_id: str,
        mode: str = "overwrite",
        partition_by: str | None = None,
        cluster_by: Sequence[str] | None = None,
        **options: Any,
    ) -> dict[str, Any]:
        """Write a table and return ``{"table", "mode", "rows"}`` measured by the write itself.

        ``partition_by`` makes one partition per day of that column, in a column
        ``<name>_partition_day``. ``cluster_by`` sorts rows so that files cover narrow ranges.
        A busy day is split over several files.
        """
        if mode not in MODES:
            raise ValueError(f"unknown write mode {mode!r}, expected one of {MODES}")
        target = self.resolve(table_id)
        if mode == "ignore" and self.format == "table" and self.spark.catalog.tableExists(target):
            return {"table": target, "mode": mode, "rows": 0}
        if not (self.by_path or self.format == "table"):
            out = df
            options = {**self._connector_options(
                table=target,
                partitionField=partition_by,
                partitionType="DAY" if partition_by else None,
                clusteredFields=",".join(cluster_by or ()),
            ), **options}
        else:
            out = daily_layout(df, partition_by, cluster_by)
        counted, rows = observed(out, f"write {target}")
        writer = counted.write.format("parquet" if self.format == "table" else self.format)
        writer = writer.mode(mode).options(**options)
        if partition_by and (self.by_path or self.format == "table"):
            writer = writer.partitionBy(day_column(partition_by))
        with session_options(self.spark, BALANCED_WRITE if partition_by else {}):
            if self.format == "table":
                writer.saveAsTable(target)
            elif self.by_path:
                writer.save(self.path(table_id))
            else:
                writer.save()
        return {"table": target, "mode": mode, "rows": measured(rows).get("rows", 0)}

    def get_table_schema(self, table_id: str) -> DataFrame:
        """One row per column: table, rows, bytes, times, column name, type, mode, description.

        Facts a format does not keep are null. For files the size and the newest
        modification time come from the file listing.
        """
        df = self.read_table(table_id)
        facts: dict[str, Any] = {}
        if self.by_path:
            found = listed_files(self.spark, self.path(table_id)).agg(
                F.sum("length").alias("bytes"), F.max("modificationTime").alias("modified")).first()
            facts = {"bytes": found["bytes"], "modified": str(found["modified"])}
        if self.format == "table":
            text = self.spark.sql(
                f"DESCRIBE EXTENDED {self.resolve(table_id)} AS JSON").first()[0]
            found = json.loads(text)
            facts = {"created": found.get("created_time"), "bytes": found.get("statistics", {}).get("size_in_bytes")}
        return describe_columns(df, self.resolve(table_id), facts)


def describe_columns(
    df: DataFrame, table: str, facts: Mapping[str, Any] | None = None
) -> DataFrame:
    """One row per column of ``df`` with the table's row count; one count, no data columns read."""
    facts = facts or {}
    described = F.array(*[
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit("NULLABLE" if f.nullable else "REQUIRED").alias("mode"),
            F.lit(f.metadata.get("comment", "")).alias("description"),
        )
        for i, f in enumerate(df.schema.fields)
    ])
    table_facts = df.agg(F.count(F.lit(1)).alias("num_rows")).select(
        F.lit(table).alias("table_id"), "num_rows",
        F.lit(facts.get("bytes")).cast("long").alias("num_bytes"),
        F.lit(facts.get("created")).cast("string").alias("created"),
        F.lit(facts.get("modified")).cast("string").alias("modified"),
        F.lit("").alias("_"),
    )
    return table_facts.select("*", F.inline(described)).drop("_")


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, modificationTime, length`` of the files under ``path``; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select("path", "modificationTime", "length"))


def day_column(partition_by: str) -> str:
    return f"{partition_by}_partition_day"


def daily_layout(
    df: DataFrame, partition_by: str | None, cluster_by: Sequence[str] | None
) -> DataFrame:
    """Rows laid out for a write by day of ``partition_by`` and sorted by ``cluster_by``."""
    day = []
    if partition_by:
        day = [day_column(partition_by)]
        df = df.withColumn(day[0], F.to_date(partition_by))
    if cluster_by:
        return range_layout(df, [*day, *cluster_by])
    return balanced(df, day) if day else df


def read_path(spark: SparkSession, path: str, format: str = "parquet", schema: Any = None,
              **options: Any) -> DataFrame:
    """Read files; a schema avoids the inference pass over text formats."""
    reader = spark.read.format(format).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def write_path(df: DataFrame, path: str, format: str = "parquet", mode: str = "overwrite",
               partition_by: Sequence[str] = (), **options: Any) -> dict[str, Any]:
    """Write files and return the rows written, counted by the write itself.

    Partitioned output is balanced first, so a task does not open every partition
    and no partition value fills a single task.
    """
    out = balanced(df, partition_by) if partition_by else df
    counted, rows = observed(out, f"write {path}")
    writer = counted.write.format(format).mode(mode).options(**options)
    with session_options(df.sparkSession, BALANCED_WRITE if partition_by else {}):
        (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
    return {"path": path, "mode": mode, "rows": measured(rows).get("rows", 0)}


def range_rows(spark: SparkSession, rows: int, **columns) -> DataFrame:
    """Generated rows ``id`` = 0..rows-1 with derived columns."""
    return spark.range(rows).withColumns(columns) if columns else spark.range(rows)


def values_lookup(spark: SparkSession, rows: Sequence[Sequence[Any]], schema: str) -> DataFrame:
    """A small inline table as SQL ``VALUES``; its size is fixed by the caller's code.

    ``schema`` is like ``"band_id int, low double"``.
    """
    fields = T.StructType.fromDDL(schema).fields
    args = {f"v{i}_{j}": value for i, row in enumerate(rows) for j, value in enumerate(row)}
    listed = ", ".join(
        "(" + ", ".join(f":v{i}_{j}" for j in range(len(fields))) + ")" for i in range(len(rows)))
    names = ", ".join(f.name for f in fields)
    values = spark.sql(f"SELECT * FROM VALUES {listed} AS t({names})", args=args)
    return values.select(*[F.col(f.name).cast(f.dataType) for f in fields])
