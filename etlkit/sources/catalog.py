"""Catalog tables: external, bucketed, statistics, listing."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from etlkit.sources.tables import values_lookup
from etlkit.workspace import file_system, new_path

STATISTICS_SCHEMA = (
    "table_name string, column_name string, rows long, bytes long, "
    "distinct_count long, null_count long, min string, max string"
)


def register_external_table(
    spark: SparkSession, name: str, path: str, format: str = "parquet", partitioned: bool = False
) -> DataFrame:
    """Register files as a table. Partitions of a partitioned folder are discovered too.

    A name that is already registered for another location raises.
    """
    if spark.catalog.tableExists(name):
        known = json.loads(spark.sql(f"DESCRIBE EXTENDED {name} AS JSON").first()[0]).get("location", "")
        if _place(spark, known) != _place(spark, path):
            raise ValueError(f"table {name!r} is registered for {known!r}, not for {path!r}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {format} LOCATION '{path}'")
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def _place(spark: SparkSession, location: str) -> str:
    system, path = file_system(spark, location)
    return system.makeQualified(path).toString().rstrip("/")


def write_bucketed(
    df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None
) -> DataFrame:
    """Write a bucketed, sorted table and return it; without ``path`` it lasts for the run.

    Rows are first hash-partitioned into as many tasks as there are buckets, with
    the same hash, so that each task writes one bucket file. Tables joined on the
    same keys and bucket count need no shuffle. Salt hot keys first (see
    ``salt_sides``) and bucket by key and salt.
    """
    first, *rest = keys
    path = path or new_path(df.sparkSession, "bucketed")
    (df.repartition(buckets, *keys).write.format("parquet").option("path", path)
     .bucketBy(buckets, first, *rest).sortBy(first, *rest).saveAsTable(name))
    return df.sparkSession.table(name)


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def collect_stats(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """Analyze tables and return one row per column with the statistics the optimizer uses.

    Each table is scanned once. The result holds one row per column and is built
    on the driver.
    """
    rows = []
    for table in tables:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
        found = json.loads(spark.sql(f"DESCRIBE EXTENDED {table} AS JSON").first()[0])
        size = found.get("statistics", {})
        for column in spark.table(table).columns:
            facts = {r["info_name"]: r["info_value"] for r in
                     spark.sql(f"DESCRIBE EXTENDED {table} `{column}`").collect()}

            def fact(name, kind=str):
                value = facts.get(name)
                return None if value in (None, "NULL") else kind(value)

            rows.append((
                table, column, size.get("num_rows"), size.get("size_in_bytes"),
                fact("distinct_count", int), fact("num_nulls", int), fact("min"), fact("max"),
            ))
    return values_lookup(spark, rows, STATISTICS_SCHEMA)
