"""Reuse of computed frames and lineage cuts."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from etlkit.workspace import ensure_checkpoint_dir, new_path

STORAGE_LEVELS = {
    "MEMORY_ONLY": StorageLevel.MEMORY_ONLY,
    "MEMORY_ONLY_2": StorageLevel.MEMORY_ONLY_2,
    "MEMORY_AND_DISK": StorageLevel.MEMORY_AND_DISK,
    "MEMORY_AND_DISK_2": StorageLevel.MEMORY_AND_DISK_2,
    "MEMORY_AND_DISK_DESER": StorageLevel.MEMORY_AND_DISK_DESER,
    "DISK_ONLY": StorageLevel.DISK_ONLY,
    "DISK_ONLY_2": StorageLevel.DISK_ONLY_2,
    "OFF_HEAP": StorageLevel.OFF_HEAP,
}


def storage_level(level: str | StorageLevel) -> StorageLevel:
    if isinstance(level, StorageLevel):
        return level
    if level not in STORAGE_LEVELS:
        raise ValueError(f"unknown storage level {level!r}, expected one of {list(STORAGE_LEVELS)}")
    return STORAGE_LEVELS[level]


@contextmanager
def persisted(
    df: DataFrame, level: str | StorageLevel = "MEMORY_AND_DISK_DESER", blocking: bool = False
) -> Iterator[DataFrame]:
    """Keep ``df`` while the block runs; select the needed columns and rows first."""
    kept = df.persist(storage_level(level))
    try:
        yield kept
    finally:
        kept.unpersist(blocking)


def is_cached(df: DataFrame) -> bool:
    """Whether ``df`` itself is marked for caching; frames derived from it are not."""
    level = df.storageLevel
    return level.useMemory or level.useDisk or level.useOffHeap


def staged(df: DataFrame, label: str = "staged") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: survives lost executors."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let shuffle files go whose frames are not used any more: Spark deletes them when the driver
    collects its garbage, which it may not do until the disk is full of them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def iterate(
    df: DataFrame,
    step: Callable[[DataFrame, int], DataFrame],
    rounds: int,
    checkpoint_every: int = 2,
) -> DataFrame:
    """Apply ``step(df, round)`` repeatedly, cutting the lineage every few rounds.

    The cut is a reliable checkpoint in the shared folder; the plan that follows
    starts from its files instead of replaying earlier rounds.
    """
    ensure_checkpoint_dir(df.sparkSession)
    for i in range(1, rounds + 1):
        df = step(df, i)
        if i % checkpoint_every == 0 and i < rounds:
            df = df.checkpoint(eager=True)
    return df


def observed(df: DataFrame, name: str, *metrics) -> tuple[DataFrame, Observation]:
    """Measure ``df`` while its next action runs; counts rows unless metrics are given.

    ``measured(observation)`` gives the values after that action, without a second pass.
    """
    observation = Observation(name)
    return df.observe(observation, *(metrics or [F.count(F.lit(1)).alias("rows")])), observation


def measured(observation: Observation) -> dict:
    """The observed values after the action; empty if the optimizer removed the
    observed part of the plan because no row could pass it. Other errors are raised."""
    try:
        return observation.get
    except Py4JJavaError as error:
        # Spark asserts that the row of metrics has fields; a removed observation left none.
        if error.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return {}


def preview(df: DataFrame, rows: int = 20) -> list:
    """The first ``rows`` rows on the driver."""
    return df.limit(rows).collect()
