"""Session construction."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

from etlkit.settings import SparkSettings

logger = logging.getLogger(__name__)

# Defaults that suit both a laptop and a large cluster. Executor count, memory
# and shuffle partitions belong to the deployment and come from settings.
DEFAULTS = {
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs one more shuffle after it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app_name: str | None = None,
    overrides: Mapping[str, str] | None = None,
    settings: SparkSettings | None = None,
) -> SparkSession:
    """Get or create a session; ``overrides`` win over settings and defaults.

    On a running session the given settings and overrides are applied as far as they can
    change, so a second call is never silently ignored. A static option that would need a
    restart raises; another application name is logged, since the name stays.
    """
    given = {**(settings.as_conf() if settings else {}), **(overrides or {})}
    settings = settings or SparkSettings.from_env()
    wanted = {**DEFAULTS, **settings.as_conf(), **(overrides or {})}
    if app_name:
        wanted["spark.app.name"] = app_name
    active = SparkSession.getActiveSession()
    if active is not None:
        if app_name and app_name != active.sparkContext.appName:
            logger.warning("the running session keeps its name %r", active.sparkContext.appName)
        for key, value in given.items():
            if str(active.conf.get(key, None)) == str(value):
                continue
            if not active.conf.isModifiable(key):
                raise ValueError(f"{key} cannot change while the session runs; stop it first")
            active.conf.set(key, value)
        return active
    builder = SparkSession.builder
    for key, value in wanted.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stop_session() -> None:
    """Stop the active session, if there is one."""
    active = SparkSession.getActiveSession()
    if active is not None:
        active.stop()


def restart_session(
    app_name: str | None = None, overrides: Mapping[str, str] | None = None
) -> SparkSession:
    """Stop the active session and build a new one."""
    stop_session()
    return build_session(app_name, overrides)


@contextmanager
def options(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """SQL options for the jobs and streams started in the block, restored after it."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
