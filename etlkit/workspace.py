"""Where intermediate and run-scoped data is written.

On a cluster the folder is the one named by ``spark.checkpoint.dir``; it must be
reachable by every executor. A machine-local folder is used only in local mode
and only when that setting is absent, as in tests.
"""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}
_run_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder that all executors can read and write."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="etlkit-")
        system, path = file_system(spark, _local_roots[app])
        system.deleteOnExit(path)
    return _local_roots[app]


def file_system(spark: SparkSession, location: str, encoded: bool = False):
    """(file system, path) of a location, through Spark's own Hadoop configuration.

    ``encoded`` locations are URIs, as in the ``_metadata`` column.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(location) if encoded else location)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def run_root(spark: SparkSession) -> str:
    """This application's folder under the shared one; removed when the application ends."""
    app = spark.sparkContext.applicationId
    if app not in _run_roots:
        root = f"{shared_root(spark)}/etlkit/{app}"
        system, path = file_system(spark, root)
        system.mkdirs(path)
        system.deleteOnExit(path)
        _run_roots[app] = root
    return _run_roots[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the application's folder; never returns the same path twice."""
    return f"{run_root(spark)}/{label}-{uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point ``DataFrame.checkpoint`` at the application's folder if nothing has yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{run_root(spark)}/checkpoints")
