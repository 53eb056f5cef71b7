"""Tables kept in layers: base snapshots, deltas next to them, and markers that name what is in force.

A load writes its rows as a delta of its own number, and writing the same number again adds
another attempt, of which the newest complete one counts. Compaction folds deltas into new base
folders under a number never used before, then puts a marker that names the base folder of
every partition and the last delta in it. Nothing that a marker names is ever changed, so the
table reads the same after each step, and a run that dies between two steps leaves files that no
one reads until ``vacuum`` removes them.

Folders of a table::

    delta/batch_id=N/attempt=A/      rows of one load, with the operation column if there is one
    base/layer=N/[p=value/]          folded rows
    _markers/N                       {"base": {"p=value": layer, ...}, "upto": last folded batch}

Keys are unique within a load. A null in a key is a value like others. Partition values keep the
type the schema gives them; empty text is a null, as in all partition folders.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from etlkit.operators.layout import BALANCED_WRITE, TARGET_FILE_BYTES, balanced
from etlkit.operators.reuse import staged
from etlkit.session import options
from etlkit.workspace import file_system

BATCH, ATTEMPT, LAYER = "batch_id", "attempt", "layer"
_DONE = "_SUCCESS"
_MARKER_DIGITS = 12


class LayeredTable:
    """A table of ``schema`` at ``path`` with unique ``keys``.

    ``operation`` names a column of the loads that ``schema`` lacks; rows in which it equals
    ``delete`` remove their key. With ``partition_by`` compaction rewrites only the partitions that
    loads touch.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
        partition_by: str | None = None, operation: str | None = None, delete: str = "D",
    ):
        # Plain fields: what is read back never has stricter ones.
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.partition_by, self.operation, self.delete = partition_by, operation, delete

    # Names and markers.

    def _names(self, folder: str) -> list[str]:
        system, path = file_system(self.spark, f"{self.path}/{folder}")
        return [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []

    def _numbers(self, folder: str, name: str) -> list[int]:
        return sorted(int(n.partition("=")[2]) for n in self._names(folder) if n.startswith(f"{name}="))

    def _marker(self) -> tuple[int, dict]:
        """(number, content) of the newest marker; one that was not written to its end is passed over."""
        jvm = self.spark.sparkContext._jvm
        for name in sorted(self._names("_markers"), reverse=True):
            system, path = file_system(self.spark, f"{self.path}/_markers/{name}")
            stream = system.open(path)
            try:
                return int(name), json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            except json.JSONDecodeError:
                continue
            finally:
                stream.close()
        return -1, {"base": {}, "upto": -1}

    def _put_marker(self, content: dict) -> None:
        """Write the next marker; fails if another compaction has taken its number."""
        number = max((int(n) for n in self._names("_markers")), default=-1) + 1
        system, path = file_system(self.spark, f"{self.path}/_markers/{number:0{_MARKER_DIGITS}}")
        stream = system.create(path, False)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()

    def _complete(self, batch: int) -> list[int]:
        folder = f"delta/{BATCH}={batch}"
        return [a for a in self._numbers(folder, ATTEMPT) if _DONE in self._names(f"{folder}/{ATTEMPT}={a}")]

    def _deltas(self, upto: int) -> dict[int, int]:
        """Newest complete attempt of each batch after ``upto``."""
        found = {b: self._complete(b) for b in self._numbers("delta", BATCH) if b > upto}
        return {b: attempts[-1] for b, attempts in found.items() if attempts}

    def batches(self) -> list[int]:
        """Loads that are complete and not folded yet."""
        return sorted(self._deltas(self._marker()[1]["upto"]))

    # Reading.

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def _base(self, parts: dict[str, int]) -> DataFrame:
        if not parts:
            return self._empty()
        paths = [f"{self.path}/base/{LAYER}={n}" + (f"/{part}" if part else "") for part, n in sorted(parts.items())]
        full = T.StructType([*self.schema.fields, T.StructField(LAYER, T.LongType())])
        read = self.spark.read.schema(full).option("basePath", f"{self.path}/base").parquet(*paths)
        return read.select(*self.schema.names)

    def _delta_schema(self) -> T.StructType:
        return self.schema if not self.operation else T.StructType(
            [*self.schema.fields, T.StructField(self.operation, T.StringType())])

    def _latest(self, deltas: dict[int, int]) -> DataFrame:
        """The last row of each key in ``deltas``; combined before the shuffle."""
        paths = [f"{self.path}/delta/{BATCH}={b}/{ATTEMPT}={a}" for b, a in sorted(deltas.items())]
        own = self._delta_schema()
        full = T.StructType([*own.fields, *(T.StructField(c, T.LongType()) for c in (BATCH, ATTEMPT))])
        log = self.spark.read.schema(full).option("basePath", f"{self.path}/delta").parquet(*paths)
        rest = [c for c in own.names if c not in self.keys]
        return log.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), BATCH).alias("__row")).select(
            *self.keys, "__row.*").select(*own.names)

    def _folded(self, base: DataFrame, latest: DataFrame) -> DataFrame:
        """``base`` without the keys of ``latest``, and the rows of ``latest`` that stay."""
        changed = latest.select(*[F.col(k).alias(f"__{k}") for k in self.keys])
        same = [base[k].eqNullSafe(changed[f"__{k}"]) for k in self.keys]
        if self.operation:
            latest = latest.filter(~F.col(self.operation).eqNullSafe(F.lit(self.delete)))
        return base.join(changed, same, "left_anti").unionByName(latest.select(*self.schema.names))

    def read(self) -> DataFrame:
        """The current rows. Only the loads that are not folded yet are aggregated; the base is
        joined to their keys and stays where it is if these are few."""
        _, marker = self._marker()
        deltas = self._deltas(marker["upto"])
        base = self._base(marker["base"])
        return self._folded(base, self._latest(deltas)) if deltas else base

    # Writing.

    def write_delta(self, rows: DataFrame, batch_id: int, order_by: Sequence[str] = ()) -> None:
        """Write one load under its number. Repeating it replaces it, whatever became of the first.

        With ``order_by`` only the last row of each key is taken. A load that is folded already
        is left as it is.
        """
        if batch_id <= self._marker()[1]["upto"]:
            return
        names = self._delta_schema().names
        if order_by:
            rest = [c for c in names if c not in self.keys]
            last = F.max_by(F.struct(*rest), F.struct(*order_by)).alias("__row")
            rows = rows.groupBy(*self.keys).agg(last).select(*self.keys, "__row.*")
        if self.partition_by and isinstance(self.schema[self.partition_by].dataType, T.StringType):
            rows = rows.withColumn(self.partition_by, F.nullif(F.col(self.partition_by), F.lit("")))
        folder = f"delta/{BATCH}={batch_id}"
        attempt = max(self._numbers(folder, ATTEMPT), default=-1) + 1
        rows.select(*names).write.parquet(f"{self.path}/{folder}/{ATTEMPT}={attempt}")

    def merge(self, changes: DataFrame, order_by: Sequence[str] = ()) -> None:
        """Apply ``changes`` as the next load and fold it."""
        batch = max([*self._numbers("delta", BATCH), self._marker()[1]["upto"]]) + 1
        self.write_delta(changes, batch, order_by)
        self.compact(newest=True)

    def _new_layer(self) -> int:
        return max([*self._numbers("base", LAYER), *self._marker()[1]["base"].values()], default=-1) + 1

    def _write_layer(self, rows: DataFrame, layer: int, files: int | None = None) -> dict[str, int]:
        """Write a base folder; the partitions it holds."""
        folder = f"base/{LAYER}={layer}"
        if files:
            rows = rows.coalesce(files)
        elif self.partition_by:
            rows = balanced(rows, [self.partition_by])
        with options(self.spark, {} if files or not self.partition_by else BALANCED_WRITE):
            writer = rows.write
            (writer.partitionBy(self.partition_by) if self.partition_by else writer).parquet(f"{self.path}/{folder}")
        if not self.partition_by:
            return {"": layer}
        return {n: layer for n in self._names(folder) if n.startswith(f"{self.partition_by}=")}

    def _folders(self, parts: dict[str, int], values: DataFrame, value: str) -> list[str]:
        """Names of the partition folders that hold ``values``; no column of the files is read."""
        if not parts:
            return []
        base = self._base(parts)
        place = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]+$", 1)
        held = base.select(self.partition_by, place.alias("__place")).distinct()
        found = held.join(values, F.col(self.partition_by).eqNullSafe(F.col(value)), "left_semi")
        uris = [r["__place"] for r in found.select("__place").distinct().collect()]  # a row per folder
        return [file_system(self.spark, uri, encoded=True)[1].getName() for uri in uris]

    def compact(self, newest: bool = False) -> None:
        """Fold loads into the base; of a table with partitions, only into those they touch.

        The newest load stays a delta unless ``newest``, since a stream may write it again. Touched
        are the partitions that changed rows go to and those that hold changed keys, so a key may
        move. Runs a few jobs; the table reads the same after each.
        """
        _, marker = self._marker()
        deltas = self._deltas(marker["upto"])
        if not newest and deltas:
            del deltas[max(deltas)]
        if not deltas:
            return
        latest = staged(self._latest(deltas), "latest")
        base, layer = self._base(marker["base"]), self._new_layer()
        if not self.partition_by:
            parts = self._write_layer(self._folded(base, latest), layer)
        else:
            same = [base[k].eqNullSafe(latest[k]) for k in self.keys]
            held = base.join(latest, same, "left_semi").select(F.col(self.partition_by).alias("__touched"))
            touched = staged(held.union(latest.select(self.partition_by)).distinct(), "touched")
            folders = self._folders(marker["base"], touched, "__touched")
            within = self._base({f: marker["base"][f] for f in folders})
            written = self._write_layer(self._folded(within, latest), layer)
            parts = {f: n for f, n in marker["base"].items() if f not in folders} | written
        self._put_marker({"base": parts, "upto": max(deltas)})

    def rewrite_partition(self, value: Any = None, target_bytes: int = TARGET_FILE_BYTES) -> None:
        """Put the files of one partition, or of a table without partitions, into files near
        ``target_bytes``, in a new layer; the others stay."""
        _, marker = self._marker()
        part = ""
        if self.partition_by:
            kind = self.schema[self.partition_by].dataType
            wanted = self.spark.range(1).select(F.lit(value).cast(kind).alias("__value"))
            part = next(iter(self._folders(marker["base"], wanted, "__value")), None)
        if part not in marker["base"]:
            return
        rows = self._base({part: marker["base"][part]})
        system, folder = file_system(self.spark, f"{self.path}/base/{LAYER}={marker['base'][part]}/{part}".rstrip("/"))
        files = max(1, math.ceil(system.getContentSummary(folder).getLength() / target_bytes))
        written = self._write_layer(rows, self._new_layer(), files)
        self._put_marker({"base": marker["base"] | written, "upto": marker["upto"]})

    def vacuum(self) -> None:
        """Remove what the newest marker does not name: one call per folder.

        Queries that were planned on an older marker must have ended. Base folders with a number
        above all that are named may belong to a compaction that runs, and stay.
        """
        number, marker = self._marker()
        if number < 0:
            return

        def remove(name: str) -> None:
            system, path = file_system(self.spark, f"{self.path}/{name}")
            system.delete(path, True)

        last = max(marker["base"].values(), default=-1)
        for layer in self._numbers("base", LAYER):
            if layer > last:
                continue
            if layer not in marker["base"].values():
                remove(f"base/{LAYER}={layer}")
            elif self.partition_by:
                for part in self._names(f"base/{LAYER}={layer}"):
                    if part.startswith(f"{self.partition_by}=") and marker["base"].get(part) != layer:
                        remove(f"base/{LAYER}={layer}/{part}")
        for batch in self._numbers("delta", BATCH):
            if batch <= marker["upto"]:
                remove(f"delta/{BATCH}={batch}")
                continue
            for attempt in self._complete(batch)[:-1]:
                remove(f"delta/{BATCH}={batch}/{ATTEMPT}={attempt}")
        for name in self._names("_markers"):
            if int(name) < number:
                remove(f"_markers/{name}")
