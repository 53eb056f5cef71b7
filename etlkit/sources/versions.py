"""Tables whose schema changes: a stored list of versions and a rule for every change.

Each version names its columns, and each column has a number that it keeps when it is renamed and
that is never given again, so a name used anew is a new column. Files are read with the schema of
the version they were written in, taken from the list and not from their footers, and brought to
the version asked for by column number.

    added      older files give the column's default, or null
    widened    older files are cast to a type that holds every value of theirs
    renamed    read under the new name
    dropped    no longer read; the files keep it
    otherwise  ``IncompatibleSchema``, before any row is read or written

Nested types may not change. Folders of a table::

    _versions/N                   {"columns": [{"id", "name", "type", "default"}, ...], "next": id}
    data/version=N/load=name/     rows of one load; without _SUCCESS it is not read
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce
from typing import Any
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from etlkit.workspace import file_system

_VERSION_DIGITS = 6
# Decimal digits that hold every value of a whole-number type, narrowest first.
_WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
# Whole-number types whose every value a binary floating point type holds exactly.
_EXACT = {T.FloatType(): (T.ByteType(), T.ShortType()),
          T.DoubleType(): (T.ByteType(), T.ShortType(), T.IntegerType(), T.FloatType())}


class IncompatibleSchema(ValueError):
    """A change of schema, or a reading of it, that could lose values."""


def plain(kind: T.DataType) -> T.DataType:
    """The type without the nullability inside it, as files give it back."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(plain(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(plain(kind.keyType), plain(kind.valueType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, plain(f.dataType)) for f in kind.fields])
    return kind


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of ``old`` is a value of ``new``."""
    if old == new:
        return True
    if old in _WHOLE and new in _WHOLE:
        return _WHOLE[old] < _WHOLE[new]
    if isinstance(new, T.DecimalType):
        if old in _WHOLE:
            return new.precision - new.scale >= _WHOLE[old]
        return (isinstance(old, T.DecimalType) and new.scale >= old.scale
                and new.precision - new.scale >= old.precision - old.scale)
    return old in _EXACT.get(new, ())


class VersionedTable:
    """A table at ``path`` that remembers the schema each load was written in."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # Versions.

    def _names(self, folder: str) -> list[str]:
        system, path = file_system(self.spark, f"{self.path}/{folder}")
        return [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []

    def _versions(self) -> dict[int, dict]:
        jvm, found = self.spark.sparkContext._jvm, {}
        for name in sorted(self._names("_versions")):
            if not name.isdigit():
                continue
            system, path = file_system(self.spark, f"{self.path}/_versions/{name}")
            stream = system.open(path)
            try:
                found[int(name)] = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            finally:
                stream.close()
        return found

    def _put(self, number: int, content: dict) -> None:
        """Write the version under another name, then rename it; fails if the number is taken."""
        system, path = file_system(self.spark, f"{self.path}/_versions/{number:0{_VERSION_DIGITS}}")
        _, draft = file_system(self.spark, f"{self.path}/_versions/.{uuid4().hex}")
        stream = system.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        if system.exists(path) or not system.rename(draft, path):
            system.delete(draft, False)
            raise RuntimeError(f"version {number} of {self.path} was declared by another run")

    def version(self) -> int:
        """Number of the newest version, 0 if none was declared."""
        return max(self._versions(), default=0)

    def schema(self, version: int | None = None) -> T.StructType:
        versions = self._versions()
        return _schema(_at(versions, version))

    def declare(
        self, schema: T.StructType, renamed: Mapping[str, str] | None = None,
        defaults: Mapping[str, Any] | None = None,
    ) -> int:
        """Make ``schema`` the newest version and return its number; the same schema adds none.

        ``renamed`` maps new names to those in the version before, ``defaults`` gives added columns
        the value that older rows take. Columns of the version before that ``schema`` neither
        holds nor renames are dropped. Every column must allow nulls in files, so nullability is
        not kept.
        """
        renamed, defaults = dict(renamed or {}), dict(defaults or {})
        names = [f.name for f in schema.fields]
        if len({n.lower() for n in names}) < len(names):
            raise IncompatibleSchema(f"columns that differ in case only: {names}")
        versions = self._versions()
        number = max(versions, default=0)
        before = versions.get(number, {"columns": [], "next": 1})
        old = {c["name"]: c for c in before["columns"]}
        _check_names(renamed, defaults, names, old)
        following, columns = before["next"], []
        for field in schema.fields:
            kind, known = plain(field.dataType), old.get(renamed.get(field.name, field.name))
            if known is None:
                column = {"id": following, "default": defaults.pop(field.name, None)}
                following += 1
            else:
                if not widens(_type(known), kind):
                    raise IncompatibleSchema(
                        f"{field.name}: {_type(known).simpleString()} does not widen to {kind.simpleString()}")
                column = {"id": known["id"], "default": known["default"]}
            columns.append(column | {"name": field.name, "type": kind.jsonValue()})
        if defaults:
            raise IncompatibleSchema(f"defaults are for added columns only: {sorted(defaults)}")
        if number and columns == before["columns"]:
            return number
        self._put(number + 1, {"columns": columns, "next": following})
        return number + 1

    def changes(self) -> list[tuple[int, str, str]]:
        """(version, change, column) for every change after the first version."""
        versions, found = self._versions(), []
        for number in sorted(versions)[1:]:
            old = {c["id"]: c for c in versions[number - 1]["columns"]}
            new = {c["id"]: c for c in versions[number]["columns"]}
            for key, column in new.items():
                if key not in old:
                    found.append((number, "added", column["name"]))
                    continue
                if column["name"] != old[key]["name"]:
                    found.append((number, "renamed", column["name"]))
                if column["type"] != old[key]["type"]:
                    found.append((number, "widened", column["name"]))
            found += [(number, "dropped", c["name"]) for key, c in old.items() if key not in new]
        return found

    # Rows.

    def append(self, df: DataFrame, load: str | None = None) -> None:
        """Write rows of the newest version; runs the write.

        The columns must be those of the version, in any order, of its types or narrower ones.
        ``load`` names the load; a load that is complete is not written again, one that died is.
        """
        versions = self._versions()
        number, target = max(versions, default=0), _schema(_at(versions, None))
        given = {f.name: plain(f.dataType) for f in df.schema.fields}
        if len(given) < len(df.columns) or set(given) != set(target.names):
            raise IncompatibleSchema(f"columns {df.columns} are not those of version {number}: {target.names}")
        for field in target.fields:
            if not widens(given[field.name], field.dataType):
                raise IncompatibleSchema(
                    f"{field.name}: {given[field.name].simpleString()} does not fit {field.dataType.simpleString()}")
        name = load or uuid4().hex
        if any(self._complete(n, name) for n in versions):
            return
        rows = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target.fields])
        rows.write.mode("overwrite").parquet(f"{self.path}/data/version={number}/load={name}")

    def _complete(self, number: int, load: str) -> bool:
        return "_SUCCESS" in self._names(f"data/version={number}/load={load}")

    def read(self, version: int | None = None) -> DataFrame:
        """All rows as ``version``, the newest unless given.

        Rows written after ``version`` are read back to it: columns added since are left out, dropped
        ones are null, and a column widened since raises, as its values may not fit.
        """
        versions = self._versions()
        target = _at(versions, version)
        loads = {n: [name for name in self._names(f"data/version={n}") if name.startswith("load=")
                     and self._complete(n, name.partition("=")[2])] for n in versions}
        # All versions are compared before any file is opened.
        plans = [(n, names, _projection(versions[n], target, n)) for n, names in sorted(loads.items()) if names]
        parts = [
            self.spark.read.schema(_schema(versions[n]))
            .parquet(*[f"{self.path}/data/version={n}/{name}" for name in names]).select(*columns)
            for n, names, columns in plans]
        if not parts:
            return self.spark.createDataFrame([], _schema(target))
        return reduce(DataFrame.unionAll, parts)


def _type(column: dict) -> T.DataType:
    return T.StructField.fromJson(
        {"name": column["name"], "type": column["type"], "nullable": True, "metadata": {}}).dataType


def _schema(content: dict) -> T.StructType:
    return T.StructType([T.StructField(c["name"], _type(c)) for c in content["columns"]])


def _at(versions: dict[int, dict], version: int | None) -> dict:
    number = max(versions, default=0) if version is None else version
    if number not in versions:
        raise IncompatibleSchema(f"version {number} was never declared")
    return versions[number]


def _check_names(renamed: dict, defaults: dict, names: list[str], old: dict) -> None:
    """Renames must lead from a column that was there to one that is there, each once."""
    wrong = [f"{o} to {n}" for n, o in renamed.items()
             if n not in names or o not in old or o in names and o not in renamed]
    if wrong or len(set(renamed.values())) < len(renamed):
        raise IncompatibleSchema(f"renames that do not hold: {wrong or renamed}")
    unknown = sorted(set(defaults) - set(names))
    if unknown:
        raise IncompatibleSchema(f"defaults of columns that are not there: {unknown}")


def _projection(source: dict, target: dict, number: int) -> list[Column]:
    """Columns of ``target`` from rows of ``source``, matched by column number."""
    held, columns = {c["id"]: c for c in source["columns"]}, []
    for column in target["columns"]:
        kind, known = _type(column), held.get(column["id"])
        if known is None:
            # Never held by older files; dropped by newer ones, whose rows have no value for it.
            newer = source["next"] > column["id"]
            value = F.lit(None if newer else column["default"])
        elif widens(_type(known), kind):
            value = F.col(f"`{known['name']}`")
        else:
            raise IncompatibleSchema(
                f"{column['name']} is {_type(known).simpleString()} in version {number}, "
                f"which may not fit {kind.simpleString()}")
        columns.append(value.cast(kind).alias(column["name"]))
    return columns
