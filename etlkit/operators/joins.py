"""Joins by strategy, with checked broadcasts and salted hot keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from etlkit.operators.sizing import (
    BROADCAST_LIMIT_BYTES, broadcast_if_small, hot_keys, is_hot, is_small, measured_bytes, parts_for, parts_of,
    row_salt, shuffle_partitions,
)

STRATEGIES = ("auto", "broadcast", "merge", "shuffle_hash")


def _hash_tables_fit(right: DataFrame, keys: list[str], limit_bytes: int) -> bool:
    """Whether the largest hash table of a shuffled hash join on ``right`` fits the limit."""
    hottest = max(hot_keys(right, keys).values(), default=0.0)
    return measured_bytes(right) * max(hottest, 1 / shuffle_partitions(right)) <= limit_bytes


def equi_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    strategy: str = "auto",
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Join on equal columns; ``right`` is the smaller side.

    ``auto`` leaves the choice to Spark, which broadcasts by measured run-time size.
    ``broadcast`` measures ``right`` first and falls back to ``auto`` beyond the
    limit. ``shuffle_hash`` builds its tables on ``right`` if they measurably fit,
    else the join sorts. Shuffle joins leave hot keys of ``left`` to adaptive
    execution, which splits their partition.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown join strategy {strategy!r}, expected one of {STRATEGIES}")
    keys = [on] if isinstance(on, str) else list(on)
    if strategy == "broadcast":
        right = broadcast_if_small(right, limit_bytes)
    elif strategy == "shuffle_hash" and not _hash_tables_fit(right, keys, limit_bytes):
        right = right.hint("merge")
    elif strategy != "auto":
        right = right.hint(strategy)
    return left.join(right, keys, how)


def join_aggregate(
    fact: DataFrame,
    dimension: DataFrame,
    on: Sequence[str],
    by: Sequence[str],
    sums: Mapping[str, str | Column],
    rows: str = "rows",
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Sums and row count of an inner join, grouped by dimension columns ``by``.

    A dimension measured small is broadcast. Otherwise the fact is first summed
    per join key: only partial sums are shuffled, and a key holding many rows
    becomes one row per map task.
    """
    values = {name: F.expr(v) if isinstance(v, str) else v for name, v in sums.items()}
    used = fact.select(*on, *[v.alias(name) for name, v in values.items()])
    if is_small(dimension, limit_bytes):
        joined = used.join(F.broadcast(dimension), list(on))
        counted = F.count(F.lit(1))
    else:
        partial = used.groupBy(*on).agg(
            *[F.sum(name).alias(name) for name in values], F.count(F.lit(1)).alias("__rows"))
        joined = partial.join(dimension, list(on))
        counted = F.sum("__rows")
    return joined.groupBy(*by).agg(
        *[F.sum(name).alias(name) for name in values], counted.alias(rows))


def _same_types(left: DataFrame, right: DataFrame, keys: list[str]) -> None:
    differing = [k for k in keys if left.schema[k].dataType != right.schema[k].dataType]
    if differing:
        raise ValueError(f"cast the join keys to one type first: {differing}")


def salt_sides(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    share: float = 0.01,
    salts: int | None = None,
    name: str = "salt",
) -> tuple[DataFrame, DataFrame]:
    """Add a salt to both sides so that an inner join on (keys, salt) equals one on keys.

    A key that holds more than ``share`` of a side is cut there into as many parts as its own
    share needs (``salts`` on the left if given). Its rows form a rectangle of left parts by right
    parts: a left row lies in one of the left parts and is repeated for each right part, a right
    row the other way round, so each pair of rows meets in one cell and no cell holds more than a
    part of either side. A key that is hot on one side only is repeated on the other as often as it
    is cut. All other rows keep salt 0. Runs one scan of the keys of each side to find hot ones.
    """
    keys = list(on)
    _same_types(left, right, keys)
    lefts, rights = _rectangles(left, right, keys, share, salts)
    return (_cells(left, parts_of(left, keys, lefts), parts_of(left, keys, rights), True, name),
            _cells(right, parts_of(right, keys, lefts), parts_of(right, keys, rights), False, name))


def _rectangles(
    left: DataFrame, right: DataFrame, keys: list[str], share: float, salts: int | None
) -> tuple[dict[int, int], dict[int, int]]:
    lefts, rights = (parts_for(side, hot_keys(side, keys, share)) for side in (left, right))
    return ({h: salts for h in lefts} if salts else lefts), rights


def _cells(df: DataFrame, lefts: Column, rights: Column, is_left: bool, name: str) -> DataFrame:
    """``df`` once for each cell of its key's rectangle that the row belongs to."""
    own = row_salt(df, lefts if is_left else rights)
    sized = df.withColumns({"__own": own, "__lefts": lefts, "__rights": rights})
    if is_left:
        cells = F.transform(F.sequence(F.lit(0), F.col("__rights") - 1), lambda j: F.col("__own") * F.col("__rights") + j)
    else:
        cells = F.transform(F.sequence(F.lit(0), F.col("__lefts") - 1), lambda i: i * F.col("__rights") + F.col("__own"))
    single = F.array(F.lit(0))
    cells = F.when((F.col("__lefts") == 1) & (F.col("__rights") == 1), single).otherwise(cells)
    return sized.withColumn(name, F.explode(cells)).drop("__own", "__lefts", "__rights")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    share: float = 0.01,
    salts: int | None = None,
) -> DataFrame:
    """Inner or left join that spreads the hot keys of either side; result as unsalted.

    For a left join the keys that are cut on the right are read once more: a left row is repeated
    only for a key that is really there, so it has a match in some cell and its copies
    without one are left out.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left")
    keys = list(on)
    if how == "inner":
        salted_left, salted_right = salt_sides(left, right, keys, share, salts, "__salt")
        return salted_left.join(salted_right, [*keys, "__salt"]).drop("__salt")
    _same_types(left, right, keys)
    lefts, rights = _rectangles(left, right, keys, share, salts)
    parts = parts_of(right, keys, rights)
    salted_right = _cells(right, parts_of(right, keys, lefts), parts, False, "__salt")
    if not rights:
        salted_left = _cells(left, parts_of(left, keys, lefts), F.lit(1), True, "__salt")
        return salted_left.join(salted_right, [*keys, "__salt"], "left").drop("__salt")
    cut = right.filter(is_hot(right, keys, rights)).select(*keys, parts.alias("__parts")).distinct()  # at most 1 / share
    known = left.join(F.broadcast(cut), keys, "left").withColumn("__parts", F.coalesce("__parts", F.lit(1)))
    salted_left = _cells(known, parts_of(known, keys, lefts), F.col("__parts"), True, "__salt")
    joined = salted_left.join(salted_right.withColumn("__met", F.lit(True)), [*keys, "__salt"], "left")
    return joined.filter(F.col("__met") | (F.col("__parts") == 1)).drop("__salt", "__met", "__parts")


def hot_key_split_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    share: float = 0.01,
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Broadcast the right rows of hot keys, shuffle the rest, and union both parts.

    The right rows of hot keys are measured; if they exceed the broadcast limit
    the whole join is salted instead. Reads the left side once per part.
    """
    if how not in ("inner", "left"):
        raise ValueError("hot_key_split_join supports inner and left")
    keys = list(on)
    _same_types(left, right, keys)
    hot = hot_keys(left, keys, share)
    if not hot:
        return left.join(right, keys, how)
    hot_right = right.filter(is_hot(right, keys, hot))
    if not is_small(hot_right, limit_bytes):
        return salted_join(left, right, keys, how, share)
    hot_part = left.filter(is_hot(left, keys, hot)).join(F.broadcast(hot_right), keys, how)
    rest = left.filter(~is_hot(left, keys, hot)).join(
        right.filter(~is_hot(right, keys, hot)), keys, how)
    return hot_part.unionByName(rest)
