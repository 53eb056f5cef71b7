"""Mixing sources to target weights.

Sizes are summed per source, a source's rate is its target over its size, and each
document is taken ``floor(rate)`` times plus once more if a draw seeded by its id falls
below the fraction. The draw is a hash, so a rerun or a retried task takes the same copies.

Cases: a null or empty text has size 0 and is taken as often as the rate says; a null
source is a source of its own; a source without any word has target 0 and rate 0; rows
repeated under one id are drawn alike, and rows without an id are drawn by their text; an
empty table gives an empty result; columns of any other name are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from etlkit.llm.common import pick, word_count
from etlkit.operators.reuse import staged
from etlkit.operators.sizing import broadcast_if_small

# Relative weights, dealt to the sources in code-point order and repeated.
CYCLE = (1, 2, 3)
# A target is at most so many times its source's size.
MOST = 3
SEED = "mix"


def source_targets(
    docs: DataFrame, text: str = "text", source: str = "source",
    cycle: tuple[int, ...] = CYCLE, most: int = MOST,
) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``. Runs when used.

    All sizes are shared by weight. A target above ``most`` times its source's size is cut
    to that, and the excess goes to the others by weight until none is above. With sources in
    ascending order of (limit / weight), those before the first one within its share are cut;
    the level at which the rest share is the greatest of the levels "all before me are cut".
    """
    sized = pick(docs, source=source, text=text).select("source", word_count("text").alias("size"))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on; windows run over that small table.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.element_at(F.array(*map(F.lit, cycle)), (place % len(cycle) + 1).cast("int"))
    sizes = sizes.withColumn("weight", weights.cast("long"))
    limit = F.col("source_size") * most
    everything = Window.partitionBy()
    before = (Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    sharing = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    return (
        sizes.withColumn("level", left.cast("double") / sharing)
        .withColumn("level", F.max("level").over(everything))
        .select("source", "source_size",
                F.least(limit.cast("double"), F.col("level") * F.col("weight")).alias("target"))
    )


def draw(doc_id: str = "doc_id", text: str = "text", seed: str = SEED) -> Column:
    """A number in [0, 1) from the row's id: 52 bits of an MD5."""
    name = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(F.col(text), F.lit("")))))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, 13)
    return F.conv(digits, 16, 10).cast("long").cast("double") / float(16**13)


def copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
           seed: str = SEED) -> DataFrame:
    """``docs`` as a struct ``doc`` with ``size``, ``source_size``, ``target`` and ``copies``.

    The table of sources is written to the shared folder first; it is broadcast only if
    it measures small, else the join shuffles and splits a hot source.
    """
    targets = staged(source_targets(docs, text, source).withColumnRenamed("source", "of"), "targets")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"))
    rows = rows.select(
        "doc", F.col(f"doc.`{source}`").alias("source"), word_count(f"doc.`{text}`").alias("size"),
        draw(f"doc.`{doc_id}`", f"doc.`{text}`", seed).alias("draw"),
    )
    joined = rows.join(broadcast_if_small(targets), F.col("source").eqNullSafe(F.col("of")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate)
    return joined.select(
        "doc", "size", "source_size", "target",
        (whole + (F.col("draw") < rate - whole).cast("long")).alias("copies"))


def mixed(docs: DataFrame, **names: str) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    taken = copies(docs, **names).filter("copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")
