"""Mixing sources to target weights, in DataFrame functions only.

Sizes are aggregated per source, targets follow by filling sources up to their caps, and each document is
emitted ``floor(rate)`` times plus one more time with probability ``rate - floor(rate)``, drawn from a hash of
its id, so that reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import col, durable, small, word_count

#: Weights of the sources in code point order, null last, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
#: The mix has this share of all words, and no source more than CAP times its own.
SHARE, CAP = 1.5, 2.0
SEED = "mix-1"


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)`` rows.

    A source gets ``level * weight`` words but at most ``cap`` times its size; the excess goes to the others by weight
    until none is above. Sources are filled in the order of cap / weight: the first that stays below its cap fixes the level.
    The windows run over one row for each source, after aggregation.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(cap))
    by_room = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    above, everything = by_room.rowsBetween(W.unboundedPreceding, -1), W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    zero = F.lit(0.0)
    per = (
        per.withColumn("budget", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("left", F.col("budget") - F.coalesce(F.sum("cap").over(above), zero))
        .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(above), zero))
        .withColumn("level", F.col("left") / F.col("open"))
        .withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
    )
    level = F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(by_room.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    per = per.withColumn("at", level)
    return per.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.col("at") * F.col("weight")).alias("target"))


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from 52 bits of a hash of the id and the text (null: as an empty one)."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def with_copies(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED) -> DataFrame:
    """One row for each document: ``(row, doc_id, size, source_size, target, copies)``; ``row`` holds all input columns.

    Null text: size 0. Null source: a source of its own. Rows with null or repeated ids are drawn by their texts; only rows equal in both
    share a draw. Sources without words get target 0 and their documents no copies, as do all in an all-empty table. Column names can't
    clash: they are in ``row``.
    Targets have a row for each source and are sent to all tasks; where sources are too many for that, the join is by source and AQE
    splits the frequent ones.
    """
    sized = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row") if docs.columns else F.struct().alias("row"),
        col(docs, "doc_id", "long").alias("doc_id"),
        col(docs, "source", "string").alias("source"),
        word_count(col(docs, "text", "string")).alias("size"),
        draw(col(docs, "doc_id", "long"), col(docs, "text", "string"), seed).alias("drawn"),
    )
    targets = durable(source_targets(sized.select("source", "size"), weights, share, cap).withColumnRenamed("source", "of"), "targets")
    rate = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    whole = F.floor(rate)
    return (
        sized.join(small(targets), F.col("source").eqNullSafe(F.col("of")))
        .withColumn("copies", (whole + (F.col("drawn") < rate - whole).cast("long")).cast("long"))
        .select("row", "doc_id", "size", "source_size", "target", "copies")
    )


def mix_sources(docs: DataFrame, **how) -> DataFrame:
    """The mixed documents, each row repeated ``copies`` times, with the input's columns."""
    drawn = with_copies(docs, **how)
    return drawn.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")


def taken_words(docs: DataFrame, **how) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` for every document of the mix."""
    return with_copies(docs, **how).select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), (F.col("size") * F.col("copies")).alias("taken"), "copies")
