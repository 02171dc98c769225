"""Mixing sources to target weights by hash thresholds; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aeroline.session import staged

WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of the hash that each level adds: 4096 buckets a source and level.
DIGITS, LEVELS = 3, 3
MOST = 3


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``size`` (words, null text: 0) and ``mark`` (hash digits that order a source's rows)."""
    return docs.select(
        F.col("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, DIGITS * LEVELS).alias("mark"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """``source``, ``source_size``, ``target`` per source, one row each.

    Sources by code point, null last, take ``weights`` in turn. A target stops at ``most`` times its source's size and
    the excess is shared again by weight. That has a closed form: with sources in the order of cap by weight, the
    first ones are full, and the others get ``level`` words per unit of weight. The windows run over one row per source.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = sums.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")))
    weighed = weighed.withColumn("cap", F.col("source_size") * most).withColumn("full_at", F.col("cap") / F.col("weight"))
    order = W.orderBy("full_at", F.col("source").asc_nulls_last())
    every = W.partitionBy(F.lit(1))
    spread = (
        weighed
        .withColumn("before", F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("rest_weight", F.sum("weight").over(order.rowsBetween(W.currentRow, W.unboundedFollowing)))
        .withColumn("level_here", (F.sum("source_size").over(every) - F.col("before")) / F.col("rest_weight"))
        .withColumn("level", F.max(F.when(F.col("level_here") <= F.col("full_at"), F.col("level_here"))).over(every)))
    target = F.when(F.col("full_at") <= F.col("level"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("level"))
    return spread.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """``doc_id``, ``size``, ``source``, ``source_size``, ``target``, ``times`` and ``taken`` = ``times`` x ``size``.

    ``docs`` has ``doc_id``, ``text``, ``source``; nulls are allowed everywhere, other columns are left behind. A
    source's target is whole rounds of all its documents, and a budget for the rest. The rest goes to documents by
    hash: words are summed by source and bucket, the bucket in which the sum passes the budget is split again by more
    digits, and what is left at the last level, usually one document, is taken if that comes nearer to the target.
    Nothing is sorted but at most 4096 sums a source. Rows with equal doc_id share their hash and go together.
    """
    rows = staged(sized(docs), "mix-sizes")
    aims = targets(rows, weights, most)
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    aims = aims.withColumn("rounds", rounds.cast("long"))
    aims = aims.withColumn("edge", F.lit("")).withColumn("budget", F.col("target") - F.col("rounds") * F.col("source_size"))
    aims = staged(aims.withColumn("below", F.lit(0).cast("long")).withColumn("at_edge", F.col("source_size")), "mix-targets")
    for level in range(1, LEVELS + 1):
        bucket = F.substring("mark", 1, DIGITS * level)
        known = aims.select(F.col("source").alias("of"), "edge", "below", "budget")
        inside = rows.join(known, F.col("source").eqNullSafe(F.col("of")) & F.col("mark").startswith(F.col("edge")))
        sums = inside.groupBy("source", bucket.alias("bucket")).agg(
            F.sum("size").alias("words"), F.first("below").alias("start"), F.first("budget").alias("budget"))
        upto = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
        passed = sums.withColumn("reached", F.col("start") + F.sum("words").over(upto)).where("reached > budget")
        cut = passed.groupBy("source").agg(F.min(F.struct("bucket", "reached", "words")).alias("cut")).select(
            F.col("source").alias("of"), F.col("cut.bucket").alias("next_edge"),
            (F.col("cut.reached") - F.col("cut.words")).alias("next_below"), F.col("cut.words").alias("next_at"))
        moved = aims.join(cut, F.col("source").eqNullSafe(F.col("of")), "left")
        aims = staged(moved.select(
            "source", "source_size", "target", "rounds", "budget",
            F.coalesce("next_edge", "edge").alias("edge"), F.coalesce("next_below", "below").alias("below"),
            F.coalesce("next_at", "at_edge").alias("at_edge")), f"mix-level-{level}")
    nearer = F.col("below") + F.col("at_edge") - F.col("budget") < F.col("budget") - F.col("below")
    chosen = (F.col("mark") < F.col("edge")) | ((F.col("mark") == F.col("edge")) & nearer)
    own = aims.withColumnRenamed("source", "of")
    out = rows.join(own, F.col("source").eqNullSafe(F.col("of")))
    times = F.col("rounds") + F.when(chosen, 1).otherwise(0)
    return out.select("doc_id", "size", "source", "source_size", "target", times.alias("times"), (F.col("size") * times).alias("taken"))


def repeated(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns.

    How often is decided by source and doc_id alone, so rows that share both are taken alike.
    """
    times = mix(docs, weights, most).where("times > 0").select(
        F.col("source").alias("mix_source"), F.col("doc_id").alias("mix_id"), "times").distinct()
    own = docs.select(F.struct(*docs.columns).alias("doc"))
    joined = own.join(times, F.col("doc.doc_id").eqNullSafe(F.col("mix_id")) & F.col("doc.source").eqNullSafe(F.col("mix_source")))
    return joined.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select("doc.*")
