"""Mixing sources to target weights by hash thresholds.

Every row has a fixed position on a hash line of ``HASH_BITS`` bits. Copy j of a source is taken up to a threshold on
that line, so budgets are nested: rows of the second copy are a subset of those of the first. Thresholds come from
histograms: words are summed by source and hash bucket, the running sum finds the bucket in which a budget ends, and
only rows of that boundary bucket are summed again by the next bits. No rows are sorted.

Rows equal in the key share a position and are taken together. Null keys share one position per source. Null sources
are a source of their own, after all others. Sizes that are null count 0. An empty table gives an empty mix.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialized
from .words import bounded

HASH_BITS = 60
BUCKET_BITS = 10
WEIGHTS = (3.0, 1.0, 2.0)


def position(key: Column) -> Column:
    """The place of a key on the hash line, 0 to 2^60 - 1."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, HASH_BITS // 4), 16, 10).cast("long")


def ranked_sources(sized: DataFrame) -> DataFrame:
    """(source_key, source_size, source_rank): one row per source, ranked by code point from 0, null last.

    Ranks are counted within range partitions and shifted by the counts of earlier partitions, so that no task sees
    all sources.
    """
    spark = sized.sparkSession
    totals = sized.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    ranged = materialized(
        spark, totals.repartitionByRange("source_key").withColumn("part", F.spark_partition_id()), "mix-sources"
    )
    before = ranged.groupBy("part").count().select(
        "part",
        F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("before"),
    )
    within = F.row_number().over(Window.partitionBy("part").orderBy("source_key")) - 1
    return ranged.join(F.broadcast(before), "part").select(
        "source_key", "source_size", (within + F.col("before")).alias("source_rank")
    )


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """Adds each source's target: ``share`` of all sizes split by weight, none above ``cap`` times its source's size.

    What a capped source leaves over goes to the others by weight, until none is above. Each round needs two sums.
    """
    spark = sources.sparkSession
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_rank") % len(weights) + 1).cast("int"))
    open_ = materialized(
        spark, sources.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(cap))), "mix-weights"
    )
    total = open_.agg(F.sum("source_size")).first()[0] or 0
    budget, capped, full = share * total, 0.0, F.lit(False)
    while True:
        rest, weight_sum = open_.agg(
            F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if not weight_sum:
            return open_.withColumn("target", F.col("most"))
        left = budget - (rest or 0.0)
        fair = F.lit(left) * F.col("weight") / F.lit(float(weight_sum))
        above = full | (fair > F.col("most"))
        now = open_.filter(above).count()
        if now == capped:
            return open_.withColumn("target", F.when(full, F.col("most")).otherwise(fair))
        capped, full = now, _frozen(open_, above)


def _frozen(open_: DataFrame, above: Column) -> Column:
    """The sources above their cap, by a level on most / weight: all up to the largest such ratio are above."""
    level = open_.filter(above).agg(F.max(F.col("most") / F.col("weight"))).first()[0]
    return F.col("most") / F.col("weight") <= F.lit(level)


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source_key, copy, threshold): rows at positions below the threshold use the budget up, to the nearest row.

    ``budgets``: (source_key, copy, budget, source_size). Budgets of all or nothing need no search.
    """
    spark = sized.sparkSession
    end = 1 << HASH_BITS
    start = materialized(spark, budgets, "mix-budgets")
    done = [
        start.filter("budget <= 0").select("source_key", "copy", F.lit(0).cast("long").alias("threshold")),
        start.filter("budget > 0 AND budget >= source_size").select("source_key", "copy", F.lit(end).alias("threshold")),
    ]
    state = start.filter("budget > 0 AND budget < source_size").select(
        "source_key", "copy", F.lit(0).cast("long").alias("prefix"), F.col("budget").cast("double").alias("left")
    )
    for shift in range(HASH_BITS - BUCKET_BITS, -1, -BUCKET_BITS):
        state = materialized(spark, state, "mix-state")
        if state.isEmpty():
            break
        inside = sized.select("source_key", "position", "size", F.shiftright("position", shift + BUCKET_BITS).alias("prefix"))
        histogram = inside.join(bounded(state), ["source_key", "prefix"]).groupBy(
            "source_key", "copy", "left", F.shiftright("position", shift).alias("bucket")
        ).agg(F.sum("size").alias("words"), F.min("position").alias("first"), F.max("position").alias("last"))
        line = Window.partitionBy("source_key", "copy").orderBy("bucket")
        before = F.coalesce(F.sum("words").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        boundary = materialized(
            spark,
            histogram.withColumn("left", F.col("left") - before)
            .filter((F.col("left") >= 0) & (F.col("left") < F.col("words"))),
            "mix-boundary",
        )
        one = F.col("first") == F.col("last")
        done.append(boundary.filter(one).select(
            "source_key", "copy",
            F.when(F.col("left") * 2 >= F.col("words"), F.col("last") + 1).otherwise(F.col("first")).alias("threshold"),
        ))
        state = boundary.filter(~one).select("source_key", "copy", F.col("bucket").alias("prefix"), "left")
    return materialized(spark, reduce(DataFrame.unionByName, done), "mix-thresholds")


def mix(
    docs: DataFrame,
    size: Column,
    *,
    key: str = "doc_id",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = 1.5,
    cap: int = 2,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(key, source, *keep, size, source_size, target, copies): how often the mix takes each row.

    ``weights`` repeat over the sources in code point order; ``cap`` is the most copies of a row.
    ``copies`` times ``size`` summed over a source is its target, to half the row at which a budget ends.
    """
    spark = docs.sparkSession
    sized = materialized(
        spark,
        docs.select(
            F.col(key), F.col(source), *[F.col(c) for c in keep], F.coalesce(size, F.lit(0)).cast("long").alias("size"),
            F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source))).alias("source_key"),
            position(F.col(key)).alias("position"),
        ),
        "mix-sizes",
    )
    aimed = materialized(spark, targets(ranked_sources(sized), weights, share, float(cap)), "mix-targets")
    copies = aimed.select("source_key", "source_size", "target", F.explode(F.sequence(F.lit(1), F.lit(cap))).alias("copy"))
    budgets = copies.select(
        "source_key", "source_size", "copy",
        F.least(F.col("target") - (F.col("copy") - 1) * F.col("source_size"), F.col("source_size").cast("double")).alias("budget"),
    )
    ends = thresholds(sized, budgets).groupBy("source_key").agg(F.collect_list("threshold").alias("ends"))
    plan = materialized(spark, aimed.select("source_key", "source_size", "target").join(ends, "source_key"), "mix-plan")
    return sized.join(bounded(plan), "source_key").select(
        key, source, *keep, "size", "source_size", "target",
        F.size(F.filter("ends", lambda end: F.col("position") < end)).alias("copies"),
    )
