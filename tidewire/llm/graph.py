"""Connected components by contraction, entirely in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialized
from .words import bounded


def _between(edges: DataFrame) -> DataFrame:
    """Each edge once, larger end first, without loops."""
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, root) of every vertex in ``links`` (a, b): root is the smallest id of its component.

    In each round every vertex joins its first neighbour, or stays if it comes first itself, and the edges are renamed
    to the joined vertices. The first round goes by id, which folds stars around their smallest id at once; later ones
    by a hash of id and round, which shortens chains by a constant share on average. Rounds end when no edge is left
    between different vertices; the number of rounds follows the logarithm of the longest chain.
    """
    spark = links.sparkSession
    edges = materialized(spark, _between(links.toDF("u", "v")), "components")
    roots = None
    number = 0
    while not edges.isEmpty():
        rank = (lambda c: F.col(c)) if number == 0 else (lambda c, n=number: F.xxhash64(F.col(c), F.lit(n)))
        number += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        place = lambda c: F.struct(rank(c).alias("rank"), F.col(c).alias("id"))
        joined = both.groupBy("u").agg(F.least(F.min(place("v")), place("u"))["id"].alias("root"))
        joined = materialized(spark, joined.withColumnRenamed("u", "id"), "components")
        small = bounded(joined)
        edges = edges.join(small.toDF("u", "root_u"), "u").join(small.toDF("v", "root_v"), "v")
        edges = materialized(spark, _between(edges.select(F.col("root_u").alias("u"), F.col("root_v").alias("v"))), "components")
        if roots is None:
            roots = joined
        else:
            later = bounded(joined.toDF("root", "later"))
            roots = roots.join(later, "root", "left").select("id", F.coalesce("later", "root").alias("root"))
            roots = materialized(spark, roots, "components")
    if roots is None:
        return links.select(F.col("a").alias("id"), F.col("b").alias("root")).limit(0)
    least = bounded(materialized(spark, roots.groupBy("root").agg(F.min("id").alias("least")), "components"))
    return materialized(spark, roots.join(least, "root").select("id", F.col("least").alias("root")), "components")
