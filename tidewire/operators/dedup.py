"""Keep one record per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.fixed_values import HASH_COLUMNS
from tidewire.session import materialized


def deduplicate_by_key(
    df: DataFrame, keys: list[str], order_by: str, ascending: bool = False, tie_breaks: list[str] | None = None,
    covered: list[str] | None = None,
) -> DataFrame:
    """Latest (or earliest) record per key, the same one on every run.

    ``row_number() = 1`` makes Spark cut every task's rows to one per key before the shuffle
    (WindowGroupLimit), so a key that holds a third of all rows sends one row per task.
    NULLs rank last; equal order values fall back to the tie-breaks and then to a hash of the
    other columns. Columns that a tie-break already tells apart (long texts under a record hash)
    can be named as ``covered`` and are not hashed again.
    """

    def ranked(column: str) -> Column:
        return F.col(column).asc_nulls_last() if ascending else F.col(column).desc_nulls_last()

    order = [ranked(c) for c in [order_by, *(tie_breaks or [])] if c in df.columns]
    told_apart = {*keys, order_by, *(tie_breaks or []), *(covered or [])}
    others = [c for c in df.columns if c not in told_apart]
    if others:
        order.append(F.xxhash64(*others))
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def deduplicate_stored(
    df: DataFrame, keys: list[str], order_by: str, ascending: bool = False, tie_breaks: list[str] | None = None,
    covered: list[str] | None = None,
) -> DataFrame:
    """The same rows as ``deduplicate_by_key``, for frames read from Parquet and only filtered and projected since.

    The winner of each key is elected on key, order and the row's place in its file; other columns are hashed where they
    lie. Keys that occur once need no more. For the others, a small written table as a rule, the winner's place is
    looked up, so wide rows are neither sorted nor, if that table is small enough to broadcast, shuffled. The election
    folds a hot key to one row per task. Rows with a NULL in the key form a key like others.
    """
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    placed = df.withColumn("_place", place)
    ranks = [F.col(c) for c in [order_by, *(tie_breaks or [])] if c in df.columns]
    told_apart = {*keys, order_by, *(tie_breaks or []), *(covered or [])}
    others = [c for c in df.columns if c not in told_apart]
    rest = [F.xxhash64(*others)] if others else []
    if ascending:
        order = [*[part for r in ranks for part in (r.isNull(), r)], *rest]
        best = F.min(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.col("_place").alias("place")))
    else:  # the greatest: NULL is the least value, and of hashes the least comes first
        order = [*ranks, *[F.bitwise_not(r) for r in rest]]
        best = F.max(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.col("_place").alias("place")))
    names = [f"_key{i}" for i in range(len(keys))]
    elected = placed.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).agg(
        F.count(F.lit(1)).alias("_copies"), best.alias("_best")
    )
    repeated = elected.where("_copies > 1").select(*names, F.col("_best.place").alias("_winner"))
    repeated = materialized(df.sparkSession, repeated, "repeated-keys")
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)])
    kept = placed.join(repeated, same, "left").where(F.col("_winner").isNull() | (F.col("_winner") == F.col("_place")))
    return kept.select(*df.columns)


def latest_content(df: DataFrame, stored: bool = False) -> DataFrame:
    """Latest record per (content_type, content_id): by updated_at, then published_at, then hash.

    ``stored``: the frame comes straight from Parquet files.
    """
    one = deduplicate_stored if stored else deduplicate_by_key
    return one(
        df, ["content_type", "content_id"], "updated_at", tie_breaks=["published_at", "record_hash"], covered=HASH_COLUMNS
    )


def latest_by_url(df: DataFrame) -> DataFrame:
    """Second pass: latest record per address."""
    return deduplicate_by_key(
        df, ["url"], "updated_at", tie_breaks=["published_at", "record_hash"], covered=HASH_COLUMNS
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with the number of copies."""
    copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return copies.where(F.col("copies") > 1)
