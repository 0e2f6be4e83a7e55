"""The daily insight record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions.clock import AsOf, as_date, on_day


def _top(aggregate: DataFrame, dimension: str, label: str, day, limit: int) -> DataFrame:
    """One row: the largest groups of a load date as an array of structs, largest first."""
    totals = (
        aggregate.where((F.col("ingest_date") == day) & F.col(dimension).isNotNull() & (F.col(dimension) != ""))
        .groupBy(dimension).agg(F.sum("content_count").alias("n"))
        .orderBy(F.desc("n"), dimension).limit(limit)
    )
    # At most ``limit`` rows meet here; the sort key is the negated count.
    listed = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col(dimension).alias("d"))))
    entries = F.transform(listed, lambda e: F.struct(e["d"].alias(label), (-e["k"]).alias("count")))
    return totals.agg(entries.alias(f"top_{label}s"))


def daily_insights(
    state: DataFrame, trends: DataFrame, activity: DataFrame, ingest_date: AsOf, limit: int = 5
) -> DataFrame:
    """One nested row: totals of the rows opened on the day, top topics and top sources of its aggregates."""
    day = as_date(ingest_date)
    opened = state.where(F.col("is_current") & on_day(F.col("valid_from"), day))
    # Sites and types first, so that the distinct counts run over few rows.
    groups = opened.groupBy("news_site", "content_type").agg(F.count(F.lit(1)).alias("n"))
    stats = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_content"),
        F.count_distinct("news_site").alias("active_sources"),
        F.count_distinct("content_type").alias("content_types"),
    )
    # Each lists frame is one row by construction, and is read as a scalar.
    return stats.select(
        day.cast("string").alias("date"),
        "total_content",
        "active_sources",
        "content_types",
        _top(trends, "topic_name", "topic", day, limit).scalar().alias("top_topics"),
        _top(activity, "news_site", "source", day, limit).scalar().alias("top_sources"),
    )
