"""Reports 7: over the pre-computed monthly tables, newest load date only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from tidewire.functions.clock import AsOf, month_label, months_before
from tidewire.functions.measures import growth_percent, named_topic, rounded_ratio


def newest_load(aggregate: DataFrame) -> DataFrame:
    return aggregate.where(F.col("ingest_date") == aggregate.select(F.max("ingest_date")).scalar())


def _first_month(as_of: AsOf, months: int) -> Column:
    return month_label(months_before(as_of, months))


def _topic_months(trends: DataFrame) -> GroupedData:
    return newest_load(trends).where(named_topic()).groupBy("year_month", "topic_name")


def topic_trend_report(trends: DataFrame, as_of: AsOf = None, months: int = 12) -> DataFrame:
    """7.1 Total and mean per type, by month and topic."""
    totals = _topic_months(trends).agg(
        F.sum("content_count").alias("total_content"), F.count("content_count").alias("parts")
    ).where(F.col("year_month") >= _first_month(as_of, months))
    return totals.select(
        "year_month", "topic_name", "total_content",
        rounded_ratio(F.col("total_content"), F.col("parts"), 1).alias("avg_per_type"),
    ).orderBy(F.desc("year_month"), F.desc("total_content"), "topic_name")


def site_activity_report(activity: DataFrame, as_of: AsOf = None, months: int = 12) -> DataFrame:
    """7.2 Total by month and site."""
    recent = newest_load(activity).where(F.col("year_month") >= _first_month(as_of, months))
    return (
        recent.groupBy("year_month", "news_site").agg(F.sum("content_count").alias("total_content"))
        .orderBy(F.desc("year_month"), F.desc("total_content"), "news_site")
    )


def topic_growth(trends: DataFrame, as_of: AsOf = None, months: int = 6) -> DataFrame:
    """7.3 Month over month per topic; the earlier month is looked up before the months are cut."""
    monthly = _topic_months(trends).agg(F.sum("content_count").alias("current_month"))
    before = F.lag("current_month", 1).over(Window.partitionBy("topic_name").orderBy("year_month"))
    now, previous = F.col("current_month"), F.col("previous_month")
    grown = monthly.withColumn("previous_month", before).withColumns(
        {
            "absolute_change": now - F.coalesce(previous, F.lit(0)),
            "growth_rate_pct": growth_percent(now, previous),
        }
    )
    return grown.where(F.col("year_month") >= _first_month(as_of, months)).orderBy(
        F.desc("year_month"), F.desc_nulls_last("growth_rate_pct"), "topic_name"
    )


def best_months(trends: DataFrame, top: int = 3) -> DataFrame:
    """7.4 Strongest months per topic, ties sharing a rank."""
    monthly = _topic_months(trends).agg(F.sum("content_count").alias("total_content"))
    ranked = monthly.withColumn(
        "rank_within_topic", F.rank().over(Window.partitionBy("topic_name").orderBy(F.desc("total_content")))
    )
    return ranked.where(F.col("rank_within_topic") <= top).select(
        "topic_name", "year_month", "total_content", F.col("rank_within_topic").cast("bigint").alias("rank_within_topic")
    ).orderBy("topic_name", "rank_within_topic", "year_month")
