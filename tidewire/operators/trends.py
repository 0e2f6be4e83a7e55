"""Monthly pre-aggregates and the daily summary."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.clock import AsOf, as_date, as_moment, month_label, month_start
from tidewire.functions.measures import cast_or_null


def _monthly(content: DataFrame, dimension: str, ingest_date: AsOf, now) -> DataFrame:
    counts = content.groupBy(month_start("published_at"), dimension, "content_type").agg(
        F.count(F.lit(1)).alias("content_count")
    )
    return counts.select(
        month_label(F.col("month_start")).alias("year_month"), dimension, "content_type", "content_count",
        as_date(ingest_date).alias("ingest_date"), as_moment(now).alias("calculated_at"),
    )


def topic_trends(
    content: DataFrame, ingest_date: AsOf, now: dt.datetime | str | Column | None = None
) -> DataFrame:
    """Items per month, topic and type."""
    return _monthly(content, "topic_name", ingest_date, now)


def site_activity(
    content: DataFrame, ingest_date: AsOf, now: dt.datetime | str | Column | None = None
) -> DataFrame:
    """Items per month, site and type."""
    return _monthly(content, "news_site", ingest_date, now)


def latest_month_top(trends: DataFrame, dimension: str, limit: int = 5) -> DataFrame:
    """Largest groups of the newest month."""
    newest = trends.select(F.max("year_month")).scalar()
    rows = trends.where(F.col("year_month") == newest)
    return (
        rows.select("year_month", dimension, "content_type", "content_count")
        .orderBy(F.desc("content_count"), dimension, "content_type").limit(limit)
    )


def typed_aggregate(staged: DataFrame, dimension: str) -> DataFrame:
    """Staged aggregate text to typed rows; rows without a full key are left out."""
    complete = F.col("year_month").isNotNull() & F.col(dimension).isNotNull() & F.col("content_type").isNotNull()
    return staged.where(complete).withColumns(
        {
            "content_count": cast_or_null(F.col("content_count"), "int").cast("bigint"),
            "ingest_date": cast_or_null(F.col("ingest_date"), "date"),
            "calculated_at": cast_or_null(F.col("calculated_at"), "timestamp"),
        }
    )


def daily_summary(content: DataFrame) -> DataFrame:
    """Current items per publishing day, type, site and topic: small enough to feed every dashboard."""
    current = content.where(F.col("is_current"))
    return current.groupBy(
        F.to_date("published_at").alias("date"), "content_type", "news_site", "topic_name"
    ).agg(
        F.count(F.lit(1)).alias("content_count"),
        F.count_if(F.col("featured")).alias("featured_count"),
    )
