"""Reports 8: dashboard figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions.clock import AsOf, days_before
from tidewire.functions.measures import activity_level, named_topic, with_share
from tidewire.plans.topics import topic_site_totals
from tidewire.plans.volume import current_rows, rows, since_days


def executive_summary(content: DataFrame, as_of: AsOf = None) -> DataFrame:
    """8.1 Eight figures in one row.

    Sites and topics are counted from a small (site, topic) aggregate and the distinct items by
    their own single distinct count. Three distinct counts in one aggregate would copy every
    row once per distinct column before the shuffle.
    """
    current = current_rows(content)
    published = F.col("published_at")
    pairs = current.groupBy("news_site", "topic_name").agg(
        rows().alias("n"),
        F.max(published).alias("latest"),
        F.max("ingest_date").alias("latest_ingest"),
        F.count_if(published >= days_before(as_of, 7)).alias("week"),
        F.count_if(published >= days_before(as_of, 30)).alias("month"),
    )
    topic = F.when(named_topic(), F.col("topic_name"))
    figures = pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_content"),
        F.count_distinct("news_site").alias("active_sources"),
        F.count_distinct(topic).alias("topics_covered"),
        F.max("latest").alias("latest_content_date"),
        F.max("latest_ingest").alias("latest_ingest_date"),
        F.coalesce(F.sum("week"), F.lit(0)).alias("content_last_7_days"),
        F.coalesce(F.sum("month"), F.lit(0)).alias("content_last_30_days"),
    )
    items = current.select(F.count_distinct("content_id")).scalar()
    return figures.select(
        "total_content", items.alias("unique_content_items"), "active_sources", "topics_covered",
        "latest_content_date", "latest_ingest_date", "content_last_7_days", "content_last_30_days",
    )


def week_in_days(content: DataFrame, as_of: AsOf = None, days: int = 7) -> DataFrame:
    """8.2 Items, sites, topics and featured items per day."""
    recent = since_days(current_rows(content), as_of, days)
    fine = recent.groupBy(F.date_trunc("day", "published_at").alias("date"), "news_site", "topic_name").agg(
        rows().alias("n"), F.count_if(F.col("featured")).alias("featured")
    )
    return fine.groupBy("date").agg(
        F.sum("n").alias("content_count"),
        F.count_distinct("news_site").alias("active_sources"),
        F.count_distinct("topic_name").alias("topics_covered"),
        F.sum("featured").alias("featured_count"),
    ).orderBy(F.desc("date"))


def type_distribution(content: DataFrame) -> DataFrame:
    """8.3 Items per type with share."""
    groups = current_rows(content).groupBy("content_type").agg(rows().alias("content_count"))
    return with_share(groups, "content_count", "percentage").orderBy(F.desc("content_count"), "content_type")


def leading_topics(content: DataFrame, limit: int = 10) -> DataFrame:
    """8.4 Largest topics."""
    return topic_site_totals(content).select("topic_name", "content_count", "sources_covering").orderBy(
        F.desc("content_count"), "topic_name"
    ).limit(limit)


def leading_sites(content: DataFrame, limit: int = 10) -> DataFrame:
    """8.5 Largest sites."""
    pairs = current_rows(content).where(F.col("news_site").isNotNull()).groupBy("news_site", "topic_name").agg(
        rows().alias("n")
    )
    return pairs.groupBy("news_site").agg(
        F.sum("n").alias("content_count"), F.count("topic_name").alias("topics_covered")
    ).orderBy(F.desc("content_count"), "news_site").limit(limit)


def highlights(content: DataFrame, limit: int = 10) -> DataFrame:
    """8.6 Newest featured items with an image."""
    shown = current_rows(content).where(F.col("featured") & F.col("image_url").isNotNull())
    return shown.orderBy(F.desc("published_at"), "url").limit(limit).select(
        "title", "content_type", "news_site", "topic_name", "published_at", "url", "image_url", "summary"
    )


def activity_heatmap(
    content: DataFrame, as_of: AsOf = None, days: int = 90, very_high: int = 100, high: int = 50, medium: int = 20
) -> DataFrame:
    """8.7 Items per day with an activity level."""
    recent = since_days(current_rows(content), as_of, days)
    groups = recent.groupBy(F.to_date("published_at").alias("date")).agg(rows().alias("content_count"))
    return groups.withColumn(
        "activity_level", activity_level(F.col("content_count"), very_high, high, medium)
    ).orderBy(F.desc("date"))
