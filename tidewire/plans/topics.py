"""Reports 3: topics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions.clock import AsOf, as_date, days_before, days_between
from tidewire.functions.measures import growth_percent, named_topic, with_share
from tidewire.plans.volume import current_rows, rows


def _named_topics(content: DataFrame) -> DataFrame:
    return current_rows(content).where(named_topic())


def topic_site_totals(content: DataFrame) -> DataFrame:
    """Per topic: items, covering sites, first and last mention, by way of (topic, site) pairs."""
    pairs = _named_topics(content).groupBy("topic_name", "news_site").agg(
        rows().alias("n"), F.min("published_at").alias("first"), F.max("published_at").alias("last")
    )
    return pairs.groupBy("topic_name").agg(
        F.sum("n").alias("content_count"),
        F.count("news_site").alias("sources_covering"),
        F.min("first").alias("first_mention"),
        F.max("last").alias("latest_mention"),
    )


def top_topics(content: DataFrame) -> DataFrame:
    """3.1 Topics by volume with covering sites and share."""
    totals = topic_site_totals(content)
    return with_share(totals, "content_count", "percentage").select(
        "topic_name", "content_count", "sources_covering", "percentage", "first_mention", "latest_mention"
    ).orderBy(F.desc("content_count"), "topic_name")


def topic_type_matrix(content: DataFrame) -> DataFrame:
    """3.2 Topic by type with the share within the topic."""
    groups = _named_topics(content).groupBy("topic_name", "content_type").agg(rows().alias("content_count"))
    return with_share(groups, "content_count", "pct_within_topic", ["topic_name"]).orderBy(
        "topic_name", F.desc("content_count"), "content_type"
    )


def trending_topics(content: DataFrame, as_of: AsOf = None, days: int = 7) -> DataFrame:
    """3.3 The last days against the days before, per topic.

    One scan with two conditional counts gives what two aggregates and a full outer join would.
    """
    today, middle, start = as_date(as_of), days_before(as_of, days), days_before(as_of, 2 * days)
    published = F.col("published_at")
    window = _named_topics(content).where((published >= start) & (published < today))
    groups = window.groupBy("topic_name").agg(
        F.count_if(published >= middle).alias("last_7_days"),
        F.count_if(published < middle).alias("previous_7_days"),
    )
    last, previous = F.col("last_7_days"), F.col("previous_7_days")
    return groups.withColumns(
        {"absolute_change": last - previous, "percent_change": growth_percent(last, previous)}
    ).orderBy(F.desc("absolute_change"), "topic_name")


def emerging_topics(content: DataFrame, as_of: AsOf = None, days: int = 90) -> DataFrame:
    """3.4 Topics whose first item is recent."""
    recent = topic_site_totals(content).where(F.col("first_mention") >= days_before(as_of, days))
    return recent.select(
        "topic_name",
        F.col("first_mention").alias("first_appearance"),
        F.col("content_count").alias("article_count"),
        F.col("sources_covering").alias("sources"),
        days_between(F.col("first_mention"), as_date(as_of)).alias("days_since_first"),
    ).orderBy(F.desc("first_appearance"), "topic_name")
