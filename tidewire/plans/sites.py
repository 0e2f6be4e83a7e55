"""Reports 2: news sources.

Distinct topics are counted from a (site, topic) aggregate, so the raw rows go through one
partial aggregation and the distinct count sees one row per pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions.clock import AsOf, days_between, month_label, month_start, months_before
from tidewire.functions.measures import named_topic, rounded_ratio, with_share
from tidewire.plans.volume import current_rows, rows


def _named_sites(content: DataFrame) -> DataFrame:
    return current_rows(content).where(F.col("news_site").isNotNull())


def top_sites(content: DataFrame, limit: int = 20) -> DataFrame:
    """2.1 Most productive sites with topics, active span and mean summary length."""
    pairs = _named_sites(content).groupBy("news_site", "topic_name").agg(
        rows().alias("n"),
        F.min("published_at").alias("first"),
        F.max("published_at").alias("last"),
        F.sum(F.length("summary")).alias("letters"),
        F.count("summary").alias("summaries"),
    )
    groups = pairs.groupBy("news_site").agg(
        F.sum("n").alias("article_count"),
        F.count("topic_name").alias("topics_covered"),
        F.min("first").alias("first_article"),
        F.max("last").alias("latest_article"),
        F.sum("letters").alias("letters"),
        F.sum("summaries").alias("summaries"),
    )
    return groups.select(
        "news_site", "article_count", "topics_covered", "first_article", "latest_article",
        days_between(F.col("first_article"), F.col("latest_article")).alias("active_days"),
        rounded_ratio(F.col("letters"), F.col("summaries"), 0).alias("avg_summary_length"),
    ).orderBy(F.desc("article_count"), "news_site").limit(limit)


def site_months(content: DataFrame, as_of: AsOf = None, months: int = 12) -> DataFrame:
    """2.2 Items per month and site in the last months."""
    recent = _named_sites(content).where(F.col("published_at") >= months_before(as_of, months))
    groups = recent.groupBy(month_start("published_at"), "news_site").agg(rows().alias("content_count"))
    return groups.select(
        month_label(F.col("month_start")).alias("year_month"), "news_site", "content_count"
    ).orderBy(F.desc("year_month"), F.desc("content_count"), "news_site")


def site_specialization(content: DataFrame, min_count: int = 5) -> DataFrame:
    """2.3 Topics per site with their share of the site's (sufficiently frequent) output."""
    pairs = _named_sites(content).where(named_topic()).groupBy("news_site", "topic_name").agg(
        rows().alias("article_count")
    )
    frequent = pairs.where(F.col("article_count") >= min_count)
    return with_share(frequent, "article_count", "pct_of_source_output", ["news_site"]).orderBy(
        "news_site", F.desc("article_count"), "topic_name"
    )


def site_diversity(content: DataFrame, min_count: int = 10) -> DataFrame:
    """2.4 Distinct topics per site against its volume."""
    pairs = _named_sites(content).where(named_topic()).groupBy("news_site", "topic_name").agg(rows().alias("n"))
    groups = pairs.groupBy("news_site").agg(
        F.count("topic_name").alias("topic_diversity"), F.sum("n").alias("total_articles")
    ).where(F.col("total_articles") >= min_count)
    return groups.withColumn(
        "diversity_ratio", rounded_ratio(F.col("topic_diversity"), F.col("total_articles"), 3)
    ).orderBy(F.desc("topic_diversity"), F.desc("total_articles"), "news_site")


def site_frequency(content: DataFrame, min_count: int = 50) -> DataFrame:
    """2.5 Items per active day and site."""
    groups = _named_sites(content).groupBy("news_site").agg(
        rows().alias("total_articles"),
        F.min("published_at").alias("first_article"),
        F.max("published_at").alias("latest_article"),
    ).where(F.col("total_articles") >= min_count)
    spanned = groups.withColumn("active_days", days_between(F.col("first_article"), F.col("latest_article")) + 1)
    return spanned.select(
        "news_site", "total_articles", "active_days",
        rounded_ratio(F.col("total_articles"), F.col("active_days")).alias("articles_per_day"),
        "first_article", "latest_article",
    ).orderBy(F.desc("articles_per_day"), "news_site")
