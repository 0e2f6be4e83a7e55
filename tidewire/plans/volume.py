"""Reports 1: content volume and distribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.clock import AsOf, days_before, days_between
from tidewire.functions.measures import named_topic, rounded_ratio, with_share


def current_rows(content: DataFrame) -> DataFrame:
    return content.where(F.col("is_current"))


def since_days(content: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    return content.where(F.col("published_at") >= days_before(as_of, days))


def rows() -> Column:
    return F.count(F.lit(1))


def volume_by_type(content: DataFrame) -> DataFrame:
    """1.1 Rows, distinct items, first and last publication, day span and share per type."""
    groups = current_rows(content).groupBy("content_type").agg(
        rows().alias("total_records"),
        F.count_distinct("content_id").alias("unique_content"),
        F.min("published_at").alias("earliest"),
        F.max("published_at").alias("latest"),
    )
    spanned = groups.withColumn("days_span", days_between(F.col("earliest"), F.col("latest")))
    return with_share(spanned, "total_records", "percentage").orderBy(F.desc("total_records"), "content_type")


def daily_volume(content: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    """1.2 Items per day and type in the last days."""
    recent = since_days(current_rows(content), as_of, days)
    return (
        recent.groupBy(F.date_trunc("day", "published_at").alias("publish_date"), "content_type")
        .agg(rows().alias("content_count")).orderBy(F.desc("publish_date"), "content_type")
    )


def topic_distribution(content: DataFrame) -> DataFrame:
    """1.3 Items per topic and type with their share of all."""
    groups = current_rows(content).where(named_topic()).groupBy("topic_name", "content_type").agg(
        rows().alias("content_count")
    )
    return with_share(groups, "content_count", "percentage").orderBy(
        F.desc("content_count"), "topic_name", "content_type"
    )


def text_lengths(content: DataFrame) -> DataFrame:
    """1.4 Title and summary lengths per type, where both are given."""
    sized = current_rows(content).where(F.col("title").isNotNull() & F.col("summary").isNotNull()).select(
        "content_type", F.length("title").alias("title_length"), F.length("summary").alias("summary_length")
    )
    groups = sized.groupBy("content_type").agg(
        rows().alias("total_content"),
        *[
            function(f"{field}_length").alias(f"{name}_{field}_length")
            for name, function in (("sum", F.sum), ("min", F.min), ("max", F.max))
            for field in ("title", "summary")
        ],
    )
    averages = [
        rounded_ratio(F.col(f"sum_{field}_length"), F.col("total_content"), 0).alias(f"avg_{field}_length")
        for field in ("title", "summary")
    ]
    return groups.select(
        "content_type", "total_content", *averages,
        "min_title_length", "max_title_length", "min_summary_length", "max_summary_length",
    ).orderBy(F.desc("total_content"), "content_type")


def featured_share(content: DataFrame) -> DataFrame:
    """1.5 Featured and other items with their share within the type."""
    groups = current_rows(content).groupBy("content_type", "featured").agg(rows().alias("content_count"))
    return with_share(groups, "content_count", "percentage_within_type", ["content_type"]).orderBy(
        "content_type", F.desc("featured")
    )


def image_share(content: DataFrame) -> DataFrame:
    """1.6 Items with and without an image with their share within the type."""
    label = F.when(F.col("image_url").isNotNull(), "With Image").otherwise("No Image").alias("has_image")
    groups = current_rows(content).groupBy("content_type", label).agg(rows().alias("content_count"))
    return with_share(groups, "content_count", "percentage", ["content_type"]).orderBy("content_type", "has_image")
