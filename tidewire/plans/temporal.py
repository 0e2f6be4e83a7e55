"""Reports 4: patterns over time. Windows run on monthly, daily or hourly rows only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.clock import AsOf, month_label, month_start, months_before
from tidewire.functions.measures import growth_percent, rounded_ratio, with_share
from tidewire.plans.volume import current_rows, rows, since_days


def _since_months(content: DataFrame, as_of: AsOf, months: int) -> DataFrame:
    return current_rows(content).where(F.col("published_at") >= months_before(as_of, months))


def monthly_volume(content: DataFrame, as_of: AsOf = None, months: int = 24) -> DataFrame:
    """4.1 Items, active sites and topics per month and type."""
    fine = _since_months(content, as_of, months).groupBy(
        month_start("published_at"), "content_type", "news_site", "topic_name"
    ).agg(rows().alias("n"))
    groups = fine.groupBy("month_start", "content_type").agg(
        F.sum("n").alias("content_count"),
        F.count_distinct("news_site").alias("active_sources"),
        F.count_distinct("topic_name").alias("topics_covered"),
    )
    return groups.select(
        month_label(F.col("month_start")).alias("year_month"), "content_type", "content_count", "active_sources",
        "topics_covered",
    ).orderBy(F.desc("year_month"), "content_type")


def weekly_volume(content: DataFrame, as_of: AsOf = None, weeks: int = 12) -> DataFrame:
    """4.2 Items and active sites per week (weeks start on Monday)."""
    recent = since_days(current_rows(content), as_of, 7 * weeks)
    pairs = recent.groupBy(F.date_trunc("week", "published_at").alias("week_start"), "news_site").agg(
        rows().alias("n")
    )
    groups = pairs.groupBy("week_start").agg(
        F.sum("n").alias("total_content"), F.count("news_site").alias("active_sources")
    )
    return groups.withColumn("avg_per_day", rounded_ratio(F.col("total_content"), F.lit(7), 1)).orderBy(
        F.desc("week_start")
    )


def weekday_pattern(content: DataFrame, as_of: AsOf = None, days: int = 90) -> DataFrame:
    """4.3 Items per day of week (0 is Sunday), share, and the mean over the days."""
    recent = since_days(current_rows(content), as_of, days)
    groups = recent.groupBy((F.dayofweek("published_at") - 1).cast("bigint").alias("day_number")).agg(
        F.date_format(F.min("published_at"), "EEEE").alias("day_of_week"), rows().alias("content_count")
    )
    everything = Window.partitionBy()
    mean = rounded_ratio(F.sum("content_count").over(everything), F.count(F.lit(1)).over(everything), 0)
    return with_share(groups, "content_count", "percentage").withColumn("avg_per_day", mean).orderBy("day_number")


def hourly_pattern(content: DataFrame, as_of: AsOf = None, days: int = 90) -> DataFrame:
    """4.4 Items per hour of day with share."""
    recent = since_days(current_rows(content), as_of, days)
    groups = recent.groupBy(F.hour("published_at").cast("bigint").alias("hour_of_day")).agg(
        rows().alias("content_count")
    )
    return with_share(groups, "content_count", "percentage").orderBy("hour_of_day")


def monthly_growth(content: DataFrame, as_of: AsOf = None, months: int = 12) -> DataFrame:
    """4.5 Month over month growth."""
    monthly = _since_months(content, as_of, months).groupBy(month_start("published_at")).agg(
        rows().alias("current_month")
    )
    counts = monthly.select(month_label(F.col("month_start")).alias("year_month"), "current_month")
    before = F.lag("current_month", 1).over(Window.orderBy("year_month"))
    now, previous = F.col("current_month"), F.col("previous_month")
    return counts.withColumn("previous_month", before).withColumns(
        {"absolute_change": now - previous, "growth_rate_pct": growth_percent(now, previous)}
    ).orderBy(F.desc("year_month"))
