"""Reports 6: data quality and freshness."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.clock import AsOf, as_date, as_moment, days_before, days_between, hours_between
from tidewire.functions.measures import percent
from tidewire.operators.scd2 import KEYS
from tidewire.plans.volume import current_rows, rows

COMPLETENESS_FIELDS = ["title", "image_url", "summary", "topic_name", "entities", "keywords", "news_site"]


def freshness(content: DataFrame, as_of: AsOf = None, now: dt.datetime | str | Column | None = None) -> DataFrame:
    """6.1 Latest publication and load per type, and how long ago (hours, days)."""
    groups = current_rows(content).groupBy("content_type").agg(
        F.max("published_at").alias("latest_published"), F.max("ingest_date").alias("latest_ingested")
    )
    return groups.withColumns(
        {
            "hours_since_latest_publish": hours_between(F.col("latest_published"), as_moment(now)),
            "days_since_latest_ingest": days_between(F.col("latest_ingested"), as_date(as_of)),
        }
    ).orderBy("content_type")


def completeness(content: DataFrame, fields: list[str] = COMPLETENESS_FIELDS) -> DataFrame:
    """6.2 NULL and given values per field: one pass over the rows, then one row per field."""
    counted = current_rows(content).agg(
        rows().alias("total_count"), *[F.count_if(F.col(f).isNull()).alias(f) for f in fields]
    )
    tall = counted.unpivot("total_count", fields, "field_name", "null_count")
    nulls, total = F.col("null_count"), F.col("total_count")
    return tall.select(
        "field_name", "null_count", "total_count",
        (total - nulls).alias("non_null_count"),
        percent(nulls, total).alias("null_percentage"),
        percent(total - nulls, total).alias("completeness_pct"),
    ).orderBy(F.desc("null_percentage"), "field_name")


def duplicate_current(content: DataFrame) -> DataFrame:
    """6.3 Keys with more than one current version (none in a sound table)."""
    groups = current_rows(content).groupBy(*KEYS).agg(
        rows().alias("current_versions"), F.max("version").alias("latest_version")
    )
    return groups.where(F.col("current_versions") > 1).orderBy(F.desc("current_versions"), *KEYS)


def version_histogram(state: DataFrame) -> DataFrame:
    """6.4 How many items have how many versions."""
    per_key = state.groupBy(*KEYS).agg(rows().alias("version_count"))
    return per_key.groupBy("version_count").agg(rows().alias("content_with_this_many_versions")).orderBy(
        "version_count"
    )


def ingest_quality(state: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    """6.5 Rows, distinct items and duplicates per load date and type, all versions."""
    recent = state.where(F.col("ingest_date") >= days_before(as_of, days))
    groups = recent.groupBy("ingest_date", "content_type").agg(
        rows().alias("records_ingested"), F.count_distinct("content_id").alias("unique_content")
    )
    return groups.withColumn("duplicates_in_batch", F.col("records_ingested") - F.col("unique_content")).orderBy(
        F.desc("ingest_date"), "content_type"
    )


def version_audit(
    state: DataFrame, as_of: AsOf = None, days: int = 7, limit: int = 100, closed_only: bool = False
) -> DataFrame:
    """6.6 Newest versions opened or closed lately.

    An open version ends in 9999 and so always counts as closing late enough; ``closed_only``
    leaves the open ones to their opening time.
    """
    start = days_before(as_of, days)
    closing = F.col("valid_to") >= start
    if closed_only:
        closing = closing & ~F.col("is_current")
    return state.where((F.col("valid_from") >= start) | closing).select(
        *KEYS, "version", "valid_from", "valid_to", "is_current", "title"
    ).orderBy(F.desc("valid_from"), *KEYS, F.desc("version")).limit(limit)
