"""Reports 9: runs, checks and volume alerts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.clock import AsOf, as_date, as_moment, days_before, days_between, hours_between
from tidewire.functions.measures import anomaly_status, freshness_status, percent, rounded_ratio
from tidewire.plans.volume import current_rows, rows, since_days


def recent_runs(runs: DataFrame, limit: int = 50) -> DataFrame:
    """9.1 Latest runs with records per second."""
    speed = rounded_ratio(F.col("records_processed"), F.col("execution_time_seconds"))
    return runs.select(
        "run_date", "pipeline_name", "status", "records_processed", "execution_time_seconds",
        speed.alias("records_per_second"), "error_message", "created_at",
    ).orderBy(F.desc("run_date"), F.desc("created_at"), "pipeline_name").limit(limit)


def failed_runs(
    runs: DataFrame, as_of: AsOf = None, now: dt.datetime | str | Column | None = None, days: int = 7,
    statuses: tuple[str, ...] = ("failed",),
) -> DataFrame:
    """9.2 Failed runs of the last days and how many hours ago."""
    wanted = F.col("status").isin(*statuses) & (F.col("run_date") >= days_before(as_of, days))
    return runs.where(wanted).select(
        "run_date", "pipeline_name", "status", "error_message", "execution_time_seconds", "created_at",
        hours_between(F.col("created_at"), as_moment(now)).alias("hours_ago"),
    ).orderBy(F.desc("created_at"), "pipeline_name")


def recent_checks(checks: DataFrame, limit: int = 50) -> DataFrame:
    """9.3 Latest quality checks with failure rate."""
    return checks.select(
        "check_date", "check_name", "check_result", "records_checked", "records_failed",
        percent(F.col("records_failed"), F.col("records_checked")).alias("failure_rate_pct"),
        "error_details", "created_at",
    ).orderBy(F.desc("check_date"), F.desc("created_at"), "check_name").limit(limit)


def failed_checks(
    checks: DataFrame, as_of: AsOf = None, days: int = 7, results: tuple[str, ...] = ("failed",)
) -> DataFrame:
    """9.4 Failed checks of the last days; pass ``results=("WARNING",)`` for the content-count check."""
    wanted = F.col("check_result").isin(*results) & (F.col("check_date") >= days_before(as_of, days))
    return checks.where(wanted).select(
        "check_date", "check_name", "check_result", "records_checked", "records_failed", "error_details"
    ).orderBy(F.desc("check_date"), "check_name")


def stale_types(content: DataFrame, as_of: AsOf = None) -> DataFrame:
    """9.5 Days since the last load per type, with an alert."""
    groups = current_rows(content).groupBy("content_type").agg(F.max("ingest_date").alias("latest_ingest_date"))
    days = days_between(F.col("latest_ingest_date"), as_date(as_of))
    return groups.withColumn("days_since_last_ingest", days).withColumn(
        "freshness_status", freshness_status(F.col("days_since_last_ingest"))
    ).orderBy(F.desc("days_since_last_ingest"), "content_type")


def volume_anomalies(content: DataFrame, as_of: AsOf = None, days: int = 30, shown_days: int = 7) -> DataFrame:
    """9.6 Daily volume against the mean and deviation of the period; the last days are shown.

    The statistics are a window over the daily rows (about ``days`` of them).
    """
    recent = since_days(current_rows(content), as_of, days)
    daily = recent.groupBy(F.to_date("published_at").alias("date")).agg(rows().alias("daily_count"))
    period = Window.partitionBy()
    measured = daily.withColumns(
        {
            "avg_daily": F.avg("daily_count").over(period),
            "stddev_daily": F.stddev_samp("daily_count").over(period),
        }
    )
    exact = (F.col("daily_count") - F.col("avg_daily")) / F.nullif(F.col("stddev_daily"), F.lit(0.0))
    return measured.where(F.col("date") >= days_before(as_of, shown_days)).withColumns(
        {"z_score": F.round(exact, 2), "status": anomaly_status(exact)}
    ).orderBy(F.desc("date"))
