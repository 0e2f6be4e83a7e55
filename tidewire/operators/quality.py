"""Quality measures and alert rows. Alerts are rows of a table; sending them is someone else's job."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.clock import AsOf, as_date, as_moment, on_day
from tidewire.functions.measures import percent, run_identifier
from tidewire.operators.dedup import duplicate_keys

REQUIRED_FIELDS = ["id", "title", "url", "published_at"]


def quality_issues(
    counts: DataFrame, affected: str = "affected_records", total: str = "total_records", critical_above: float = 50.0
) -> DataFrame:
    """Failure rate (0 for an empty total) and severity per counted issue."""
    rate = F.coalesce(percent(F.col(affected), F.col(total)), F.lit(0.0))
    # The severity looks at the exact counts, not at the rounded rate.
    over = F.col(affected) * 100.0 > F.col(total) * critical_above
    return counts.withColumns(
        {
            "failure_rate": rate,
            "severity": F.when(over & (F.col(total) > 0), "CRITICAL").otherwise("WARNING"),
        }
    )


def threshold_breaches(metrics: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Metrics (metric_name, current_value) that break their rule (metric_name, threshold, comparison)."""
    value, limit = F.col("current_value"), F.col("threshold")
    broken = (
        F.when(F.col("comparison") == ">", value > limit)
        .when(F.col("comparison") == ">=", value >= limit)
        .when(F.col("comparison") == "<", value < limit)
        .when(F.col("comparison") == "<=", value <= limit)
        .when(F.col("comparison") == "=", value == limit)
        .otherwise(F.lit(False))
    )
    joined = metrics.join(thresholds, "metric_name")
    return joined.where(broken).withColumn("severity", F.lit("WARNING"))


def layer_loss(counts: DataFrame, max_loss_pct: float = 10.0) -> DataFrame:
    """Loss between two layers per group (bronze_count, silver_count): acceptable below the limit."""
    bronze, silver = F.col("bronze_count"), F.col("silver_count")
    loss = percent(bronze - silver, bronze)
    small = (bronze == silver) | ((bronze - silver) * 100.0 < bronze * max_loss_pct)
    return counts.withColumns({"loss_pct": loss, "acceptable": (silver <= bronze) & small})


def null_fields(df: DataFrame, fields: list[str] | None = None, key: str = "id") -> DataFrame:
    """One row per record and required field that is NULL."""
    fields = fields or REQUIRED_FIELDS
    missing = F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in fields]))
    return df.select(F.col(key).cast("string").alias("record_id"), F.explode(missing).alias("field_name"))


def suspicious_dates(
    df: DataFrame, as_of: AsOf = None, oldest_year: int = 2000, moment: str = "published_at", key: str = "content_id"
) -> DataFrame:
    """Records dated after ``as_of`` or before ``oldest_year``."""
    day = F.to_date(moment)
    issue = F.when(day > as_date(as_of), "Future date").when(F.year(day) < oldest_year, "Very old date")
    return df.select(key, day.alias("published_date"), issue.alias("issue")).where(F.col("issue").isNotNull())


def unofficial_sites(checked: DataFrame) -> DataFrame:
    """Rows per site that is not on the official list."""
    off_list = checked.where(~F.col("news_site_validated"))
    return off_list.groupBy("news_site").agg(F.count(F.lit(1)).alias("record_count"))


def reason_counts(checked: DataFrame, reason: str = "_error_reason", by: list[str] | None = None) -> DataFrame:
    """Rows per broken rule with the total they belong to, ready for ``quality_issues``.

    Groups by reason first; the totals are sums over that small frame, joined back.
    """
    by = by or []
    groups = checked.groupBy(*by, F.col(reason).alias("issue_type")).agg(F.count(F.lit(1)).alias("affected_records"))
    if by:
        totals = groups.groupBy(*by).agg(F.sum("affected_records").alias("total_records"))
        groups = groups.join(totals, by)
    else:
        total = groups.select(F.sum("affected_records")).scalar()
        groups = groups.withColumn("total_records", total)
    return groups.where(F.col("issue_type").isNotNull())


def run_events(runs: DataFrame) -> DataFrame:
    """Alert rows for finished runs: ERROR for a failed run, INFO for a completed one."""
    failed = F.col("run_status") == "failed"
    return runs.select(
        "run_id",
        F.when(failed, "ERROR").otherwise("INFO").alias("severity"),
        F.when(failed, F.concat(F.lit("Run failed: "), "run_type"))
        .otherwise(F.lit("Pipeline Completed Successfully")).alias("subject"),
        "ingest_date",
        "records_processed",
        "duration_seconds",
        "error_message",
    )


def _opened_per_day(state: DataFrame, ingest_date: AsOf, count: str) -> DataFrame:
    """Current rows by the day they were opened; a single given day is reported even without rows."""
    current = state.where(F.col("is_current"))
    rows = F.count(F.lit(1)).alias(count)
    if ingest_date is None:
        return current.groupBy(F.to_date("valid_from").alias("ingest_date")).agg(rows)
    day = as_date(ingest_date)
    return current.where(on_day(F.col("valid_from"), day)).agg(rows).withColumn("ingest_date", day)


def record_runs(
    state: DataFrame, completed_at: dt.datetime | str | Column | None = None,
    started_at: dt.datetime | str | Column | None = None, failed: DataFrame | None = None,
    ingest_date: AsOf = None, run_type: str = "daily_load",
) -> DataFrame:
    """Rows of completed runs: one per load day, processed = current rows opened on that day.

    Give ``ingest_date`` for a single day; otherwise every day in the state is reported.
    ``failed`` holds ``ingest_date`` and ``records_failed``.
    """
    processed = _opened_per_day(state, ingest_date, "records_processed")
    if failed is not None:
        processed = processed.join(failed, "ingest_date", "left")
        lost = F.coalesce("records_failed", F.lit(0)).cast("bigint")
    else:
        lost = F.lit(0).cast("bigint")
    begin, end = as_moment(started_at), as_moment(completed_at)
    return processed.select(
        run_identifier(F.col("ingest_date"), end).alias("run_id"),
        F.lit(run_type).alias("run_type"),
        F.lit("completed").alias("run_status"),
        "ingest_date",
        "records_processed",
        lost.alias("records_failed"),
        F.lit(None).cast("string").alias("error_message"),
        begin.alias("started_at"),
        end.alias("completed_at"),
        (F.unix_timestamp(end) - F.unix_timestamp(begin)).alias("duration_seconds"),
        end.alias("created_at"),
    )


def failed_run(
    spark: SparkSession, error: str, completed_at: dt.datetime | str | Column, started_at: dt.datetime | str | Column,
    ingest_date: AsOf, run_type: str = "daily_load",
) -> DataFrame:
    """The run row of a day whose job broke off."""
    begin, end = as_moment(started_at), as_moment(completed_at)
    return spark.range(1).select(as_date(ingest_date).alias("ingest_date")).select(
        run_identifier(F.col("ingest_date"), end).alias("run_id"),
        F.lit(run_type).alias("run_type"),
        F.lit("failed").alias("run_status"),
        "ingest_date",
        F.lit(0).cast("bigint").alias("records_processed"),
        F.lit(0).cast("bigint").alias("records_failed"),
        F.lit(error).alias("error_message"),
        begin.alias("started_at"),
        end.alias("completed_at"),
        (F.unix_timestamp(end) - F.unix_timestamp(begin)).alias("duration_seconds"),
        end.alias("created_at"),
    )


def issue_rows(
    bronze: DataFrame, silver: DataFrame, quarantined: DataFrame, ingest_date: AsOf, now: dt.datetime | str | Column | None = None,
    max_loss_pct: float = 10.0,
) -> DataFrame:
    """A load date's quality issues, one row each: broken rules, lost records, copies, NULL fields, odd dates, sites
    off the list. Counts only; the frames are reduced to a few rows per issue before they meet.

    ``bronze``: all records read (content_type, id). ``quarantined``: those set aside, with their reason.
    """
    columns = ["issue_type", "subject", "affected_records", "total_records"]
    number = lambda c: F.col(c).cast("bigint")
    read = bronze.groupBy("content_type").agg(F.count(F.lit(1)).alias("bronze_count"))
    kept = silver.groupBy("content_type").agg(F.count(F.lit(1)).alias("silver_count"))
    total = read.select(F.sum("bronze_count")).scalar()
    kept_total = kept.select(F.sum("silver_count")).scalar()
    broken = quarantined.groupBy(F.col("_error_reason").alias("subject")).agg(F.count(F.lit(1)).alias("affected_records"))
    broken = broken.withColumns({"issue_type": F.lit("broken rule"), "total_records": total})
    loss = layer_loss(
        read.join(kept, "content_type", "left").withColumn("silver_count", F.coalesce("silver_count", F.lit(0))), max_loss_pct
    ).where(~F.col("acceptable")).select(
        F.lit("lost records").alias("issue_type"), F.col("content_type").alias("subject"),
        (F.col("bronze_count") - F.col("silver_count")).alias("affected_records"), F.col("bronze_count").alias("total_records"),
    )
    copies = duplicate_keys(bronze.where(F.col("id").isNotNull()), ["content_type", "id"]).groupBy("content_type").agg(
        F.sum(F.col("copies") - 1).alias("affected_records")
    ).join(read, "content_type").select(
        F.lit("duplicate ids").alias("issue_type"), F.col("content_type").alias("subject"), "affected_records",
        F.col("bronze_count").alias("total_records"),
    )
    per_row = {
        "null field": null_fields(silver, ["title", "url", "published_at", "news_site", "summary"]).select(F.col("field_name").alias("subject")),
        "odd date": suspicious_dates(silver, ingest_date).select(F.col("issue").alias("subject")),
        "site off the list": silver.where(~F.col("news_site_validated")).select(F.col("news_site").alias("subject")),
    }
    counted = [
        rows.groupBy("subject").agg(F.count(F.lit(1)).alias("affected_records"))
        .withColumns({"issue_type": F.lit(kind), "total_records": kept_total})
        for kind, rows in per_row.items()
    ]
    found = broken.select(*columns)
    for frame in (loss, copies, *counted):
        found = found.unionByName(frame.select(*columns))
    typed = found.withColumns({"affected_records": number("affected_records"), "total_records": number("total_records")})
    return quality_issues(typed).withColumns({"ingest_date": as_date(ingest_date), "checked_at": as_moment(now)})


def record_content_checks(
    state: DataFrame, now: dt.datetime | str | Column | None = None, ingest_date: AsOf = None, minimum: int = 100,
    records_failed: int | Column = 0,
) -> DataFrame:
    """Check rows ``daily_content_count``: PASS from ``minimum`` current rows a load day, failed without any, else WARNING.

    ``records_failed`` is how many records of the day were set aside.
    """
    lost = records_failed if isinstance(records_failed, Column) else F.lit(records_failed)
    return _opened_per_day(state, ingest_date, "n").select(
        F.concat_ws("-", F.lit("daily_content_count"), F.col("ingest_date").cast("string")).alias("check_id"),
        F.lit("daily_content_count").alias("check_name"),
        F.lit("row_count").alias("check_type"),
        F.lit("core.content_items").alias("target_table"),
        F.when(F.col("n") >= minimum, "PASS").when(F.col("n") == 0, "failed").otherwise("WARNING").alias("check_result"),
        F.col("n").cast("decimal(18,2)").alias("check_value"),
        F.lit(minimum).cast("decimal(18,2)").alias("threshold_value"),
        F.when(F.col("n") == 0, "no rows were loaded").alias("error_message"),
        lost.cast("bigint").alias("records_failed"),
        "ingest_date",
        as_moment(now).alias("checked_at"),
    )


def runs_view(runs: DataFrame) -> DataFrame:
    """Run table under the names the monitoring reports use."""
    return runs.select(
        F.col("ingest_date").alias("run_date"),
        F.col("run_type").alias("pipeline_name"),
        F.col("run_status").alias("status"),
        "records_processed",
        F.col("duration_seconds").alias("execution_time_seconds"),
        "error_message",
        "created_at",
    )


def checks_view(checks: DataFrame) -> DataFrame:
    """Check table under the names the monitoring reports use."""
    return checks.select(
        F.col("ingest_date").alias("check_date"),
        "check_name",
        "check_result",
        F.col("check_value").cast("bigint").alias("records_checked"),
        "records_failed",
        F.col("error_message").alias("error_details"),
        F.col("checked_at").alias("created_at"),
    )
