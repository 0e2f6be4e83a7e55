"""Ratios, shares, growth, scores and labels used by the reports."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.fixed_values import HASH_COLUMNS, NOISE_TOPICS


def rounded_ratio(part: Column, whole: Column, digits: int = 2, scale: int = 1) -> Column:
    """``scale * part / whole`` rounded half up; NULL for a zero or NULL whole.

    The division is decimal, so a value such as 2.675 rounds as written and not as its
    nearest double. Meant for integer counts and sums, i.e. for already aggregated rows.
    """
    whole_exact = F.nullif(whole.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    part_exact = part.cast("decimal(20,0)") * F.lit(Decimal(scale))
    return F.round(part_exact / whole_exact, digits).cast("double")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return rounded_ratio(part, whole, digits, scale=100)


def growth_percent(now: Column, before: Column) -> Column:
    """Change in percent; NULL when there is no earlier value or it is zero."""
    return percent(now - before, before)


def with_share(df: DataFrame, count: str, share: str, within: list[str] | None = None) -> DataFrame:
    """Add each row's percentage of the total, or of its ``within`` group.

    Call it on aggregated rows only: without ``within`` the window holds the whole frame.
    """
    total = F.sum(count).over(Window.partitionBy(*(within or [])))
    return df.withColumn(share, percent(F.col(count), total))


def named_topic(topic: str = "topic_name") -> Column:
    """A topic is given and is not one of the year values that leaked into the column."""
    return F.col(topic).isNotNull() & ~F.col(topic).isin(NOISE_TOPICS)


def activity_level(count: Column, very_high: int = 100, high: int = 50, medium: int = 20) -> Column:
    return (
        F.when(count >= very_high, "Very High").when(count >= high, "High").when(count >= medium, "Medium")
        .otherwise("Low")
    )


def freshness_status(days: Column, stale_after: int = 2, aging_after: int = 1) -> Column:
    return (
        F.when(days > stale_after, "ALERT: Stale Data").when(days > aging_after, "WARNING: Data Aging")
        .otherwise("OK")
    )


def anomaly_status(z_score: Column, anomaly: float = 2.0, warning: float = 1.5) -> Column:
    distance = F.abs(z_score)
    return F.when(distance > anomaly, "ANOMALY").when(distance > warning, "WARNING").otherwise("NORMAL")


def reliability_score(
    consistency_pct: Column, topics: Column, days_since: Column,
    weights: tuple[str, str, str] = ("0.4", "0.3", "0.3"),
) -> Column:
    """0..100 from consistency, topic coverage (full at ten topics) and freshness (gone after ten days)."""
    consistency_w, coverage_w, freshness_w = (F.lit(Decimal(w)) for w in weights)
    coverage = F.least(topics.cast("int") * 10, F.lit(100))
    freshness = F.greatest(100 - days_since.cast("int") * 10, F.lit(0))
    score = (
        consistency_pct.cast("decimal(9,2)") * consistency_w
        + coverage.cast("decimal(9,0)") * coverage_w
        + freshness.cast("decimal(9,0)") * freshness_w
    )
    return F.round(score, 2).cast("double")


def record_hash(df: DataFrame, columns: list[str] = HASH_COLUMNS) -> Column:
    """SHA-256 over the given columns that exist, NULL written as the word NULL."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns if c in df.columns]
    return F.sha2(F.concat_ws("||", *parts), 256)


def json_or_empty_list(df: DataFrame, column: str) -> Column:
    """JSON text of a nested column, '[]' when it is NULL or absent. A text column holds the JSON already."""
    if column not in df.columns:
        return F.lit("[]")
    if dict(df.dtypes)[column] == "string":
        return F.coalesce(F.col(column), F.lit("[]"))
    return F.coalesce(F.to_json(F.col(column)), F.lit("[]"))


def text_flag(text: Column) -> Column:
    """Boolean from staging text: True, true and 1 are true, all else (also NULL) is false."""
    return F.coalesce(text.isin("True", "true", "1"), F.lit(False))


def cast_or_null(text: Column, to: str) -> Column:
    """Typed value of staging text; '' and unreadable text give NULL."""
    return F.nullif(text, F.lit("")).try_cast(to)


def run_identifier(day: Column, moment: Column) -> Column:
    """``date-`` followed by eight hex characters that depend on date and moment."""
    day_text = day.cast("string")
    return F.concat(day_text, F.lit("-"), F.substring(F.md5(F.concat(day_text, moment.cast("string"))), 1, 8))
