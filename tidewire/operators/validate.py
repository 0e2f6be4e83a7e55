"""Record checks: the first broken rule names the reason, nothing is dropped silently."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.clock import AsOf, as_date, as_moment, parse_timestamp
from tidewire.functions.text import bound, is_web_address, normalize_url
from tidewire.schemas import LINE

REASON = "_error_reason"
MALFORMED = "Malformed record"


@dataclass(frozen=True)
class EndpointRules:
    required: tuple[str, ...]
    timestamps: tuple[str, ...] = ()
    urls: tuple[str, ...] = ()
    arrays: tuple[str, ...] = ()


_CONTENT = {
    "required": ("id", "title", "url", "published_at"),
    "timestamps": ("published_at", "updated_at"),
    "urls": ("url", "image_url"),
}

INGEST_RULES = {
    "articles": EndpointRules(**_CONTENT, arrays=("launches", "events", "authors")),
    "blogs": EndpointRules(**_CONTENT, arrays=("launches", "events")),
    "reports": EndpointRules(**_CONTENT),
    "info": EndpointRules(required=("version",), arrays=("news_sites",)),
}


def silver_reason(corrupt: str | None = None, timestamp_policy: str = "lenient") -> Column:
    """Reason under the silver policy: required fields present and not '', published_at readable."""
    rules = []
    if corrupt is not None:
        rules.append(F.when(F.col(corrupt).isNotNull(), F.lit(MALFORMED)))
    for field in ("id", "title", "url", "published_at"):
        text = F.col(field).cast("string")
        rules.append(F.when(text.isNull() | (text == ""), F.lit(f"Missing required field: {field}")))
    unreadable = parse_timestamp(F.col("published_at"), timestamp_policy).isNull()
    rules.append(F.when(unreadable, F.lit("Invalid timestamp format for published_at")))
    return F.coalesce(*rules)


def validate_record(
    df: DataFrame, corrupt: str | None = None, timestamp_policy: str = "lenient"
) -> tuple[DataFrame, DataFrame]:
    """Split into (valid, invalid); invalid rows carry the reason."""
    checked = df.withColumn(REASON, silver_reason(corrupt, timestamp_policy))
    valid = checked.where(F.col(REASON).isNull()).drop(REASON)
    invalid = checked.where(F.col(REASON).isNotNull()).withColumn("_is_valid", F.lit(False))
    return valid, invalid


def ingest_reason(endpoint: str, record: Column) -> Column:
    """Reason under the ingest policy for one raw JSON record held as a variant.

    Required fields may be '' here but not null; the JSON type of each field counts, so a
    number where a timestamp text belongs is as wrong as an unreadable text.
    """
    if endpoint not in INGEST_RULES:
        raise ValueError(f"Unknown endpoint: {endpoint}")
    rules = INGEST_RULES[endpoint]

    def given(field: str) -> Column:
        value = F.try_variant_get(record, f"$.{field}", "variant")
        return value.isNotNull() & ~F.is_variant_null(value)

    def json_type(field: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(record, f"$.{field}", "variant"))

    def text(field: str) -> Column:
        return F.try_variant_get(record, f"$.{field}", "string")

    def is_text(field: str) -> Column:
        return json_type(field) == "STRING"

    checks = [F.when(record.isNull(), F.lit(MALFORMED))]
    checks += [F.when(~given(f), F.lit(f"Missing required field: {f}")) for f in rules.required]
    for f in rules.timestamps:
        readable = is_text(f) & parse_timestamp(text(f), "strict").isNotNull()
        checks.append(F.when(given(f) & ~readable, F.lit(f"Invalid timestamp format for field: {f}")))
    for f in rules.urls:
        checks.append(F.when(given(f) & ~(is_text(f) & is_web_address(text(f))),
                             F.lit(f"Invalid URL format for field: {f}")))
    for f in rules.arrays:
        checks.append(F.when(given(f) & ~json_type(f).startswith("ARRAY"), F.lit(f"Field should be array: {f}")))
    return F.coalesce(*checks)


def validate_raw(lines: DataFrame, endpoint: str, line: str = "value") -> DataFrame:
    """Add ``_error_reason`` to a frame of raw JSON lines.

    Each line is parsed once, however many rules look at the record.
    """
    reason = bound(F.try_parse_json(F.col(line)), lambda record: ingest_reason(endpoint, record))
    return lines.withColumn(REASON, reason)


def validate_batch(
    lines: DataFrame, endpoint: str, now: dt.datetime | str | Column | None = None, line: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Raw lines split into (valid, invalid with reason and check time)."""
    checked = validate_raw(lines, endpoint, line)
    valid = checked.where(F.col(REASON).isNull()).drop(REASON)
    invalid = checked.where(F.col(REASON).isNotNull()).withColumn("_validation_timestamp", as_moment(now))
    return valid, invalid


def validation_totals(checked: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Total, valid and invalid records, optionally per group."""
    return checked.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col(REASON).isNull()).alias("valid_count"),
        F.count_if(F.col(REASON).isNotNull()).alias("invalid_count"),
    )


def to_quarantine(invalid: DataFrame, now: dt.datetime | str | Column | None = None) -> DataFrame:
    """Add when a record was set aside and the record as it was landed; frames without lines give their columns as JSON."""
    stamped = invalid.withColumn("quarantine_timestamp", as_moment(now))
    if LINE in invalid.columns:
        return stamped.withColumnRenamed(LINE, "raw_payload")
    return stamped.withColumn("raw_payload", F.to_json(F.struct("*")))


def with_site_check(df: DataFrame, official_sites: DataFrame | None) -> DataFrame:
    """Flag whether ``news_site`` is on the official list (one ``news_site`` column).

    NULL when there is no list. A site off the list is only flagged, never set aside. The list
    joins as a distinct set, so it cannot multiply rows; the engine broadcasts it when its
    size allows and shuffles otherwise.
    """
    if official_sites is None:
        return df.withColumn("news_site_validated", F.lit(None).cast("boolean"))
    listed = (
        official_sites.where(F.col("news_site").isNotNull())
        .select(F.col("news_site").alias("_site")).distinct().withColumn("_listed", F.lit(True))
    )
    any_listed = listed.select(F.count(F.lit(1)) > 0).scalar()
    flag = F.when(any_listed, F.coalesce(F.col("_listed"), F.lit(False)))
    return (
        df.join(listed, F.col("news_site") == F.col("_site"), "left")
        .withColumn("news_site_validated", flag)
        .drop("_site", "_listed")
    )


def normalize_content(df: DataFrame) -> DataFrame:
    """Trim title, news_site and summary; lower-case the URL's scheme and host."""
    return df.withColumns(
        {
            "title": F.trim("title"),
            "news_site": F.trim("news_site"),
            "summary": F.trim("summary"),
            "url": normalize_url(F.col("url")),
        }
    )


def content_flags(
    df: DataFrame, as_of: AsOf = None, max_title: int = 500, min_summary: int = 10, oldest_year: int = 2000
) -> DataFrame:
    """Flag long titles, short summaries, future dates and very old dates (``published_at`` parsed)."""
    day = F.to_date("published_at")
    return df.withColumns(
        {
            "title_too_long": F.coalesce(F.length("title") > max_title, F.lit(False)),
            "summary_too_short": F.coalesce(F.length("summary") < min_summary, F.lit(False)),
            "future_date": F.coalesce(day > as_date(as_of), F.lit(False)),
            "very_old_date": F.coalesce(F.year(day) < oldest_year, F.lit(False)),
        }
    )
