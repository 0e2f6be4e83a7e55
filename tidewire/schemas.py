"""Declared schemas: a column missing in a file is NULL, never an analysis error."""

from __future__ import annotations

from pyspark.sql import types as T

from tidewire.fixed_values import STAGING_COLUMNS


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


# Nested fields stay JSON text, whole; these are the keys that typed rows take from them.
RELATIONS = {
    "launches": T.StructType(_strings("launch_id", "provider", "id")),
    "events": T.StructType([T.StructField("event_id", T.LongType()), *_strings("provider", "id", "name")]),
    "authors": T.StructType(_strings("name")),
}

CORRUPT = "_corrupt_record"
LINE = "_line"  # the record as it was landed

# One schema for articles, blogs and reports; the types that lack a field simply carry NULL.
BRONZE_CONTENT = T.StructType(
    _strings("id", "title", "url", "image_url", "news_site", "summary", "published_at", "updated_at")
    + [T.StructField("featured", T.BooleanType())]
    + _strings(*RELATIONS)
)

BRONZE_INFO = T.StructType(_strings("version") + [T.StructField("news_sites", T.ArrayType(T.StringType()))])

EXTRACTION_META = T.StructType(
    _strings("endpoint", "run_id", "start_time", "end_time")
    + [T.StructField(n, T.LongType()) for n in ("records_downloaded", "valid_count", "invalid_count")]
    + [
        T.StructField(
            "pagination",
            T.StructType(
                [
                    T.StructField("endpoint", T.StringType()),
                    T.StructField("total_pages", T.LongType()),
                    T.StructField("total_results", T.LongType()),
                    T.StructField("page_size", T.LongType()),
                    T.StructField("has_more", T.BooleanType()),
                ]
            ),
        )
    ]
    + _strings("ingest_date")
)

QUARANTINE_REASONS = T.StructType(
    _strings("_error_reason", "content_type") + [T.StructField("ingest_date", T.DateType())]
)

CHECKED_KEYS = T.StructType(_strings("id", "content_type") + [T.StructField("ingest_date", T.DateType())])

SILVER_COLUMNS = [
    "id", "title", "url", "image_url", "news_site", "summary", "published_at", "updated_at", "featured",
    "launches", "events", "authors", "content_id", "content_type", "source_system", "ingest_date",
    "news_site_validated", "record_hash",
]

# The staging column order is also the gold order; the membership flag and the keywords as a list are kept at the end.
GOLD_COLUMNS = [*STAGING_COLUMNS, "news_site_validated", "keyword_list"]

CORE_COLUMNS = [
    "content_pk", "content_id", "content_type", "title", "url", "image_url", "news_site", "summary",
    "published_at", "updated_at", "published_year", "published_month", "published_day", "keywords", "entities",
    "topic_name", "authors_json", "launches_json", "events_json", "featured", "source_system", "ingest_date",
    "record_hash", "version", "valid_from", "valid_to", "is_current", "created_at", "updated_db_at", "keyword_list",
]

SITE_DIMENSION = T.StructType(
    [
        T.StructField("news_site_id", T.LongType()),
        T.StructField("news_site_name", T.StringType()),
        T.StructField("website_url", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("is_active", T.BooleanType()),
        T.StructField("first_seen_date", T.DateType()),
        T.StructField("last_seen_date", T.DateType()),
        T.StructField("total_content_count", T.LongType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)
