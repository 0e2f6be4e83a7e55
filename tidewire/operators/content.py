"""Bronze to silver to gold to typed core rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.fixed_values import ENTITY_NAMES, HASH_COLUMNS, SOURCE_SYSTEM, TOPIC_KEYWORDS
from tidewire.functions.clock import as_moment, parse_timestamp
from tidewire.functions.measures import cast_or_null, json_or_empty_list, percent, record_hash, text_flag
from tidewire.functions.text import TopicWords, enrich_text, split_list
from tidewire.operators.dedup import latest_by_url, latest_content
from tidewire.operators.validate import with_site_check
from tidewire.schemas import GOLD_COLUMNS, RELATIONS, SILVER_COLUMNS


def with_lineage(df: DataFrame, source_system: str = SOURCE_SYSTEM) -> DataFrame:
    """Source system and content key; ``content_type`` and ``ingest_date`` come from the folder."""
    return df.withColumns(
        {
            "source_system": F.lit(source_system),
            "ingest_date": F.col("ingest_date").cast("date"),
            "content_id": F.concat(F.col("content_type"), F.lit("_"), F.col("id").cast("string")),
        }
    )


def with_parsed_times(df: DataFrame, policy: str = "lenient") -> DataFrame:
    """Parsed times under the original names, the texts kept as ``*_original``."""
    return df.withColumnsRenamed(
        {"published_at": "published_at_original", "updated_at": "updated_at_original"}
    ).withColumns(
        {
            "published_at": parse_timestamp(F.col("published_at_original"), policy),
            "updated_at": parse_timestamp(F.col("updated_at_original"), policy),
        }
    )


def to_silver(
    valid: DataFrame, official_sites: DataFrame | None = None, policy: str = "lenient", unique_urls: bool = False,
    hash_columns: list[str] = HASH_COLUMNS, stored: bool = False,
) -> DataFrame:
    """Valid bronze rows to silver: parsed times, hash, one row per key, declared columns.

    ``stored``: the rows come straight from Parquet files, and copies are found without moving whole rows.

    ``unique_urls`` adds the second dedup pass, one row per address. Only a change of ``hash_columns`` opens a new
    version later; name more of them to keep edits of sites, images or flags as well.
    """
    parsed = with_parsed_times(valid, policy)
    keyed = with_lineage(parsed).withColumn("record_hash", record_hash(parsed, hash_columns))
    kept = keyed.select(*[c for c in SILVER_COLUMNS if c != "news_site_validated"])
    unique = latest_content(kept, stored)
    if unique_urls:
        unique = latest_by_url(unique)
    # The site list joins after the dedup: fewer rows to join, and the join adds no rows.
    return with_site_check(unique, official_sites).select(*SILVER_COLUMNS)


def enrich(
    silver: DataFrame, run_id: str, now: dt.datetime | str | Column | None = None,
    topics: TopicWords = TOPIC_KEYWORDS, entities: TopicWords = ENTITY_NAMES, match: str = "substring",
) -> DataFrame:
    """Silver to gold, without any shuffle: one projection over the scan."""
    enriched = enrich_text(silver, topics, entities, match)
    return enriched.withColumns(
        {
            "published_year": F.year("published_at"),
            "published_month": F.month("published_at"),
            "published_day": F.dayofmonth("published_at"),
            "authors_json": json_or_empty_list(silver, "authors"),
            "launches_json": json_or_empty_list(silver, "launches"),
            "events_json": json_or_empty_list(silver, "events"),
            "ingest_run_id": F.lit(run_id),
            "processed_at": as_moment(now),
        }
    ).select(*GOLD_COLUMNS)


def typed_staging(staged: DataFrame) -> DataFrame:
    """All-text staging rows to typed rows; unreadable values become NULL."""
    moments = ["published_at", "updated_at"]
    numbers = ["published_year", "published_month", "published_day"]
    typed = {c: cast_or_null(F.col(c), "timestamp") for c in moments}
    typed |= {c: cast_or_null(F.col(c), "int") for c in numbers}
    typed["featured"] = text_flag(F.col("featured"))
    typed["ingest_date"] = cast_or_null(F.col("ingest_date"), "date")
    return staged.withColumns(typed)


def union_types(frames: list[DataFrame]) -> DataFrame:
    """Rows of several types together; a column one of them lacks is NULL there."""
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame, allowMissingColumns=True)
    return combined.select(*sorted(combined.columns))


def relation_rows(silver: DataFrame, column: str) -> DataFrame:
    """One row per author, launch or event of a content item: its typed keys and the whole item as JSON text."""
    items = F.from_json(column, "array<string>")
    rows = silver.select("content_id", "content_type", F.posexplode(items).alias("position", "item_json"))
    return rows.withColumn("item", F.from_json("item_json", RELATIONS[column]))


def exploded_items(
    content: DataFrame, joined: str, item: str, keep: list[str], distinct: bool = True,
    min_length: int = 3,
) -> DataFrame:
    """One row per long enough list item of comma-joined text, with only the ``keep`` columns beside it.

    Keywords that the frame also holds as a list (``keyword_list``) are taken from there, and no text is split.
    With ``distinct`` an item counts once per content row, which is what a distinct count over
    the row key asks for, without shuffling the row keys.
    """
    stored = joined == "keywords" and "keyword_list" in content.columns
    items = F.col("keyword_list") if stored else split_list(F.col(joined))
    if distinct:
        items = F.array_distinct(items)
    rows = content.where(F.col("keyword_list" if stored else joined).isNotNull()).select(*keep, F.explode(items).alias(item))
    return rows.where(F.length(item) >= min_length)


def year_like_topics(gold: DataFrame, limit: int = 10) -> DataFrame:
    """Report of rows whose topic looks like a year (there should be none)."""
    wrong = gold.where(F.col("topic_name").rlike("^[0-9]{4}$"))
    return wrong.select("id", "topic_name", "published_year", "title").orderBy("id").limit(limit)


def top_topics(gold: DataFrame, limit: int = 5) -> DataFrame:
    counts = gold.groupBy("topic_name").agg(F.count(F.lit(1)).alias("content_count"))
    return counts.orderBy(F.desc("content_count"), "topic_name").limit(limit)


def entity_coverage(gold: DataFrame) -> DataFrame:
    """Rows that name at least one entity, in number and percent."""
    counted = gold.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("entities") != "").alias("with_entities"),
    )
    return counted.withColumn("coverage_pct", percent(F.col("with_entities"), F.col("total_records"), 1))
