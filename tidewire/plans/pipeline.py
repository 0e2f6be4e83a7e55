"""The batch jobs: bronze -> silver -> gold -> trends and core -> run records and insights.

Each job reads written layers and writes one layer, so a lost executor or a failed job costs at
most one layer. Every write replaces just the load dates it was asked for.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.fixed_values import ENTITY_NAMES, HASH_COLUMNS, SITE_ACTIVITY_COLUMNS, STAGING_COLUMNS, TOPIC_KEYWORDS, TOPIC_TREND_COLUMNS
from tidewire.functions.text import TopicWords, split_list
from tidewire.operators.content import enrich, to_silver, typed_staging
from tidewire.operators.dimensions import topic_dimension, upsert_sites
from tidewire.operators.insights import daily_insights
from tidewire.operators.quality import failed_run, issue_rows, record_content_checks, record_runs
from tidewire.operators.trends import site_activity, topic_trends, typed_aggregate
from tidewire.operators.validate import REASON, normalize_content, silver_reason, to_quarantine
from tidewire.plans.changes import changes_job
from tidewire.plans.sketches import SKETCHES, sketches_job
from tidewire.schemas import CHECKED_KEYS, CORE_COLUMNS, CORRUPT, LINE, QUARANTINE_REASONS, SITE_DIMENSION
from tidewire.session import materialized, path_exists, remove
from tidewire.sources import bronze
from tidewire.sources.tables import (
    CoreDimension, CoreTable, Lake, read_partitions, read_staging_csv, replace_dates, write_csv, write_dates, write_with_stats,
)

CHECKED = "checked"


def clean_job(
    spark: SparkSession, lake: Lake, ingest_dates: list[str], quarantine: str = "quarantine",
    normalize: bool = False, unique_urls: bool = False, hash_columns: list[str] = HASH_COLUMNS,
) -> dict:
    """Validate, set aside, de-duplicate. Landed records are parsed and checked once, into a table parted by validity;
    silver and quarantine are both made from it, and so are the day's quality rows later.

    ``normalize`` trims texts and lower-cases hosts first; ``unique_urls`` also removes copies by address.
    """
    raw = bronze.read_content(spark, lake.bronze, ingest_dates)
    if normalize:
        raw = normalize_content(raw)
    info = bronze.read_info(spark, lake.bronze, ingest_dates)
    # Written, so that its size is known: a short list is broadcast and the records stay where they are.
    sites = materialized(spark, bronze.official_sites(info), "sites")
    replace_dates(bronze.api_metadata(info), lake.silver("api_metadata"), ingest_dates)

    reason = F.col(REASON)
    judged = raw.withColumn(REASON, silver_reason(CORRUPT)).withColumns({
        "is_valid": reason.isNull(), LINE: F.when(reason.isNotNull(), F.col(LINE)),  # only what is set aside keeps its line
    })
    drop_checked(spark, lake, ingest_dates)
    counts = write_with_stats(
        judged, lake.silver(CHECKED), partition_by=["ingest_date", "is_valid", "content_type"],
        metrics={"valid": F.count_if("is_valid")},
    )
    read = read_partitions(spark, lake.silver(CHECKED), ingest_dates, judged.schema)
    valid = read.where("is_valid").drop(REASON, CORRUPT, LINE, "is_valid")
    silver = to_silver(valid, sites, unique_urls=unique_urls, hash_columns=hash_columns, stored=True)
    written = write_dates(silver, lake.silver(), ingest_dates)
    invalid_count = counts["records"] - (counts["valid"] or 0)
    if invalid_count or path_exists(spark, lake.silver(quarantine)):
        invalid = read.where("NOT is_valid").withColumnRenamed("is_valid", "_is_valid")
        write_dates(to_quarantine(invalid), lake.silver(quarantine), ingest_dates)
    return {
        "initial_count": counts["records"],
        "valid_count": counts["valid"] or 0,
        "invalid_count": invalid_count,
        "deduplicated_count": written["records"],
        "duplicates_removed": (counts["valid"] or 0) - written["records"],
    }


def drop_checked(spark: SparkSession, lake: Lake, ingest_dates: list[str]) -> None:
    """Remove the checked records of these dates, which only the day's jobs need."""
    for day in ingest_dates:
        remove(spark, f"{lake.silver(CHECKED)}/ingest_date={day}")


def enrich_job(
    spark: SparkSession, lake: Lake, ingest_dates: list[str], run_id: str, csv: bool = False,
    topics: TopicWords = TOPIC_KEYWORDS, entities: TopicWords = ENTITY_NAMES,
) -> dict:
    """Silver to gold, with the rows' entity coverage observed on the way."""
    silver = read_partitions(spark, lake.silver(), ingest_dates)
    gold = enrich(silver, run_id, topics=topics, entities=entities)
    stats = write_dates(
        gold, lake.gold(), ingest_dates, sort_within=["content_type", "ingest_date", "published_at"],
        metrics={
            "with_entities": F.count_if(F.col("entities") != ""),
            "year_like_topics": F.count_if(F.col("topic_name").rlike("^[0-9]{4}$")),
        },
    )
    if csv:
        for day in ingest_dates:
            written = read_partitions(spark, lake.gold(), [day])
            write_csv(written.select(*STAGING_COLUMNS), f"{lake.gold('content_enriched_csv')}/{day}")
    return stats


def trends_job(spark: SparkSession, lake: Lake, ingest_date: str, csv: bool = False, whole_history: bool = False) -> dict:
    """Monthly aggregates of one load date, or of all loaded rows under that date."""
    gold = read_partitions(spark, lake.gold(), None if whole_history else [ingest_date])
    counts = {}
    for table, frame, columns in (
        ("topic_counts", topic_trends(gold, ingest_date), TOPIC_TREND_COLUMNS),
        ("source_activity", site_activity(gold, ingest_date), SITE_ACTIVITY_COLUMNS),
    ):
        path = lake.gold(f"trends/{table}")
        counts[table] = replace_dates(frame, path, [ingest_date])["records"]
        if csv:
            rows = read_partitions(spark, path, [ingest_date])
            write_csv(rows.select(*columns), f"{lake.gold(f'trends/{table}_csv')}/{ingest_date}")
    return counts


def core_batch(gold: DataFrame) -> DataFrame:
    """Gold rows with the core table's columns, texts whole."""
    return gold.select(*[c for c in CORE_COLUMNS if c in gold.columns])


def staged_batch(spark: SparkSession, csv_path: str) -> DataFrame:
    """The same batch read from staging CSV files."""
    typed = typed_staging(read_staging_csv(spark, csv_path))
    typed = typed.withColumn("keyword_list", F.filter(split_list(F.col("keywords")), lambda word: word != ""))
    return typed.select(*[c for c in CORE_COLUMNS if c in typed.columns])


def opened_at(ingest_date: str) -> str:
    return f"{ingest_date} 00:00:00"


def load_core_job(
    spark: SparkSession, lake: Lake, ingest_date: str, now: str, from_csv: bool = False, buckets: int | None = 8
) -> dict:
    """Merge a load date into the versioned table and refresh the dimensions.

    Dates that were loaded after this one are merged again on top of it, from their gold rows.
    """

    def batch_of(day: str) -> DataFrame:
        if from_csv:
            return staged_batch(spark, f"{lake.gold('content_enriched_csv')}/{day}")
        return core_batch(read_partitions(spark, lake.gold(), [day]))

    core = CoreTable(spark, lake.core(), buckets)
    counts = core.load(
        batch_of(ingest_date), ingest_date, now, latest_by="updated_at", replay=lambda day: (batch_of(day), opened_at(day)),
        stored=not from_csv,
    )

    # Dimensions are published per load date like the core table, so a repeated load starts
    # from the dimension as it was before that date.
    sites = CoreDimension(spark, lake.core("ref_news_sites"))
    for day in [d for d in core.snapshots() if d >= ingest_date]:
        known = sites.latest(before=day)
        if known is None:
            known = spark.createDataFrame([], SITE_DIMENSION)
        sites.publish(upsert_sites(known, batch_of(day), now if day == ingest_date else opened_at(day)), day)
    topics = CoreDimension(spark, lake.core("ref_topics"))
    topics.publish(topic_dimension(core.current(), now), core.snapshots()[-1])
    return counts


def load_aggregates_job(spark: SparkSession, lake: Lake, ingest_date: str, from_csv: bool = False) -> dict:
    """Gold aggregates, or their staged CSV, to the core aggregate tables; a load date replaces itself."""
    counts = {}
    for source, target, dimension, columns in (
        ("topic_counts", "agg_topic_monthly_trends", "topic_name", TOPIC_TREND_COLUMNS),
        ("source_activity", "agg_news_site_monthly_activity", "news_site", SITE_ACTIVITY_COLUMNS),
    ):
        if from_csv:
            staged = read_staging_csv(spark, f"{lake.gold(f'trends/{source}_csv')}/{ingest_date}", columns)
        else:
            staged = read_partitions(spark, lake.gold(f"trends/{source}"), [ingest_date]).select(
                *[F.col(c).cast("string") for c in columns]
            )
        counts[target] = replace_dates(typed_aggregate(staged, dimension), lake.core(target), [ingest_date])["records"]
    return counts


def quality_job(spark: SparkSession, lake: Lake, ingest_date: str, now: str) -> dict:
    """The load date's quality issues, from its checked, silver and quarantine rows; ``clean_job`` comes before it."""
    raw = read_partitions(spark, lake.silver(CHECKED), [ingest_date], CHECKED_KEYS)
    silver = read_partitions(spark, lake.silver(), [ingest_date])
    aside = read_partitions(spark, lake.silver("quarantine"), [ingest_date], QUARANTINE_REASONS)
    found = issue_rows(raw, silver, aside, ingest_date, now)
    return replace_dates(found, lake.core("meta_quality_issues"), [ingest_date])


def summary_job(spark: SparkSession, lake: Lake, ingest_date: str, buckets: int | None = 8) -> dict:
    """The changes that the load of a date made to the daily summary and to the keyword tables, its sketches, and those of
    the dates loaded after it, which were merged again on top of it."""
    core = CoreTable(spark, lake.core(), buckets)
    days = [day for day in core.snapshots() if day >= ingest_date]
    return {**changes_job(spark, lake, days, buckets), SKETCHES: sketches_job(spark, lake, days, buckets)}


def metadata_job(
    spark: SparkSession, lake: Lake, ingest_date: str, started_at: str, completed_at: str, records_failed: int = 0
) -> None:
    """Run row and content-count check of a load date."""
    state = CoreTable(spark, lake.core()).state()
    failed = spark.range(1).select(
        F.lit(ingest_date).cast("date").alias("ingest_date"), F.lit(records_failed).cast("bigint").alias("records_failed")
    )
    replace_dates(
        record_runs(state, completed_at, started_at, failed, ingest_date=ingest_date), lake.core("meta_pipeline_runs"), [ingest_date]
    )
    replace_dates(
        record_content_checks(state, completed_at, ingest_date=ingest_date, records_failed=records_failed),
        lake.core("meta_data_quality_checks"), [ingest_date],
    )


def insights_job(spark: SparkSession, lake: Lake, ingest_date: str) -> None:
    """The day's insight record as JSON."""
    state = CoreTable(spark, lake.core()).state()
    trends = read_partitions(spark, lake.core("agg_topic_monthly_trends"), [ingest_date])
    activity = read_partitions(spark, lake.core("agg_news_site_monthly_activity"), [ingest_date])
    daily_insights(state, trends, activity, ingest_date).write.mode("overwrite").json(f"{lake.insights}/{ingest_date}")


def _now() -> str:
    return str(dt.datetime.now(dt.UTC).replace(tzinfo=None))


def run_day(
    spark: SparkSession, lake: Lake, ingest_date: str, run_id: str | None = None, buckets: int | None = 8, csv: bool = False,
    keep_slices: int = 2,
) -> dict:
    """All jobs of one load date, in order. Running a date again leaves the tables as they were.

    A date that breaks off gets a failed run row before the error goes on. ``csv`` also writes staging files, and the
    aggregates are then loaded from these. Current slices but the newest ``keep_slices`` expire; dates before those
    cannot be loaded anew, so keep as many as corrections may go back (0: all).
    """
    started = _now()
    try:
        stats = {"clean": clean_job(spark, lake, [ingest_date])}
        stats["enrich"] = enrich_job(spark, lake, [ingest_date], run_id or f"enrich_{ingest_date}", csv=csv)
        stats["trends"] = trends_job(spark, lake, ingest_date, csv=csv)
        stats["core"] = load_core_job(spark, lake, ingest_date, opened_at(ingest_date), buckets=buckets)
        stats["aggregates"] = load_aggregates_job(spark, lake, ingest_date, from_csv=csv)
        stats["quality"] = quality_job(spark, lake, ingest_date, started)
        drop_checked(spark, lake, [ingest_date])
        stats["summary"] = summary_job(spark, lake, ingest_date, buckets)
        metadata_job(spark, lake, ingest_date, started, _now(), stats["clean"]["invalid_count"])
        insights_job(spark, lake, ingest_date)
    except Exception as error:
        broken = failed_run(spark, f"{type(error).__name__}: {error}"[:2000], _now(), started, ingest_date)
        replace_dates(broken, lake.core("meta_pipeline_runs"), [ingest_date])
        raise
    if keep_slices:
        CoreTable(spark, lake.core(), buckets).expire_slices(keep_slices)
    return stats


def backfill(spark: SparkSession, lake: Lake, ingest_dates: list[str], buckets: int | None = 8, keep_slices: int = 0) -> dict:
    """Several load dates, oldest first. Dates loaded already that lie after one of them are merged again after it."""
    days = sorted(ingest_dates)
    return {day: run_day(spark, lake, day, buckets=buckets, keep_slices=keep_slices) for day in days}
