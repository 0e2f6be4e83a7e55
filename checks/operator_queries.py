"""One callable per operator: sources and sinks, validation, text, history, dimensions, quality, streams.

Queries that test a sink write the whole derived table below the shared folder and return what
a reader gets back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import adapters as A
from tidewire.fixed_values import ENTITY_NAMES, TOPIC_KEYWORDS, TOPIC_TREND_COLUMNS
from tidewire.functions.clock import month_label, month_start, parse_timestamp
from tidewire.functions.measures import json_or_empty_list, record_hash
from tidewire.functions.text import (
    enrich_text, analysis_text, entity_records, positive_topics, register_sql_functions, tokenize, topic_scores,
)
from tidewire.operators import content as C
from tidewire.operators import dedup, dimensions, quality, scd2, trends, validate
from tidewire.operators.insights import daily_insights
from tidewire.plans import changes, monitoring, pipeline, sketches
from tidewire.schemas import CORRUPT, RELATIONS, SITE_DIMENSION
from tidewire.session import configure, materialized, path_exists, scratch_path
from tidewire.sources import bronze, tables
from tidewire.streaming import incremental, stateful

META_START, META_END = "2024-07-01T00:00:00", "2024-07-01T00:10:00"
BOTH = ["content_type", "ingest_date"]


# --- sources and sinks ------------------------------------------------------------------------


def landed_bronze(spark: SparkSession, sf_dir: str) -> str:
    """Documents as JSON Lines below a new folder, one folder per type; returns the root."""
    root = scratch_path(spark, "bronze")
    records = A.documents_bronze(spark, sf_dir)
    nested = {c: F.parse_json(F.col(c)) for c in RELATIONS}
    line = F.to_json(F.struct(*[c for c in records.columns if c not in ("content_type", "ingest_date")]))
    lines = records.withColumns(nested).select("content_type", "ingest_date", line.alias("value"))
    for kind in ("articles", "blogs", "reports"):
        bronze.land_lines(lines.where(F.col("content_type") == kind), root, kind)
    return root


def bronze_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = bronze.read_content(spark, landed_bronze(spark, sf_dir), [A.DOC_AS_OF])
    return records.select(
        "id", "content_type", "title", "url", "image_url", "news_site", "published_at", "updated_at", "featured",
        F.md5(F.col("summary")).alias("summary_md5"),
        *[json_or_empty_list(records, c).alias(f"{c}_json") for c in RELATIONS],
        "ingest_date",
    )


def missing_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All types are asked for and one has never been landed: the others are read, none fails."""
    root = scratch_path(spark, "bronze")
    records = A.documents_bronze(spark, sf_dir).select("id", "content_type", "ingest_date")
    for kind in ("articles", "blogs"):
        bronze.land_records(records.where(F.col("content_type") == kind).drop("content_type"), root, kind)
    return bronze.read_content(spark, root, [A.DOC_AS_OF]).groupBy("content_type").agg(F.count(F.lit(1)).alias("records"))


def info_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Info records (one per source) landed as JSON, read, flattened and counted back."""
    root = scratch_path(spark, "info")
    sources = A.table(spark, sf_dir, "documents").select("source").distinct()
    info = sources.select(
        F.lit("4.0").alias("version"), F.array("source").alias("news_sites"),
        F.lit(A.DOC_AS_OF).cast("date").alias("ingest_date"),
    )
    bronze.land_records(info, root, "info")
    return bronze.official_sites(bronze.read_info(spark, root, [A.DOC_AS_OF]))


def api_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = A.table(spark, sf_dir, "documents").select("source", "lang").distinct()
    info = sources.select(
        F.col("lang").alias("version"), F.array("source", F.upper("source")).alias("news_sites"),
        F.lit(A.DOC_AS_OF).cast("date").alias("ingest_date"),
    )
    found = bronze.api_metadata(info, A.FIXED_NOW)
    return found.withColumn("news_sites_list", F.concat_ws(",", "news_sites_list"))


def parquet_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written by type and load year in one job, later years read back by partition."""
    path = scratch_path(spark, "partitions")
    rows = A.orders_content(spark, sf_dir).withColumn("load_year", F.year("ingest_date"))
    tables.write_with_stats(
        rows.select("content_id", "content_type", "published_at", "load_year"), path,
        partition_by=["content_type", "load_year"], sort_within=["content_type", "load_year", "published_at"],
        rebalance=True,
    )
    back = tables.read_partitions(spark, path).where(F.col("load_year") >= 1998)
    return back.groupBy("content_type", "load_year").agg(
        F.count(F.lit(1)).alias("content_count"), F.min("published_at").alias("earliest")
    )


def write_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts observed during the write next to the counts read back afterwards."""
    path = scratch_path(spark, "stats")
    rows = A.orders_content(spark, sf_dir)
    seen = tables.write_with_stats(rows, path, format="json", metrics={"featured": F.count_if("featured")})
    back = spark.read.schema(rows.schema).json(path)
    return back.agg(
        F.count(F.lit(1)).alias("records_read"),
        F.count_if("featured").alias("featured_read"),
        F.lit(seen["records"]).cast("bigint").alias("records_observed"),
        F.lit(seen["featured"]).cast("bigint").alias("featured_observed"),
        F.lit(seen["columns"]).alias("column_count"),
    )


def staging_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold to CSV, CSV to all-text staging, staging to typed rows."""
    path = scratch_path(spark, "csv")
    gold = A.documents_gold(spark, sf_dir).select(*tables.STAGING_COLUMNS)
    tables.write_csv(gold, path)
    typed = C.typed_staging(tables.read_staging_csv(spark, path))
    return typed.select(
        "id", "content_id", "content_type", "title", "url", "news_site", "published_at", "updated_at", "featured",
        "topic_name", "entities", "published_year", "published_month", "published_day", "authors_json", "launches_json",
        "events_json", "image_url", "ingest_date", "ingest_run_id", "record_hash", F.md5("summary").alias("summary_md5"), F.md5("keywords").alias("keywords_md5"),
    )


def aggregate_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "trends-csv")
    tables.write_csv(A.order_trends(spark, sf_dir), path)
    staged = tables.read_staging_csv(spark, path, TOPIC_TREND_COLUMNS)
    return trends.typed_aggregate(staged, "topic_name").drop("calculated_at")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw JSON text with faults of type as well: numbers and texts where others belong."""
    doc = F.col("id").cast("bigint")
    record = F.struct(
        F.when(doc % 53 != 0, doc).alias("id"),
        "title", "url",
        F.when(doc % 47 == 0, "ftp://img").otherwise(F.col("image_url")).alias("image_url"),
        "news_site", "summary",
        F.regexp_replace("published_at", "T00:", "T00.").alias("published_at"),
        "updated_at", "featured",
    )
    plain = F.to_json(record)
    launches = F.when(doc % 59 == 0, '"none"').when(doc % 3 == 0, "[]").otherwise('[{"launch_id":"a"}]')
    with_launches = F.concat(F.expr("left(line, length(line) - 1)"), F.lit(',"launches":'), launches, F.lit("}"))
    rows = A.documents_bronze(spark, sf_dir).withColumn("line", plain)
    line = F.when(doc % 61 == 0, F.concat(F.lit("<broken>"), "id")).otherwise(with_launches)
    return rows.select("id", "content_type", "ingest_date", line.alias("value"))


def checked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw line checked under the rules of its own endpoint."""
    lines = raw_lines(spark, sf_dir)
    parts = [
        validate.validate_raw(lines.where(F.col("content_type") == kind), kind)
        for kind in ("articles", "blogs", "reports")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def land_valid_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid raw lines landed as they are, then read as lines again."""
    root = scratch_path(spark, "landed")
    lines = raw_lines(spark, sf_dir)
    for kind in ("articles", "blogs", "reports"):
        valid, _ = validate.validate_batch(lines.where(F.col("content_type") == kind), kind, A.FIXED_NOW)
        bronze.land_lines(valid, root, kind)
    back = None
    for kind in ("articles", "blogs", "reports"):
        part = bronze.read_lines(spark, root, kind, [A.DOC_AS_OF]).withColumn("endpoint", F.lit(kind))
        back = part if back is None else back.unionByName(part)
    return back.groupBy("endpoint").agg(F.count(F.lit(1)).alias("records"))


def _metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = checked_lines(spark, sf_dir).withColumnRenamed("content_type", "endpoint")
    return bronze.extraction_metadata(checked, "run", META_START, META_END)


def extraction_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _metadata(spark, sf_dir)
    return found.select(
        *[c for c in found.columns if c != "pagination"], "pagination.total_pages", "pagination.total_results"
    )


def list_extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "meta")
    bronze.write_extraction_metadata(_metadata(spark, sf_dir), root)
    return bronze.list_extractions(spark, root).select("endpoint", "records")


def check_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = landed_bronze(spark, sf_dir)
    return bronze.check_extraction(spark, root, A.DOC_AS_OF).select("endpoint", "records", "status")


def incremental_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = C.with_parsed_times(A.documents_bronze(spark, sf_dir))
    return bronze.incremental(parsed, since="2024-03-01", updated_after="2024-04-15").select(
        "id", "content_type", "published_at", "updated_at"
    )


# --- validation ---------------------------------------------------------------------------------


def silver_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = A.documents_bronze(spark, sf_dir).withColumn("reason", validate.silver_reason())
    return checked.select("id", "content_type", F.col("reason").isNull().alias("is_valid"), "reason")


def ingest_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_lines(spark, sf_dir).select("id", F.col("_error_reason").alias("reason"))


def batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validation_totals(checked_lines(spark, sf_dir), ["content_type"])


def site_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = A.documents_silver(spark, sf_dir, A.english_sites(spark, sf_dir))
    return silver.groupBy("news_site", "news_site_validated").agg(F.count(F.lit(1)).alias("record_count"))


def timestamp_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times written in ten ways, read under both policies."""
    events = A.table(spark, sf_dir, "events")
    form = F.col("event_id") % 10
    moment = F.col("ts").cast("timestamp")

    def shaped(pattern: str):
        return F.date_format(moment, pattern)

    text = (
        F.when(form == 0, shaped("yyyy-MM-dd'T'HH:mm:ss'Z'")).when(form == 1, shaped("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(form == 2, shaped("yyyy-MM-dd'T'HH:mm:ss.SSS")).when(form == 3, shaped("yyyy-MM-dd"))
        .when(form == 4, F.concat(shaped("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
        .when(form == 5, shaped("yyyy-MM-dd HH:mm:ss")).when(form == 6, shaped("yyyy-MM-dd'T'HH:mm:ss"))
        .when(form == 7, F.concat(shaped("yyyy"), F.lit("-02-30T00:00:00Z"))).when(form == 8, shaped("HH:mm"))
        .otherwise(F.lit(""))
    )
    return events.select("event_id", text.alias("text")).select(
        "event_id", "text", parse_timestamp(F.col("text")).alias("lenient"),
        parse_timestamp(F.col("text"), "strict").alias("strict"),
    )


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invalid landed lines set aside as Parquet and read back; the payload is looked into by JSON path."""
    path = scratch_path(spark, "quarantine")
    _, invalid = validate.validate_record(bronze.read_content(spark, landed_bronze(spark, sf_dir)), CORRUPT)
    tables.write_with_stats(validate.to_quarantine(invalid, A.FIXED_NOW), path, "append", partition_by=BOTH)
    back = spark.read.parquet(path)
    return back.select(
        "id", F.col("content_type"), "_is_valid", "_error_reason", "quarantine_timestamp",
        F.get_json_object("raw_payload", "$.url").alias("payload_url"),
        F.get_json_object("raw_payload", "$.launches[0].status.code").alias("payload_code"),
    )


def year_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their year for a topic: the report must find them."""
    rows = A.orders_content(spark, sf_dir).select(
        F.col("content_id").alias("id"), "title", F.year("published_at").alias("published_year"),
        F.when(F.col("featured"), F.date_format("published_at", "yyyy")).otherwise(F.col("topic_name")).alias("topic_name"),
    )
    return C.year_like_topics(rows)


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = A.table(spark, sf_dir, "pages")
    messy = pages.select(
        F.col("page_id").alias("id"),
        F.concat(F.lit("  Page "), F.col("page_id").cast("string"), F.lit(" ")).alias("title"),
        F.concat(F.lit(" "), F.split_part("url", F.lit("/"), F.lit(3))).alias("news_site"),
        F.lit(" short ").alias("summary"),
        F.upper("url").alias("url"),
    )
    return validate.normalize_content(messy)


def quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.with_parsed_times(A.documents_bronze(spark, sf_dir)).withColumn("title", F.col("summary"))
    flagged = validate.content_flags(rows, "2024-05-01", min_summary=200)
    return flagged.select("id", "title_too_long", "summary_too_short", "future_date", "very_old_date")


# --- dedup, union, sets -------------------------------------------------------------------------


def dedup_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.deduplicate_by_key(
        A.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate",
        tie_breaks=["l_partkey", "l_suppkey", "l_extendedprice"],
    ).select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")


def dedup_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earliest event per user and type."""
    return dedup.deduplicate_by_key(
        A.table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", ascending=True, tie_breaks=["event_id"]
    ).select("user_id", "event_type", "event_id", "ts")


def dedup_stored_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest line item of each order, elected by place without moving rows."""
    return dedup.deduplicate_stored(
        A.table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_shipdate",
        tie_breaks=["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"],
    ).select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")


def dedup_stored_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.deduplicate_stored(
        A.table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", ascending=True, tie_breaks=["event_id"]
    ).select("user_id", "event_type", "event_id", "ts")


def dedup_by_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events addressed by user and type as URL; the second dedup pass keeps the latest per address."""
    rows = A.table(spark, sf_dir, "events").select(
        F.concat(F.lit("https://e.example.com/"), "event_type", F.lit("/"), F.col("user_id").cast("string")).alias("url"),
        F.col("ts").cast("timestamp").alias("updated_at"),
        F.col("ts").cast("timestamp").alias("published_at"),
        F.col("event_id").cast("string").alias("record_hash"),
    )
    return dedup.latest_by_url(rows).select("url", "updated_at", "record_hash")


def union_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and events as two types with different columns, in one table."""
    orders = A.orders_content(spark, sf_dir).select("content_id", "content_type", "title", "featured")
    events = A.events_content(spark, sf_dir).select("content_id", "content_type", "news_site", "featured")
    return C.union_types([orders, events])


def except_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites of the later load that the dimension of the earlier load lacks, on exact rows and on the key."""
    early, late = _site_batches(spark, sf_dir)
    empty = spark.createDataFrame([], SITE_DIMENSION)
    known = materialized(spark, dimensions.upsert_sites(empty, early, A.FIXED_NOW), "sites")
    whole = known.select("news_site_name", "total_content_count")
    batch = dimensions.batch_sites(late).select("news_site_name", F.col("rows_in_batch").alias("total_content_count"))
    changed = batch.exceptAll(whole).withColumn("kind", F.lit("row differs"))
    new = dimensions.new_sites(known, late).select(
        "news_site_name", F.col("rows_in_batch").alias("total_content_count"), F.lit("new site").alias("kind")
    )
    return changed.unionByName(new)


# --- text ---------------------------------------------------------------------------------------


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = A.table(spark, sf_dir, "documents")
    words = docs.select("doc_id", tokenize(F.col("text")).alias("words"), tokenize(F.col("text"), 6).alias("long_words"))
    return words.select(
        "doc_id",
        F.size("words").alias("token_count"),
        F.md5(F.concat_ws(",", "words")).alias("keywords_md5"),
        F.size("long_words").alias("long_count"),
    )


def _lowered(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = A.documents_silver(spark, sf_dir)
    lowered = silver.select("content_id", F.lower(analysis_text()).alias("lowered"))
    joined = F.concat(F.lit(","), F.concat_ws(",", tokenize(F.col("lowered"))), F.lit(","))
    return lowered.withColumn("joined", joined)


def score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = topic_scores(F.col("lowered"), F.col("joined"), A.TEST_TOPICS)
    rows = _lowered(spark, sf_dir).select("content_id", scores.alias("scores"))
    named = [F.col("scores")[i].alias(f"score_{name.lower()}") for i, name in enumerate(A.TEST_TOPICS)]
    return rows.select("content_id", *named, positive_topics(F.col("scores"), A.TEST_TOPICS).alias("topics_all"))


def topics_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.documents_gold(spark, sf_dir, TOPIC_KEYWORDS, ENTITY_NAMES).select("content_id", "topic_name", "entities")


def topics_by_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.documents_gold(spark, sf_dir, match="token").select("content_id", "topic_name")


def typed_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lowered(spark, sf_dir).select(F.explode(entity_records(F.col("lowered"), A.TEST_ENTITIES)).alias("e"))
    return rows.groupBy(F.col("e.type").alias("entity_type"), F.col("e.name").alias("entity")).agg(
        F.count(F.lit(1)).alias("mention_count")
    )


def large_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic and entities by a dictionary of 4,913 names."""
    enriched_rows = enrich_text(A.documents_silver(spark, sf_dir), A.LARGE_DICTIONARY, A.LARGE_DICTIONARY)
    return enriched_rows.select("content_id", "topic_name", F.md5(F.col("entities").cast("binary")).alias("entities_md5"))


def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    register_sql_functions(spark, A.TEST_TOPICS, A.TEST_ENTITIES)
    A.table(spark, sf_dir, "documents").createOrReplaceTempView("tidewire_documents")
    return spark.sql(
        "SELECT doc_id, size(tokenize_text_udf(text)) AS token_count, classify_topic_udf(text) AS topic_name, "
        "concat_ws(',', extract_entities_udf(text)) AS entities FROM tidewire_documents"
    )


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.documents_gold(spark, sf_dir).select(
        "content_id", "source_system", F.md5("keywords").alias("keywords_md5"), "entities", "topic_name",
        "published_year", "published_month", "published_day", "authors_json", "launches_json", "events_json",
        "ingest_run_id", "processed_at", "record_hash",
    )


def exploded_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = C.exploded_items(A.documents_gold(spark, sf_dir), "keywords", "keyword", ["content_type"], distinct=False)
    return items.groupBy("keyword", "content_type").agg(F.count(F.lit(1)).alias("uses"))


def hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = A.orders_content(spark, sf_dir).withColumnRenamed("content_id", "id")
    columns = ["id", "title", "url", "published_at", "image_url", "no_such_column"]
    return orders.select("id", record_hash(orders, columns).alias("record_hash"))


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors, launches and events, each with a typed key and the whole item."""
    silver = A.documents_silver(spark, sf_dir)
    found = None
    for column, relation, key in (("authors", "author", "name"), ("launches", "launch", "launch_id"), ("events", "event", "event_id")):
        rows = C.relation_rows(silver, column).select(
            "content_id", "content_type", F.lit(relation).alias("relation"), "position",
            F.col(f"item.{key}").cast("string").alias("item"), "item_json",
        )
        found = rows if found is None else found.unionByName(rows)
    return found


# --- aggregates ---------------------------------------------------------------------------------


def _trend_columns(df: DataFrame) -> DataFrame:
    return df.drop("calculated_at")


def latest_month_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.latest_month_top(A.stored_trends(spark, sf_dir), "topic_name")


def replaced_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load both dates, then load the later one again with other numbers: only that date changes."""
    path = scratch_path(spark, "replace")
    both = A.order_trends(spark, sf_dir).drop("calculated_at")
    tables.replace_dates(both, path)
    later = both.where(F.col("ingest_date") == F.lit("2001-08-01").cast("date"))
    tables.replace_dates(later.withColumn("content_count", F.col("content_count") + 1), path)
    return spark.read.parquet(path).select(
        "year_month", "topic_name", "content_type", "content_count", F.col("ingest_date").cast("date")
    )


def aggregate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.aggregate_counts(A.order_trends(spark, sf_dir), A.order_activity(spark, sf_dir))


# --- history and dimensions ---------------------------------------------------------------------

HISTORY_COLUMNS = [
    "content_pk", "content_id", "content_type", "title", "topic_name", "published_at", "ingest_date", "record_hash",
    "version", "valid_from", "valid_to", "is_current",
]


def merged_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.customer_state(spark, sf_dir).select(*HISTORY_COLUMNS)


def stored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same loads through the stored table, the last of them run twice."""
    core = tables.CoreTable(spark, scratch_path(spark, "core"))
    for until, now in [*A.SCD_LOADS, A.SCD_LOADS[-1]]:
        core.load(A.customer_batch(spark, sf_dir, until), until, now)
    return core.state().select(*HISTORY_COLUMNS)


def backfilled_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same loads with the middle one coming last: the later date is merged again on top of it."""
    moments = dict(A.SCD_LOADS)
    first, middle, last = moments
    core = tables.CoreTable(spark, scratch_path(spark, "core"))
    for until in (first, last, middle):
        core.load(
            A.customer_batch(spark, sf_dir, until), until, moments[until],
            replay=lambda day: (A.customer_batch(spark, sf_dir, day), moments[day]),
        )
    return core.state().select(*HISTORY_COLUMNS)


def empty_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both dates loaded, then the later one again with no rows: only the earlier one is left."""
    path = scratch_path(spark, "reload")
    both = A.order_trends(spark, sf_dir).drop("calculated_at")
    tables.replace_dates(both, path)
    tables.replace_dates(both.limit(0), path, ["2001-08-01"])
    return spark.read.parquet(path).select(
        "year_month", "topic_name", "content_type", "content_count", F.col("ingest_date").cast("date")
    )


def unsound_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unmerged line items break the one-current-version rule wherever a key repeats."""
    return scd2.broken_versions(A.raw_lineitems(spark, sf_dir)).select(
        "content_id", "content_type", "versions", "current_versions"
    )


def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order sites, and trends without their type, repeat their keys."""
    sites = dimensions.repeated_keys(A.orders_content(spark, sf_dir), ["news_site"], "sites")
    return sites.unionByName(dimensions.repeated_keys(A.order_trends(spark, sf_dir), ["year_month", "topic_name"], "trends"))


def sound_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = A.customer_state(spark, sf_dir)
    broken = scd2.broken_versions(state)
    return state.groupBy("content_type").agg(F.count(F.lit(1)).alias("versions")).withColumn(
        "broken_keys", broken.select(F.count(F.lit(1))).scalar()
    )


def _site_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two loads whose sites (nation and year) overlap in part; pending orders have an empty site."""
    orders = A.orders_content(spark, sf_dir)
    cut = F.lit("1999-12-31").cast("date")
    named = F.concat("news_site", F.lit("-"), F.year("published_at").cast("string"))
    site = F.when(F.col("content_type") == "P", F.lit("")).otherwise(named)
    rows = orders.select(site.alias("news_site"), "ingest_date")
    return rows.where(F.col("ingest_date") <= cut), rows.where(F.col("ingest_date") > cut)


def site_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = _site_batches(spark, sf_dir)
    empty = spark.createDataFrame([], SITE_DIMENSION)
    after_first = dimensions.upsert_sites(empty, early, "2000-01-01 00:00:00")
    both = dimensions.upsert_sites(after_first, late, "2001-08-02 00:00:00")
    return both.drop("news_site_id", "website_url", "description")


def topic_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.topic_dimension(A.documents_content(spark, sf_dir), A.FIXED_NOW).select(
        "topic_name", "is_active", "created_at"
    )


def dimension_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = A.orders_content(spark, sf_dir)
    sites = dimensions.upsert_sites(spark.createDataFrame([], SITE_DIMENSION), content, A.FIXED_NOW)
    return dimensions.dimension_counts(sites, dimensions.topic_dimension(content, A.FIXED_NOW))


# --- runs, checks, insights, alerts ---------------------------------------------------------------


def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = A.daily_runs(spark, sf_dir).select("ingest_date", "records_failed")
    runs = quality.record_runs(
        A.orders_content(spark, sf_dir), "2001-08-02 01:00:00", "2001-08-02 00:30:00", failed
    )
    return runs.drop("error_message")


def content_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = quality.record_content_checks(A.orders_content(spark, sf_dir), A.FIXED_NOW, minimum=7)
    return checks.drop("records_failed").withColumns(
        {"check_value": F.col("check_value").cast("double"), "threshold_value": F.col("threshold_value").cast("double")}
    ).drop("error_message")


def insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily record written as JSON and read back as nested data."""
    path = scratch_path(spark, "insights")
    record = daily_insights(
        A.orders_content(spark, sf_dir), A.stored_trends(spark, sf_dir), A.stored_activity(spark, sf_dir), "2001-08-01"
    )
    record.write.mode("overwrite").json(path)
    back = spark.read.schema(record.schema).json(path)
    return back.withColumns({"top_topics": F.to_json("top_topics"), "top_sources": F.to_json("top_sources")})


def _issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = A.documents_bronze(spark, sf_dir).withColumn("_error_reason", validate.silver_reason())
    return quality.reason_counts(checked, by=["news_site"])


def quality_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_issues(_issues(spark, sf_dir), critical_above=6.0)


def threshold_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily run metrics against limits that the data itself gives (its means)."""
    runs = A.daily_runs(spark, sf_dir)
    metrics = runs.unpivot("ingest_date", ["records_processed", "records_failed"], "metric_name", "current_value")
    limits = metrics.groupBy("metric_name").agg((F.floor(F.avg("current_value")) * 2).alias("threshold")).withColumn(
        "comparison", F.when(F.col("metric_name") == "records_failed", ">").otherwise("<=")
    )
    return quality.threshold_breaches(metrics, limits)


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_events(A.daily_runs(spark, sf_dir))


def layer_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = A.documents_bronze(spark, sf_dir).groupBy("news_site").agg(F.count(F.lit(1)).alias("bronze_count"))
    kept = A.documents_silver(spark, sf_dir).groupBy("news_site").agg(F.count(F.lit(1)).alias("silver_count"))
    joined = raw.join(kept, "news_site", "left").withColumn("silver_count", F.coalesce("silver_count", F.lit(0)))
    return quality.layer_loss(joined, 12.0)


def suspicious_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.suspicious_dates(A.orders_content(spark, sf_dir), "2001-07-15", oldest_year=1996)


def unofficial_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unofficial_sites(A.documents_silver(spark, sf_dir, A.english_sites(spark, sf_dir)))


_MADE: dict[tuple[str, str, str], tables.Lake] = {}


def _once(what: str, spark: SparkSession, sf_dir: str, make) -> tables.Lake:
    """A lake that several queries read, made once in a session and anew if its files have gone."""
    label = (what, spark.sparkContext.applicationId, sf_dir)
    if label not in _MADE or not path_exists(spark, _MADE[label].core()):
        _MADE[label] = make()
    return _MADE[label]


def _run_day(spark: SparkSession, sf_dir: str) -> tables.Lake:
    """All jobs over the landed documents, as one load date."""

    def make() -> tables.Lake:
        bronze_root = landed_bronze(spark, sf_dir)
        lake = tables.Lake(bronze_root.rsplit("/", 1)[0] + "/lake-" + bronze_root.rsplit("-", 1)[1], bronze_root)
        pipeline.run_day(spark, lake, A.DOC_AS_OF)
        return lake

    return _once("day", spark, sf_dir, make)


def job_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality issues that the jobs wrote."""
    found = spark.read.parquet(_run_day(spark, sf_dir).core("meta_quality_issues"))
    return found.drop("checked_at").withColumn("ingest_date", F.col("ingest_date").cast("date"))


def job_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily summary that the jobs wrote, per day and type."""
    found = changes.summary(spark.read.parquet(_run_day(spark, sf_dir).core(changes.SUMMARY_CHANGES)))
    return found.groupBy("date", "content_type").agg(
        F.sum("content_count").alias("content_count"), F.sum("featured_count").alias("featured_count")
    )


def _loaded_documents(spark: SparkSession, sf_dir: str, buckets: int = 8) -> tables.Lake:
    """Enriched documents through two loads that the change tables follow: in the first, every third document has its
    words in another order and another topic, and every fifth is missing."""

    def make() -> tables.Lake:
        lake = tables.Lake(scratch_path(spark, "lake"))
        core = tables.CoreTable(spark, lake.core(), buckets)
        gold = pipeline.core_batch(A.documents_gold(spark, sf_dir))
        final = tables.with_lists(materialized(spark, tables.without_lists(gold), "final")).select(*gold.columns)
        number = F.crc32(F.col("content_id").cast("binary"))
        early = final.where(number % 5 != 0).withColumns({
            "topic_name": F.when(number % 3 == 0, "Draft").otherwise(F.col("topic_name")),
            "keyword_list": F.when(number % 3 == 0, F.slice("keyword_list", 1, 20)).otherwise(F.col("keyword_list")),
            "record_hash": F.when(number % 3 == 0, "draft").otherwise(F.col("record_hash")),
        })
        for (day, now), batch in zip(A.SCD_LOADS[:2], (early, final), strict=True):
            core.load(batch, day, now, stored=True)
        changes.changes_job(spark, lake, [day for day, _ in A.SCD_LOADS[:2]], buckets)
        return lake

    return _once("documents", spark, sf_dir, make)


def stored_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report 5.2 from keyword counts that followed two loads."""
    return changes.top_keywords(spark.read.parquet(_loaded_documents(spark, sf_dir).core(changes.KEYWORD_CHANGES)))


def stored_topic_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report 5.3 from keyword counts that followed two loads."""
    return changes.keywords_by_topic(spark.read.parquet(_loaded_documents(spark, sf_dir).core(changes.KEYWORD_CHANGES)))


def _loaded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary changes of customers' latest orders over three loads."""

    def make() -> tables.Lake:
        lake = tables.Lake(scratch_path(spark, "lake"))
        core = tables.CoreTable(spark, lake.core())
        extra = {"news_site": F.substring("title", -1, 1), "featured": F.col("title").endswith("7"), "keyword_list": F.array("topic_name")}
        for until, now in A.SCD_LOADS:
            core.load(A.customer_batch(spark, sf_dir, until).withColumns(extra), until, now)
        changes.changes_job(spark, lake, core.snapshots())
        return lake

    return spark.read.parquet(_once("orders", spark, sf_dir, make).core(changes.SUMMARY_CHANGES))


def sketched_distincts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct order sites and topics per month from united sketches, next to the exact counts."""
    orders = A.orders_content(spark, sf_dir)
    rows = materialized(spark, sketches.day_sketches(orders), "sketches")
    estimates = sketches.united(rows, month_start("date"))
    exact = orders.groupBy(month_start("published_at")).agg(
        F.count_distinct("content_id").alias("items"), F.count_distinct("news_site").alias("sites"), F.count_distinct("topic_name").alias("topics")
    )
    close = [F.abs(F.col(f"{c}_estimate") - F.col(c)) <= 0.03 * F.col(c) for c in sketches.COUNTED]
    return exact.join(estimates, "month_start").select(
        month_label(F.col("month_start")).alias("year_month"), "items", "sites", "topics", (close[0] & close[1] & close[2]).alias("close"),
    )


def followed_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily summary after the third load, from the changes of all three."""
    return changes.summary(_loaded_orders(spark, sf_dir))


def followed_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics per month as of the second load, from the changes."""
    until, _ = A.SCD_LOADS[1]
    return changes.monthly(_loaded_orders(spark, sf_dir), "topic_name", until, A.FIXED_NOW).drop("calculated_at")


def job_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report 9.3 over the check table that the jobs wrote."""
    checks = spark.read.parquet(_run_day(spark, sf_dir).core("meta_data_quality_checks"))
    return monitoring.recent_checks(quality.checks_view(checks)).drop("created_at", "error_details").withColumn(
        "check_date", F.col("check_date").cast("date")
    )


# --- streams --------------------------------------------------------------------------------------


def streamed_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All types landed as files, taken up by one incremental pass."""
    root, out = landed_bronze(spark, sf_dir), scratch_path(spark, "stream")
    incremental.ingest_once(spark, root, out, "stream")
    gold = spark.read.parquet(f"{out}/gold")
    aside = spark.read.parquet(f"{out}/quarantine")
    return gold.select("content_id", "topic_name", "record_hash", F.lit(None).cast("string").alias("reason")).unionByName(
        aside.select(
            F.concat("content_type", F.lit("_"), "id").alias("content_id"),
            F.lit(None).cast("string").alias("topic_name"), F.lit(None).cast("string").alias("record_hash"),
            F.col("_error_reason").alias("reason"),
        )
    )


def streamed_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts of the event file as a stream: partial counts per batch, added up on reading."""
    configure(spark)
    out = scratch_path(spark, "hours")
    stream = spark.readStream.schema(spark.read.parquet(f"{sf_dir}/events.parquet").schema).parquet(
        f"{sf_dir}/events.parque[t]"
    )
    rows = stream.select(F.col("ts").cast("timestamp").alias("published_at"), "event_type")
    incremental.count_windows_once(rows, "published_at", ["event_type"], f"{out}/rows", f"{out}/checkpoint")
    return stateful.read_windows(spark, f"{out}/rows", ["event_type"])


def _event_stream(spark: SparkSession, root: str) -> DataFrame:
    """Landed event files, a few rows' files per batch, with the date of their folder as time of arrival."""
    stream = spark.readStream.schema("event_id long, event_type string, ts timestamp, day date").option("maxFilesPerTrigger", 4)
    return stream.parquet(root).select(
        "event_id", "event_type", F.col("ts").alias("published_at"), F.col("day").cast("timestamp").alias("arrived")
    )


def _land_events(events: DataFrame, root: str, day: str) -> None:
    rows = events.select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    rows.write.mode("append").parquet(f"{root}/day={day}")


def unique_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed in two files that overlap, late rows in the second, taken up by two runs of a stream that remembers
    ids; the parts are then compacted."""
    configure(spark)
    root, out = scratch_path(spark, "events"), scratch_path(spark, "hours")
    events = A.table(spark, sf_dir, "events")
    part = F.crc32(F.col("event_id").cast("string").cast("binary")) % 3
    for day, rows in (("2024-01-02", events.where(part < 2)), ("2024-01-01", events.where(part > 0))):
        _land_events(rows, root, day)
        stateful.count_unique_windows_once(
            _event_stream(spark, root), "published_at", ["event_type"], ["event_id"], f"{out}/rows", f"{out}/checkpoint",
            arrived="arrived", keep="7 days",
        )
    stateful.compact_windows(spark, f"{out}/rows", ["event_type"])
    return stateful.read_windows(spark, f"{out}/rows", ["event_type"])


def closed_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that a stateful window count has closed: all that end a day before the newest event."""
    configure(spark)
    root, out = scratch_path(spark, "events"), scratch_path(spark, "hours")
    _land_events(A.table(spark, sf_dir, "events"), root, "2024-01-01")
    stateful.close_windows_once(
        _event_stream(spark, root), "published_at", ["event_type"], f"{out}/rows", f"{out}/checkpoint", delay="1 day",
        keys=["event_id"],
    )
    return stateful.read_windows(spark, f"{out}/rows", ["event_type"])


def _table(adapter, function, *arguments, **parameters):
    return lambda spark, sf_dir: function(adapter(spark, sf_dir), *arguments, **parameters)


OPERATOR_QUERIES = {
    "a01_bronze_read": bronze_read,
    "a02_info_sites": info_sites,
    "a02_api_metadata": api_metadata,
    "a03_parquet_partitions": parquet_partitions,
    "a04_missing_type": missing_type,
    "a05_write_statistics": write_statistics,
    "a09_staging_load": staging_load,
    "a10_aggregate_staging": aggregate_staging,
    "a12_land_valid_lines": land_valid_lines,
    "a13_extraction_metadata": extraction_metadata,
    "a14_list_extractions": list_extractions,
    "a15_check_extraction": check_extraction,
    "a17_incremental": incremental_rows,
    "b03_site_flags": site_flags,
    "b04_silver_reasons": silver_reasons,
    "b05_ingest_reasons": ingest_reasons,
    "b06_batch_totals": batch_totals,
    "b08_timestamp_policies": timestamp_policies,
    "b09_quarantine": quarantine_rows,
    "b13_year_topics": year_topics,
    "b16_normalized": normalized,
    "b17_quality_flags": quality_flags,
    "d01_topic_trends": _table(A.documents_gold, lambda g: _trend_columns(trends.topic_trends(g, A.DOC_AS_OF))),
    "d02_source_activity": _table(A.documents_texts, lambda g: _trend_columns(trends.site_activity(g, A.DOC_AS_OF))),
    "d10_top_topics": _table(A.documents_gold, C.top_topics),
    "d11_entity_coverage": _table(A.documents_gold, C.entity_coverage),
    "d12_batch_sites": _table(A.orders_content, dimensions.batch_sites),
    "e01_dedup_latest": dedup_lineitem,
    "e01_dedup_earliest": dedup_earliest,
    "e01_stored_latest": dedup_stored_lineitem,
    "e01_stored_earliest": dedup_stored_earliest,
    "f03_latest_month_top": latest_month_top,
    "g01_union_types": union_types,
    "g03_except_rows": except_rows,
    "h12_record_hash": hashes,
    "h13_relation_rows": relations,
    "i02_tokens": tokens,
    "i05_topic_scores": score_table,
    "i05_topics_default": topics_default,
    "i05_topics_by_token": topics_by_token,
    "i06_large_dictionary": large_dictionary,
    "i06_typed_entities": typed_entities,
    "i07_enriched": enriched,
    "i08_exploded_keywords": exploded_keywords,
    "i09_sql_functions": sql_functions,
    "j01_scd2_merge": merged_history,
    "j01_scd2_stored": stored_history,
    "j03_site_dimension": site_dimension,
    "j05_empty_reload": empty_reload,
    "j12_backfill_order": backfilled_history,
    "j04_topic_dimension": topic_dimension,
    "j05_replaced_dates": replaced_dates,
    "j06_version_report": _table(A.customer_state, scd2.version_report),
    "j06_dimension_counts": dimension_counts,
    "j06_aggregate_counts": aggregate_counts,
    "j07_run_records": run_records,
    "j08_content_checks": content_checks,
    "j09_insights": insights,
    "j10_unsound_versions": unsound_versions,
    "j10_sound_versions": sound_versions,
    "j10_repeated_keys": repeated_keys,
    "k09_3_job_checks": job_checks,
    "k11_job_summary": job_summary,
    "m01_job_issues": job_issues,
    "d03_sketched_distincts": sketched_distincts,
    "d01_followed_trends": followed_trends,
    "k05_2_stored_keywords": stored_keywords,
    "k05_3_stored_keywords": stored_topic_keywords,
    "k11_followed_summary": followed_summary,
    "k11_daily_summary": _table(A.orders_content, trends.daily_summary),
    "l01_streamed_gold": streamed_gold,
    "l02_closed_hours": closed_hours,
    "l02_streamed_hours": streamed_hours,
    "l02_unique_hours": unique_hours,
    "m01_quality_issues": quality_issues,
    "m02_threshold_breaches": threshold_breaches,
    "m03_run_events": run_events,
    "m04_layer_loss": layer_loss,
    "m05_duplicate_keys": _table(A.raw_lineitems, dedup.duplicate_keys, ["content_id", "content_type"]),
    "m06_null_fields": _table(A.documents_bronze, quality.null_fields),
    "m07_suspicious_dates": suspicious_dates,
    "m08_unofficial_sites": unofficial_sites,
    "m09_dedup_by_url": dedup_by_url,
}
