"""Content tables made from the given test tables, whole, by fixed column rules.

Every row of the source table becomes one row here; the rules only rename and derive columns.
The SQL in ``oracle_views`` repeats the same rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.operators.content import enrich, to_silver
from tidewire.operators.dedup import deduplicate_by_key
from tidewire.operators.scd2 import first_versions, scd2_merge, surrogate_key
from tidewire.operators.trends import site_activity, topic_trends
from tidewire.operators.validate import validate_record
from tidewire.plans.pipeline import core_batch
from tidewire.session import configure, materialized

ORD_AS_OF = "2001-08-02"
EVT_AS_OF = "2024-01-31"
DOC_AS_OF = "2024-07-01"
FIXED_NOW = "2024-07-01 12:00:00"

# The dictionary's own words hardly occur in the invented prose, so the text queries also run
# with words that do.
TEST_TOPICS = {"English": ["the", "and"], "French": ["eau", "que"], "German": ["und", "ung"], "Spanish": ["ción", "con"]}
TEST_ENTITIES = {
    "article": ["the", "der", "les", "los"],
    "link": ["and", "und", "que", "con"],
    "ending": ["tion", "ment", "ción"],
}

SCD_LOADS = [("1997-01-01", "1997-01-01 06:00:00"), ("1999-01-01", "1999-01-01 06:00:00"),
             ("2001-08-02", "2001-08-02 06:00:00")]


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, whole. Its schema is looked up once per path, as each lookup is a Spark job."""
    configure(spark)
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def orders_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as current content over years: type = status, site = nation, topic = market segment."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    key = F.col("o_orderkey")
    key_text = key.cast("string")
    day = F.to_date("o_orderdate")
    loaded = F.least(F.date_add(day, (key % 10).cast("int")), F.lit("2001-08-01").cast("date"))
    published = F.col("o_orderdate").cast("timestamp")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        key_text.alias("content_id"),
        F.col("o_orderstatus").alias("content_type"),
        F.concat(F.lit("Order "), key_text).alias("title"),
        F.concat(F.lit("https://shop.example.com/orders/"), key_text).alias("url"),
        F.when(key % 4 != 0, F.concat(F.lit("https://img.example.com/"), key_text)).alias("image_url"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("news_site"),
        F.concat("o_orderpriority", F.lit(" order of "), "c_name").alias("summary"),
        published.alias("published_at"),
        F.col("c_mktsegment").alias("topic_name"),
        (F.col("o_orderpriority") == "1-URGENT").alias("featured"),
        loaded.alias("ingest_date"),
        F.lit(1).alias("version"),
        loaded.cast("timestamp").alias("valid_from"),
        F.lit(True).alias("is_current"),
    ).withColumn("content_pk", surrogate_key())


def events_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as current content over one month, to the microsecond."""
    events = table(spark, sf_dir, "events")
    bucket = F.get_json_object("props", "$.k").cast("int") % 11
    published = F.col("ts").cast("timestamp")
    return events.select(
        F.col("event_id").cast("string").alias("content_id"),
        F.col("event_type").alias("content_type"),
        F.concat(F.lit("u"), (F.col("user_id") % 20).cast("string")).alias("news_site"),
        F.concat(F.lit("k"), bucket.cast("string")).alias("topic_name"),
        published.alias("published_at"),
        (F.col("value") > 50).alias("featured"),
        F.to_date(published).alias("ingest_date"),
        F.lit(True).alias("is_current"),
    )


def documents_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw records, some of them faulty; the whole text is the summary."""
    doc = F.col("doc_id")
    id_text = doc.cast("string")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    minutes = (doc * 6367) % 259200
    moment = F.timestamp_seconds(F.unix_timestamp(start) + minutes * 60)
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    site_url = F.concat(F.lit("https://"), "source", F.lit(".example.com/"), id_text)
    return table(spark, sf_dir, "documents").select(
        id_text.alias("id"),
        F.when(doc % 41 == 0, None).when(doc % 43 == 0, "")
        .otherwise(F.concat(F.lit("Item "), id_text, F.lit(" from "), "source")).alias("title"),
        F.when(doc % 37 == 0, "not-a-valid-url").otherwise(site_url).alias("url"),
        F.when(doc % 4 != 0, F.concat(F.lit("https://img.example.com/"), id_text)).alias("image_url"),
        F.col("source").alias("news_site"),
        F.col("text").alias("summary"),
        F.when(doc % 31 == 0, None).when(doc % 29 == 0, "bad-date")
        .otherwise(F.date_format(moment, iso)).alias("published_at"),
        F.when(doc % 6 != 0, F.date_format(moment + F.make_dt_interval((doc % 5).cast("int")), iso)).alias("updated_at"),
        (doc % 7 == 0).alias("featured"),
        # nested keys that no schema declares (status, kind, socials) have to come through
        F.when(doc % 4 == 0, F.concat(
            F.lit('[{"launch_id":"L'), id_text, F.lit('","provider":"p","status":{"code":'), (doc % 3).cast("string"), F.lit("}}]")
        )).alias("launches"),
        F.when(doc % 9 == 0, F.lit('[{"event_id":7,"kind":"x"},{"event_id":8}]')).alias("events"),
        F.when(doc % 5 != 0, F.concat(F.lit('[{"name":"'), "lang", F.lit('","socials":["'), "source", F.lit('"]}]'))).alias("authors"),
        F.when(doc % 3 == 0, "articles").when(doc % 3 == 1, "blogs").otherwise("reports").alias("content_type"),
        F.lit(DOC_AS_OF).cast("date").alias("ingest_date"),
    )


def english_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An official site list: the sources whose share of English documents is not below the overall share."""
    docs = table(spark, sf_dir, "documents")
    counts = docs.groupBy("source").agg(F.count_if(F.col("lang") == "en").alias("en"), F.count(F.lit(1)).alias("n"))
    all_en, all_n = counts.select(F.sum("en")).scalar(), counts.select(F.sum("n")).scalar()
    return counts.where(F.col("en") * all_n >= F.col("n") * all_en).select(F.col("source").alias("news_site"))


def documents_silver(spark: SparkSession, sf_dir: str, sites: DataFrame | None = None) -> DataFrame:
    valid, _ = validate_record(documents_bronze(spark, sf_dir))
    return to_silver(valid, sites, stored=True)


def documents_gold(spark: SparkSession, sf_dir: str, topics=None, entities=None, match: str = "substring") -> DataFrame:
    return enrich(
        documents_silver(spark, sf_dir), "check", FIXED_NOW,
        TEST_TOPICS if topics is None else topics, TEST_ENTITIES if entities is None else entities, match,
    )


def documents_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_versions(core_batch(documents_gold(spark, sf_dir)), FIXED_NOW)


def documents_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver documents as current content, for what needs no enrichment."""
    return documents_silver(spark, sf_dir).withColumn("is_current", F.lit(True))


def raw_lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as an unmerged load: the same key occurs several times."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("content_id"),
        F.lit("lineitem").alias("content_type"),
        F.lit(1).alias("version"),
        F.col("l_shipdate").cast("timestamp").alias("published_at"),
        F.to_date("l_shipdate").alias("ingest_date"),
        F.lit(True).alias("is_current"),
    )


def customer_batch(spark: SparkSession, sf_dir: str, until: str) -> DataFrame:
    """Each customer's latest order before a date, as the content batch of that load."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderdate") < F.lit(until).cast("timestamp_ntz"))
    latest = deduplicate_by_key(orders, ["o_custkey"], "o_orderdate", tie_breaks=["o_orderkey"])
    columns = latest.select(
        F.col("o_custkey").cast("string").alias("content_id"),
        F.lit("customer").alias("content_type"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.col("o_orderdate").cast("timestamp").alias("published_at"),
        F.col("o_orderpriority").alias("topic_name"),
        F.to_date(F.lit(until)).alias("ingest_date"),
    )
    return columns.withColumn("record_hash", F.sha2(F.concat_ws("||", "title", "topic_name"), 256))


def customer_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads merged one after the other, each from the written state before it."""
    (first, moment), *later = SCD_LOADS
    state = first_versions(customer_batch(spark, sf_dir, first), moment)
    for until, now in later:
        state = scd2_merge(materialized(spark, state, "state"), customer_batch(spark, sf_dir, until), now)
    return state


def order_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic aggregate computed at two load dates, over what was loaded by then."""
    content = orders_content(spark, sf_dir)
    early = content.where(F.col("ingest_date") <= F.lit("1999-12-31").cast("date"))
    return topic_trends(early, "1999-12-31", FIXED_NOW).unionByName(topic_trends(content, "2001-08-01", FIXED_NOW))


def order_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = orders_content(spark, sf_dir)
    early = content.where(F.col("ingest_date") <= F.lit("1999-12-31").cast("date"))
    return site_activity(early, "1999-12-31", FIXED_NOW).unionByName(site_activity(content, "2001-08-01", FIXED_NOW))


def stored_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic aggregate as the reports find it: a written table."""
    return materialized(spark, order_trends(spark, sf_dir), "trends")


def stored_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialized(spark, order_activity(spark, sf_dir), "activity")


def daily_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per order day under the run table's columns: pending orders count as failed records."""
    orders = table(spark, sf_dir, "orders")
    days = orders.groupBy(F.to_date("o_orderdate").alias("ingest_date")).agg(
        F.count(F.lit(1)).alias("records_processed"),
        F.count_if(F.col("o_orderstatus") == "P").alias("records_failed"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("duration_seconds"),
    )
    bad = F.col("records_failed") * 3 >= F.col("records_processed")
    return days.select(
        "ingest_date", "records_processed", "records_failed", "duration_seconds",
        F.lit("daily_load").alias("run_type"),
        F.concat(F.lit("run-"), F.col("ingest_date").cast("string")).alias("run_id"),
        F.when(bad, "failed").otherwise("completed").alias("run_status"),
        F.when(bad, "too many pending orders").alias("error_message"),
        F.timestamp_seconds(
            F.unix_timestamp(F.col("ingest_date").cast("timestamp")) + 86400 + F.col("records_processed") * 60
        ).alias("created_at"),
    )


def daily_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quality check per order day under the check table's columns."""
    return daily_runs(spark, sf_dir).select(
        "ingest_date",
        F.lit("pending_orders").alias("check_name"),
        F.when(F.col("run_status") == "failed", "failed").otherwise("PASS").alias("check_result"),
        F.col("records_processed").cast("decimal(18,2)").alias("check_value"),
        "records_failed",
        "error_message",
        F.col("created_at").alias("checked_at"),
    )


# A dictionary by rule: all names of three of these parts; the first part names the topic.
NAME_PARTS = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "or", "nt", "ea", "ti"]
LARGE_DICTIONARY = {a: [a + b + c for b in NAME_PARTS for c in NAME_PARTS] for a in NAME_PARTS}
