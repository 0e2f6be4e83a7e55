"""Reference dimensions: sites (keyed upsert) and topics (reload)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.clock import as_moment
from tidewire.schemas import SITE_DIMENSION


def name_key(name: str) -> Column:
    """A number for a name, the same in every load: no counter, no look-up."""
    return F.xxhash64(F.col(name))


def repeated_keys(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """Keys that a table holds more than once: the table, the key's values as text, and how often it is there."""
    copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
    values = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    return copies.select(F.lit(table).alias("table_name"), values.alias("key"), "copies")


# The keys that must be unique in each dimension and aggregate.
UNIQUE_KEYS = {
    "ref_news_sites": ["news_site_name"],
    "ref_topics": ["topic_name"],
    "agg_topic_monthly_trends": ["year_month", "topic_name", "content_type", "ingest_date"],
    "agg_news_site_monthly_activity": ["year_month", "news_site", "content_type", "ingest_date"],
}


def batch_sites(batch: DataFrame) -> DataFrame:
    """First day, last day and number of rows per named site of a batch."""
    named = batch.where(F.col("news_site").isNotNull() & (F.col("news_site") != ""))
    return named.groupBy(F.col("news_site").alias("news_site_name")).agg(
        F.min("ingest_date").alias("first_in_batch"),
        F.max("ingest_date").alias("last_in_batch"),
        F.count(F.lit(1)).alias("rows_in_batch"),
    )


def upsert_sites(
    dimension: DataFrame, batch: DataFrame, now: dt.datetime | str | Column | None = None
) -> DataFrame:
    """Dimension after a batch: new sites added, known ones extended, others untouched."""
    moment = as_moment(now)
    joined = dimension.join(batch_sites(batch), "news_site_name", "full_outer")
    seen_before = F.col("created_at").isNotNull()
    in_batch = F.col("rows_in_batch").isNotNull()
    columns = {
        "website_url": F.col("website_url"),
        "description": F.col("description"),
        "is_active": F.coalesce(F.col("is_active"), F.lit(True)),
        "first_seen_date": F.least("first_seen_date", "first_in_batch"),
        "last_seen_date": F.greatest("last_seen_date", "last_in_batch"),
        "total_content_count": F.coalesce("total_content_count", F.lit(0)) + F.coalesce("rows_in_batch", F.lit(0)),
        "created_at": F.when(seen_before, F.col("created_at")).otherwise(moment),
        "updated_at": F.when(in_batch, moment).otherwise(F.col("updated_at")),
    }
    named = joined.select("news_site_name", *[c.alias(n) for n, c in columns.items()])
    return named.withColumn("news_site_id", name_key("news_site_name")).select(*SITE_DIMENSION.fieldNames())


def new_sites(dimension: DataFrame, batch: DataFrame) -> DataFrame:
    """Sites of the batch that the dimension does not hold yet."""
    return batch_sites(batch).join(dimension, "news_site_name", "left_anti")


def topic_dimension(content: DataFrame, now: dt.datetime | str | Column | None = None) -> DataFrame:
    """Distinct topics; pass the current core rows (default use) or one batch."""
    named = content.where(F.col("topic_name").isNotNull() & (F.col("topic_name") != ""))
    return named.select("topic_name").distinct().withColumns(
        {
            "topic_id": name_key("topic_name"),
            "description": F.lit(None).cast("string"),
            "parent_topic_id": F.lit(None).cast("int"),
            "is_active": F.lit(True),
            "created_at": as_moment(now),
            "updated_at": as_moment(now),
        }
    )


def dimension_counts(sites: DataFrame, topics: DataFrame) -> DataFrame:
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("total_count")).select(F.lit(name).alias("ref_table"), "total_count")

    return counted(sites, "news_sites").unionByName(counted(topics, "topics"))


def aggregate_counts(trends: DataFrame, activity: DataFrame, ingest_date=None) -> DataFrame:
    """Rows, months, groups and types per aggregate table and load date."""

    def counted(df: DataFrame, name: str, dimension: str) -> DataFrame:
        if ingest_date is not None:
            df = df.where(F.col("ingest_date") == F.lit(str(ingest_date)).cast("date"))
        return df.groupBy("ingest_date").agg(
            F.count(F.lit(1)).alias("record_count"),
            F.count_distinct("year_month").alias("distinct_months"),
            F.count_distinct(dimension).alias("distinct_groups"),
            F.count_distinct("content_type").alias("distinct_content_types"),
        ).withColumn("table_name", F.lit(name))

    return counted(trends, "Topic Trends", "topic_name").unionByName(
        counted(activity, "Source Activity", "news_site")
    )
