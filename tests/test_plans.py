import re

import pytest
from pyspark.sql import functions as F

from checks import adapters as A
from tidewire.functions.text import enrich_text
from tidewire.operators.dedup import deduplicate_by_key
from tidewire.plans import advanced, dashboard, sites, temporal, terms, topics, volume
from tidewire.session import scratch_path
from tidewire.sources.tables import CoreTable, read_partitions, write_with_stats

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    """Orders as a written core table, partitioned by load date."""
    path = scratch_path(spark, "core")
    rows = A.orders_content(spark, SF).withColumn("ingest_date", F.trunc("ingest_date", "year"))
    write_with_stats(rows, path, partition_by=["ingest_date"])
    return path


def test_filters_and_columns_reach_the_scan(spark, stored):
    plan = plan_of(volume.daily_volume(read_partitions(spark, stored, ["2001-01-01"]), "2001-08-02"))
    # the plan text cuts long filter lists
    assert re.search(r"PushedFilters: \[.*EqualTo\(is_current,true\), GreaterThanOrEqual\(pub", plan)
    assert re.search(r"PartitionFilters: \[.*ingest_date", plan)
    assert "ReadSchema: struct<content_type:string,published_at:timestamp,is_current:boolean>" in plan


@pytest.mark.parametrize("report", [
    volume.volume_by_type, volume.topic_distribution, sites.top_sites, sites.site_diversity, topics.top_topics,
    dashboard.executive_summary, dashboard.leading_sites, advanced.source_reliability, advanced.topic_pairs,
    temporal.monthly_volume, volume.image_share,
])
def test_reports_stay_in_the_engine(spark, stored, report):
    plan = plan_of(report(spark.read.parquet(stored)))
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_distinct_counts_do_not_copy_raw_rows(spark, stored):
    """Where several columns are counted distinct, rows are aggregated before they are expanded."""
    for report in (temporal.monthly_volume, dashboard.executive_summary, advanced.source_reliability):
        plan = plan_of(report(spark.read.parquet(stored)))
        below_expand = plan.split("Expand", 1)[1] if "Expand" in plan else plan
        assert "partial_count(1)" in below_expand


def test_dedup_limits_each_task_before_the_shuffle(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    plan = plan_of(deduplicate_by_key(df, ["l_orderkey"], "l_shipdate"))
    before_shuffle = plan[plan.index("Exchange"):]
    assert "row_number(), 1, Partial" in before_shuffle


def test_text_is_tokenised_once_even_under_filters(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(
        F.lit(None).cast("string").alias("title"), F.col("text").alias("summary"), F.lit(True).alias("is_current"))
    for df in (
        enrich_text(docs).where("topic_name <> 'Other' and entities <> ''"),
        terms.keywords_by_topic(enrich_text(docs)),
        terms.entity_pairs(enrich_text(docs)),
    ):
        plan = plan_of(df)
        assert plan.count("regexp_extract_all") == 1 and "Python" not in plan


def test_enrichment_has_no_shuffle(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("source").alias("title"), F.col("text").alias("summary"))
    assert "Exchange" not in plan_of(enrich_text(docs))


def test_top_k_is_not_a_full_sort(spark, stored):
    plan = plan_of(sites.top_sites(spark.read.parquet(stored)))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_bucketed_slice_is_joined_where_it_lies(spark):
    core = CoreTable(spark, scratch_path(spark, "core"), buckets=4)
    columns = ["content_id", "content_type", "title", "published_at"]
    batch = A.orders_content(spark, SF).select(*columns).withColumn("record_hash", F.md5("title"))
    core.load(batch, "2024-01-01", "2024-01-01 00:00:00")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(core.next_versions(batch, "2024-01-02", "2024-01-02 00:00:00"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    old_side = plan[plan.index("FullOuter"):plan.index("spark_catalog.default.core_")]
    assert "Exchange" not in old_side


@pytest.mark.parametrize("parts", [1, 8])
def test_results_do_not_depend_on_partitioning(spark, parts):
    content = A.orders_content(spark, SF)
    events = A.events_content(spark, SF)
    spread = content.repartition(parts, F.rand(3))
    spread_events = events.repartition(parts, F.rand(4))

    def found(df):
        return [tuple(r) for r in df.collect()]

    for report in (sites.top_sites, sites.site_diversity, dashboard.highlights, topics.top_topics):
        assert found(report(spread)) == found(report(content))
    assert found(advanced.topic_pairs(spread_events)) == found(advanced.topic_pairs(events))


def test_a_third_of_all_rows_in_one_group(spark):
    """One site and one key hold a third of the rows; results are whole and partitions stay even."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("content_id"),
        F.lit("articles").alias("content_type"),
        F.when(F.col("id") % 3 == 0, F.lit("hot site")).otherwise(F.concat(F.lit("s"), (F.col("id") % 50).cast("string")))
        .alias("news_site"),
        F.concat(F.lit("t"), (F.col("id") % 7).cast("string")).alias("topic_name"),
        F.timestamp_seconds(1_700_000_000 + F.col("id") * 60).alias("published_at"),
        F.lit(True).alias("is_current"), F.lit("text").alias("summary"), F.col("id"),
    )
    kept = deduplicate_by_key(rows, ["content_id"], "published_at")
    assert kept.count() == 20_001
    assert kept.where("content_id = 'hot'").first().id == 29_997
    first = sites.top_sites(rows).first()
    assert (first.news_site, first.article_count, first.topics_covered) == ("hot site", 10_000, 7)
    shuffled = rows.groupBy("news_site", "topic_name").agg(F.count("*").alias("n"))
    assert shuffled.agg(F.sum("n")).first()[0] == 30_000


def test_topics_too_rare_for_a_pair_leave_before_the_join(spark):
    """Results stay those of all pairs; the rows that meet are fewer."""
    rows = spark.range(4000).select(
        (F.col("id") % 5).alias("d"), F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("news_site"),
        F.when(F.col("id") % 4 == 0, F.concat(F.lit("rare"), F.col("id").cast("string")))
        .otherwise(F.concat(F.lit("t"), (F.col("id") % 6).cast("string"))).alias("topic_name"),
        F.lit(True).alias("is_current"), "id",
    ).withColumn("published_at", F.timestamp_seconds(1_700_000_000 + F.col("d") * 86400))
    counted = rows.groupBy(F.to_date("published_at").alias("day"), "news_site", "topic_name").agg(F.count("*").alias("n"))
    limit = 20_000
    assert counted.count() > 1000 > advanced.pairable(counted, limit).count() > 0
    sides = [counted.select("day", "news_site", F.col("topic_name").alias(f"topic{k}"), F.col("n").alias(f"n{k}")) for k in (1, 2)]
    pairs = sides[0].join(sides[1], ["day", "news_site"]).where("topic1 < topic2").groupBy("topic1", "topic2")
    expected = pairs.agg(F.sum(F.col("n1") * F.col("n2")).alias("n")).where(F.col("n") >= limit).collect()
    found = advanced.topic_pairs(rows, min_count=limit, limit=1000).collect()
    assert sorted((r.topic1, r.topic2, r.co_occurrence_count) for r in found) == sorted(map(tuple, expected)) and found
    everything = advanced.topic_pairs(rows, min_count=1, limit=10**6)
    assert everything.count() == pairs.count().count()
