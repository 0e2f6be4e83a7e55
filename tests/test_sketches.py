"""Distinct counts from united sketches."""

from pyspark.sql import functions as F

from tidewire.plans import sketches
from tidewire.session import scratch_path
from tidewire.sources.tables import CoreTable, Lake


def content(spark, first, n):
    k = F.col("id")
    return spark.range(first, first + n).select(
        F.concat(F.lit("k"), k.cast("string")).alias("content_id"),
        F.when(k % 3 == 0, "articles").otherwise("blogs").alias("content_type"),
        F.timestamp_seconds(1_767_225_600 + (k % 80) * 86400).alias("published_at"),
        F.when(k % 11 != 0, F.concat(F.lit("S"), (k % 4001).cast("string"))).alias("news_site"),
        F.concat(F.lit("T"), (k % 700).cast("string")).alias("topic_name"),
        F.md5(k.cast("string")).alias("record_hash"),
    )


def test_estimates_are_within_two_percent_and_read_no_content(spark):
    lake = Lake(scratch_path(spark, "lake"))
    core = CoreTable(spark, lake.core(), buckets=4)
    loads = {"2026-04-01": content(spark, 0, 30_000), "2026-04-02": content(spark, 20_000, 30_000)}  # 10,000 come again
    for day, batch in loads.items():
        core.load(batch, day, f"{day} 00:00:00")
    assert sketches.sketches_job(spark, lake, list(loads), 4) == 320
    stored = spark.read.parquet(lake.core(sketches.SKETCHES))
    for day, n in (("2026-04-01", 30_000), (None, 50_000)):
        raw = content(spark, 0, n)
        exact = raw.groupBy(F.date_format("published_at", "yyyy-MM").alias("year_month"), "content_type").agg(
            *[F.count_distinct(column).alias(name) for name, column in sketches.COUNTED.items()]
        )
        found = sketches.monthly_distincts(stored, day).join(exact, ["year_month", "content_type"]).collect()
        assert len(found) == 6
        for r in found:
            for name in sketches.COUNTED:
                assert abs(r[f"{name}_estimate"] - r[name]) <= 0.02 * r[name]
    total = sketches.united(stored).first()
    assert total.versions == 50_000 and abs(total.items_estimate - 50_000) < 1000 and abs(total.sites_estimate - 4001) < 80
    files = sketches.monthly_distincts(stored).inputFiles()
    assert files and all(sketches.SKETCHES in f for f in files)


def test_groups_without_values(spark):
    rows = content(spark, 0, 33).where("news_site IS NULL").withColumn("ingest_date", F.lit("2026-04-01").cast("date"))
    found = sketches.united(sketches.day_sketches(rows)).first()
    assert (found.versions, found.items_estimate, found.sites_estimate, found.topics_estimate) == (3, 3, 0, 3)
    assert sketches.united(sketches.day_sketches(rows.limit(0))).first().sites_estimate == 0
