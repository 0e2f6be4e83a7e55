"""Tables that follow the loads, against full recounts."""

import random

import pytest
from pyspark.sql import functions as F

from tidewire.operators.trends import daily_summary, site_activity, topic_trends
from tidewire.plans import changes, terms
from tidewire.session import scratch_path
from tidewire.sources.tables import CoreTable, Lake

SCHEMA = (
    "content_id string, content_type string, published_at timestamp, news_site string, topic_name string, featured boolean, "
    "record_hash string, keyword_list array<string>"
)
WORDS = ["orbit", "moon", "mars", "launch", "rover", "of"]


def batch(spark, draw, n=25):
    import datetime as dt

    rows = []
    for k in draw.sample(range(40), n):
        words = None if draw.random() < 0.1 else [draw.choice(WORDS) for _ in range(draw.randint(0, 9))]
        rows.append((
            f"k{k}", draw.choice(["articles", "blogs"]), None if draw.random() < 0.1 else dt.datetime(2026, draw.randint(1, 3), 5),
            draw.choice(["S1", "S2", None]), draw.choice(["Moon", "Mars", "2024", None]), draw.choice([True, False, None]),
            draw.choice("abc"), words,
        ))
    return spark.createDataFrame(rows, SCHEMA).dropDuplicates(["content_id", "content_type"])


def rows(df, *columns):
    return sorted(map(repr, df.select(*columns).collect()))


def read(spark, lake, table):
    return spark.read.parquet(lake.core(table))


def test_sums_equal_recounts_after_every_load(spark):
    draw, lake = random.Random(2), Lake(scratch_path(spark, "lake"))
    core = CoreTable(spark, lake.core(), buckets=4)
    batches, states = {}, {}
    for day in ("2026-02-01", "2026-02-02", "2026-02-03"):
        batches[day] = batch(spark, draw)
        core.load(batches[day], day, f"{day} 00:00:00")
        changes.changes_job(spark, lake, [day], 4)
        states[day] = spark.createDataFrame(core.state().collect(), core.state().schema)
    summary, counts = read(spark, lake, changes.SUMMARY_CHANGES), read(spark, lake, changes.KEYWORD_CHANGES)
    columns = [*changes.SUMMARY_KEYS, "content_count", "featured_count"]
    for day, state in states.items():
        current = state.where("is_current")
        assert rows(changes.summary(summary, day), *columns) == rows(daily_summary(state), *columns)
        for dimension, whole in (("topic_name", topic_trends), ("news_site", site_activity)):
            months = ["year_month", dimension, "content_type", "content_count"]
            assert rows(changes.monthly(summary, dimension, day), *months) == rows(whole(current, day), *months)
        assert changes.top_keywords(counts, as_of=day).collect() == terms.top_keywords(state).collect()
        assert changes.keywords_by_topic(counts, 2, as_of=day).collect() == terms.keywords_by_topic(state, 2).collect()
    found = changes.documents_with(read(spark, lake, changes.POSTINGS), ["moon", "rover"])
    expected = states["2026-02-03"].where("is_current").where(F.arrays_overlap("keyword_list", F.array(F.lit("moon"), F.lit("rover"))))
    keys = ["content_id", "content_type", "version"]
    assert rows(found, *keys) == rows(expected, *keys)
    uses = F.size(F.filter("keyword_list", lambda w: w.isin("moon", "rover"))).alias("uses")
    assert rows(found, *keys, F.col("uses").cast("int").alias("uses")) == rows(expected, *keys, uses)

    # a load that comes again, and one in between, replace what they and later dates had changed
    core.load(batch(spark, draw), "2026-02-02", "2026-02-02 00:00:00", replay=lambda day: (batches[day], f"{day} 00:00:00"))
    changes.changes_job(spark, lake, ["2026-02-02", "2026-02-03"], 4)
    assert rows(changes.summary(read(spark, lake, changes.SUMMARY_CHANGES)), *columns) == rows(daily_summary(core.state()), *columns)
    counts = read(spark, lake, changes.KEYWORD_CHANGES)
    assert changes.top_keywords(counts).collect() == terms.top_keywords(core.state()).collect()


def test_a_load_without_changes_has_no_rows(spark):
    lake = Lake(scratch_path(spark, "lake"))
    core, own = CoreTable(spark, lake.core(), buckets=4), batch(spark, random.Random(5))
    for day in ("2026-02-01", "2026-02-02"):
        core.load(own, day, f"{day} 00:00:00")
    counts = changes.changes_job(spark, lake, ["2026-02-01", "2026-02-02"], 4)
    assert counts[changes.SUMMARY_CHANGES] > 0
    assert {str(r[0]) for r in read(spark, lake, changes.SUMMARY_CHANGES).select("ingest_date").distinct().collect()} == {"2026-02-01"}
    with pytest.raises(ValueError):
        core.opened("2026-03-01")


def test_a_days_job_reads_the_buckets_of_its_load(spark):
    lake = Lake(scratch_path(spark, "lake"))
    core, own = CoreTable(spark, lake.core(), buckets=16), batch(spark, random.Random(5), 40)
    core.load(own, "2026-02-01", "2026-02-01 00:00:00")
    core.load(own.limit(1).withColumn("record_hash", F.lit("new")), "2026-02-02", "2026-02-02 00:00:00")
    files = changes.version_changes(core, "2026-02-02").inputFiles()
    assert len(files) == 2 and all("load_id=2026-02-02" in f for f in files)


def test_reports_split_nothing(spark):
    own = batch(spark, random.Random(5)).withColumn("is_current", F.lit(True))
    for report in (terms.top_keywords(own), terms.keywords_by_topic(own)):
        assert "split(" not in report._jdf.queryExecution().executedPlan().toString()
    joined = own.withColumn("keywords", F.concat_ws(",", "keyword_list")).where("keyword_list IS NOT NULL")
    assert terms.top_keywords(joined.drop("keyword_list")).collect() == terms.top_keywords(joined).collect()
