import json
import os

import pytest
from pyspark.sql import functions as F

from tidewire.operators.content import with_parsed_times
from tidewire.operators.scd2 import broken_versions
from tidewire.plans import pipeline as P
from tidewire.plans.views import publish_views
from tidewire.session import scratch_path
from tidewire.sources import bronze
from tidewire.sources.tables import (
    CoreDimension, CoreTable, Lake, csv_records, read_partitions, read_staging_csv, replace_dates, write_csv,
)
from tidewire.streaming import incremental, stateful

DAY1, DAY2 = "2026-02-17", "2026-02-18"


def record(n, **change):
    return {
        "id": n, "title": f"SpaceX launch {n}", "url": f"https://e.com/{n}", "image_url": None, "news_site": "S1",
        "summary": 'Text with "quotes", commas\nand a second line', "published_at": f"2026-02-1{n % 8}T10:00:00Z",
        "updated_at": "2026-02-17T10:00:00.5Z", "featured": n % 2 == 0,
        "launches": [{"launch_id": "L", "provider": "p"}], "events": [], "authors": [{"name": "Ann"}], **change,
    }


def put(root, kind, day, lines):
    folder = f"{root}/bronze/{kind}/ingest_date={day}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/part-0000.jsonl", "w") as out:
        out.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


@pytest.fixture
def lake(spark):
    root = scratch_path(spark, "lake")
    put(root, "info", DAY1, [{"version": "4.1", "news_sites": ["S1", "S2"]}])
    put(root, "articles", DAY1, [
        record(1), record(1, updated_at="2026-02-17T11:00:00Z", title="newer"), record(2, news_site="S9"),
        record(3, title=None), record(4, published_at="bad"), "{broken", record(5, title=""),
    ])
    # no authors, launches or events in reports
    put(root, "reports", DAY1, [{k: v for k, v in record(7).items() if k not in ("launches", "events", "authors", "featured")}])
    put(root, "articles", DAY2, [record(1, updated_at="2026-02-17T11:00:00Z", title="newer"), record(2, title="changed"), record(6)])
    return Lake(root)


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_day_by_day(spark, lake):
    stats = P.run_day(spark, lake, DAY1)
    assert stats["clean"] == {
        "initial_count": 8, "valid_count": 4, "invalid_count": 4, "deduplicated_count": 3, "duplicates_removed": 1,
    }
    silver = read_partitions(spark, lake.silver(), [DAY1])
    assert rows(silver, "content_id", "title", "news_site_validated") == [
        ("articles_1", "newer", True), ("articles_2", "SpaceX launch 2", False), ("reports_7", "SpaceX launch 7", True)]
    aside = spark.read.parquet(lake.silver("quarantine"))
    assert rows(aside, "_error_reason") == [
        ("Invalid timestamp format for published_at",), ("Malformed record",),
        ("Missing required field: title",), ("Missing required field: title",)]
    gold = read_partitions(spark, lake.gold(), [DAY1])
    assert rows(gold, "content_id", "topic_name", "authors_json", "launches_json") == [
        ("articles_1", "Other", '[{"name":"Ann"}]', '[{"launch_id":"L","provider":"p"}]'),
        ("articles_2", "SpaceX", '[{"name":"Ann"}]', '[{"launch_id":"L","provider":"p"}]'),
        ("reports_7", "SpaceX", "[]", "[]")]
    assert stats["core"] == {"current": 3, "opened": 3, "closed": 0}
    assert spark.read.parquet(lake.silver("api_metadata")).first().news_sites_count == 2

    P.run_day(spark, lake, DAY2)
    state = CoreTable(spark, lake.core()).state()
    expected = [
        ("articles_1", 1, True), ("articles_2", 1, False), ("articles_2", 2, True), ("articles_6", 1, True),
        ("reports_7", 1, True)]
    assert rows(state, "content_id", "version", "is_current") == expected
    assert broken_versions(state).count() == 0

    before = {t: rows(read_partitions(spark, p), "*") for t, p in tables(lake).items()}
    P.run_day(spark, lake, DAY2)
    assert rows(CoreTable(spark, lake.core()).state(), "content_id", "version", "is_current") == expected
    for name, path in tables(lake).items():
        again = rows(read_partitions(spark, path), "*")
        assert len(again) == len(before[name]), name
    sites = CoreDimension(spark, lake.core("ref_news_sites")).latest()
    assert rows(sites, "news_site_name", "total_content_count") == [("S1", 5), ("S9", 1)]
    runs = spark.read.parquet(lake.core("meta_pipeline_runs"))
    assert rows(runs, F.col("ingest_date").cast("string"), "records_processed") == [(DAY1, 3), (DAY2, 2)]
    insight = json.loads(spark.read.text(f"{lake.insights}/{DAY2}").first().value)
    assert insight["total_content"] == 2 and insight["top_sources"] == [{"source": "S1", "count": 3}]


def test_written_tables_answer_sql(spark, lake):
    assert list(P.backfill(spark, lake, [DAY2, DAY1], buckets=2)) == [DAY1, DAY2]
    names = publish_views(spark, lake)
    assert len(names) == 12
    versions = spark.sql(
        "SELECT content_id, COUNT(*) n, SUM(INT(is_current)) c FROM core.content_items GROUP BY 1 HAVING COUNT(*) > 1")
    assert [tuple(r) for r in versions.collect()] == [("articles_2", 2, 1)]
    newest = spark.sql(
        "SELECT news_site, SUM(content_count) n FROM core.agg_news_site_monthly_activity WHERE ingest_date ="
        " (SELECT MAX(ingest_date) FROM core.agg_news_site_monthly_activity) GROUP BY news_site")
    assert [tuple(r) for r in newest.collect()] == [("S1", 3)]
    runs = spark.sql("SELECT run_date, status, records_processed, execution_time_seconds FROM core.meta_pipeline_runs")
    assert [r.status for r in runs.collect()] == ["completed", "completed"]
    checks = spark.sql("SELECT check_date, check_result, records_checked FROM core.meta_data_quality_checks ORDER BY 1")
    assert [(r.check_result, r.records_checked) for r in checks.collect()] == [("WARNING", 3), ("WARNING", 2)]
    failed = spark.sql("SELECT records_failed FROM core.meta_data_quality_checks ORDER BY check_date")
    assert [r.records_failed for r in failed.collect()] == [4, 0]
    summary = spark.sql("SELECT SUM(content_count) n FROM core.agg_daily_summary GROUP BY ingest_date ORDER BY ingest_date")
    assert [r.n for r in summary.collect()] == [3, 4]
    issues = spark.sql("SELECT issue_type, subject, affected_records FROM core.meta_quality_issues ORDER BY 1, 2")
    assert [tuple(r) for r in issues.collect()] == [
        ("broken rule", "Invalid timestamp format for published_at", 1), ("broken rule", "Malformed record", 1),
        ("broken rule", "Missing required field: title", 2), ("duplicate ids", "articles", 1),
        ("lost records", "articles", 5), ("site off the list", "S9", 1)]
    assert spark.sql("SELECT COUNT(*) FROM core.ref_news_sites").first()[0] == 2
    plan = spark.sql("SELECT title FROM core.content_items WHERE is_current AND published_at > timestamp'2026-02-15'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert P.trends_job(spark, lake, "2026-02-19", whole_history=True)["topic_counts"] == 3
    assert text.count("FileScan") == 1 and "GreaterThan(published_at" in text  # closed slices are not even read


def test_a_missed_date_is_loaded_between_the_others(spark, lake):
    P.run_day(spark, lake, DAY2, keep_slices=0)
    P.run_day(spark, lake, DAY1, keep_slices=0)
    late = CoreTable(spark, lake.core())
    other = Lake(scratch_path(spark, "lake"))
    for kind in ("info", "articles", "reports"):
        for day in (DAY1, DAY2):
            folder = f"{lake.root}/bronze/{kind}/ingest_date={day}"
            if os.path.isdir(folder):
                with open(f"{folder}/part-0000.jsonl") as lines:
                    put(other.root, kind, day, lines.read().splitlines())
    P.backfill(spark, other, [DAY1, DAY2])
    columns = ["content_id", "version", "is_current", "title", "valid_from", "valid_to"]
    assert rows(late.state(), *columns) == rows(CoreTable(spark, other.core()).state(), *columns)
    sites = [CoreDimension(spark, x.core("ref_news_sites")).latest() for x in (lake, other)]
    assert rows(sites[0], "news_site_name", "total_content_count") == rows(sites[1], "news_site_name", "total_content_count")


def test_a_day_that_breaks_off_is_recorded(spark, lake, monkeypatch):
    P.run_day(spark, lake, DAY1)
    monkeypatch.setattr(P, "trends_job", lambda *_, **__: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        P.run_day(spark, lake, DAY2)
    runs = read_partitions(spark, lake.core("meta_pipeline_runs"))
    assert rows(runs, F.col("ingest_date").cast("string"), "run_status") == [(DAY1, "completed"), (DAY2, "failed")]
    assert runs.where("run_status = 'failed'").first().error_message


def test_an_empty_reload_empties_its_date(spark):
    path = scratch_path(spark, "reload")
    df = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02")], "x string, d string").selectExpr("x", "date(d) ingest_date")
    replace_dates(df, path)
    replace_dates(df.limit(0), path, ["2024-01-02"])
    assert [r.x for r in spark.read.parquet(path).collect()] == ["a"]


def test_a_corrected_date_leaves_nothing_of_its_first_run(spark, lake):
    P.clean_job(spark, lake, [DAY1])
    P.enrich_job(spark, lake, [DAY1], "r")
    put(lake.root, "articles", DAY1, [record(1, title="  padded ", url="HTTPS://E.com/X"), record(2, url="https://e.com/X")])
    put(lake.root, "reports", DAY1, [])
    stats = P.clean_job(spark, lake, [DAY1], normalize=True, unique_urls=True)
    assert stats["invalid_count"] == 0 and stats["deduplicated_count"] == 1
    assert not [f for _, _, files in os.walk(lake.silver("quarantine")) for f in files if f.endswith(".parquet")]
    P.enrich_job(spark, lake, [DAY1], "r")
    assert [r.content_type for r in read_partitions(spark, lake.gold(), [DAY1]).collect()] == ["articles"]


def tables(lake):
    return {
        "silver": lake.silver(), "quarantine": lake.silver("quarantine"), "topic_counts": lake.gold("trends/topic_counts"),
        "trends": lake.core("agg_topic_monthly_trends"), "checks": lake.core("meta_data_quality_checks"),
    }


def test_csv_and_parquet_paths_load_the_same_batch(spark, lake):
    P.clean_job(spark, lake, [DAY1])
    P.enrich_job(spark, lake, [DAY1], "r", csv=True)
    direct = P.core_batch(read_partitions(spark, lake.gold(), [DAY1]))
    staged = P.staged_batch(spark, f"{lake.gold('content_enriched_csv')}/{DAY1}")
    compared = [c for c in direct.columns if c != "featured"]
    assert rows(direct, *compared) == rows(staged, *compared)
    # a missing flag becomes false in staging
    assert rows(staged, "content_id", "featured") == [("articles_1", False), ("articles_2", True), ("reports_7", False)]


def test_staging_fills_and_survives_bad_bytes(spark):
    path = scratch_path(spark, "csv")
    os.makedirs(path)
    with open(f"{path}/a.csv", "wb") as out:
        out.write(b'id,content_id,content_type\n1,x,articles\n2,"a ""b"" c\nd",blogs\n3\n4,caf\xff,' + b"r" * 40 + b"\n")
    found = read_staging_csv(spark, path, ["id", "content_id", "content_type", "title"])
    assert rows(found, "id", "content_id", "content_type", "title") == [
        ("1", "x", "articles", None), ("2", 'a "b" c\nd', "blogs", None), ("3", None, None, None),
        ("4", "caf�", "r" * 40, None)]


def test_csv_keeps_null_and_empty_apart(spark):
    path = scratch_path(spark, "csv")
    df = spark.createDataFrame([("1", None, "x"), ("2", "", "y")], "id string, content_id string, content_type string")
    write_csv(df, path, single_file=True)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1
    assert rows(read_staging_csv(spark, path, ["id", "content_id", "content_type"]), "id", "content_id") == [
        ("1", None), ("2", "")]


def test_missing_types_and_dates_are_empty(spark):
    root = scratch_path(spark, "none")
    assert bronze.read_content(spark, root, [DAY1]).count() == 0
    assert bronze.official_sites(bronze.read_info(spark, root)).count() == 0
    put(root, "blogs", DAY1, [record(1)])
    found = bronze.read_content(spark, f"{root}/bronze", [DAY1])
    assert rows(found, "id", "content_type") == [("1", "blogs")]
    assert bronze.read_content(spark, f"{root}/bronze", [DAY2]).count() == 0


def test_extraction_listing_and_check(spark, lake):
    found = {r.endpoint: (r.records, r.file_count, r.status) for r in bronze.check_extraction(spark, lake.bronze, DAY1).collect()}
    assert found == {"articles": (7, 1, "OK"), "reports": (1, 1, "OK"), "info": (1, 1, "OK"), "blogs": (0, 0, "No files found")}
    assert {r.status for r in bronze.check_extraction(spark, lake.bronze, "1999-01-01").collect()} == {"No files found"}
    folder = f"{lake.bronze}/_meta/ingest_date={DAY1}"
    os.makedirs(folder)
    for n in range(25):
        with open(f"{folder}/e{n:02d}_metadata.json", "w") as out:
            json.dump({"endpoint": f"e{n:02d}", "records_downloaded": n, "ingest_date": DAY1}, out, indent=2)
        os.utime(out.name, (1_700_000_000 + n, 1_700_000_000 + n))
    listed = bronze.list_extractions(spark, lake.bronze).collect()
    assert [r.records for r in listed] == list(range(24, 4, -1))


def test_incremental_filters(spark, lake):
    parsed = with_parsed_times(bronze.read_content(spark, lake.bronze, [DAY1])).where("published_at is not null")
    assert bronze.incremental(parsed, since="2026-02-15").count() == 2
    assert bronze.incremental(parsed, updated_after="2026-02-18").count() == 0
    newest = bronze.incremental(parsed, limit=2).collect()
    assert [r.id for r in newest] == ["7", "5"]


def test_streamed_gold_equals_batch_gold_and_takes_only_new_files(spark, lake):
    out = scratch_path(spark, "stream")
    incremental.ingest_once(spark, lake.bronze, out, "run")
    gold = spark.read.parquet(f"{out}/gold")
    assert gold.count() == 7 and spark.read.parquet(f"{out}/quarantine").count() == 4
    incremental.ingest_once(spark, lake.bronze, out, "run")
    assert spark.read.parquet(f"{out}/gold").count() == 7
    put(f"{lake.root}", "reports", DAY2, [record(9)])
    put(f"{lake.root}", "blogs", DAY2, [record(10)])  # a type that wasn't there before
    incremental.ingest_once(spark, lake.bronze, out, "run")
    streamed = spark.read.parquet(f"{out}/gold")
    assert streamed.count() == 9
    P.clean_job(spark, lake, [DAY1, DAY2])
    P.enrich_job(spark, lake, [DAY1, DAY2], "run")
    batch = read_partitions(spark, lake.gold())
    columns = ["content_id", "topic_name", "record_hash", "launches_json"]
    assert set(rows(batch, *columns)) <= set(rows(streamed, *columns))


def test_stream_merges_into_the_history(spark, lake):
    out = scratch_path(spark, "stream")
    core = CoreTable(spark, scratch_path(spark, "core"))
    merge = incremental.core_merge(core, f"{out}/gold", P.core_batch)
    incremental.ingest_once(spark, lake.bronze, out, "run", merge)
    put(f"{lake.root}", "blogs", DAY1, [record(10)])  # late rows of a day that is loaded already
    incremental.ingest_once(spark, lake.bronze, out, "run", merge)
    P.backfill(spark, lake, [DAY1, DAY2])
    columns = ["content_id", "version", "is_current", "title"]
    assert rows(core.state(), *columns) == rows(CoreTable(spark, lake.core()).state(), *columns)


def test_no_folder_yet(spark):
    root = scratch_path(spark, "none")
    os.makedirs(root)
    incremental.ingest_once(spark, root, f"{root}/out", "run")
    assert not os.path.exists(f"{root}/out/gold")


def test_windows_count_late_rows(spark):
    root, out = scratch_path(spark, "events"), scratch_path(spark, "windows")
    for n, moment in enumerate(["2026-01-03 10:05:00", "2026-01-01 09:00:00", "2026-01-03 10:50:00"]):
        spark.sql(f"SELECT timestamp'{moment}' AS t, 'a' AS kind").coalesce(1).write.mode("append").parquet(root)
        stream = spark.readStream.schema("t timestamp, kind string").option("maxFilesPerTrigger", 1).parquet(root)
        incremental.count_windows_once(stream, "t", ["kind"], out, f"{out}-checkpoint")
        assert stateful.read_windows(spark, out, ["kind"]).selectExpr("sum(content_count)").first()[0] == n + 1
    found = stateful.read_windows(spark, out, ["kind"]).orderBy("window_start").collect()
    assert [(r.window_start.day, r.content_count) for r in found] == [(1, 1), (3, 2)]


def test_nested_records_come_through_whole(spark):
    root = scratch_path(spark, "nested")
    authors = [{"name": "Ann", "socials": {"x": ["y"]}}]
    put(root, "articles", DAY1, [record(1, authors=authors, extra=1), record(2, authors=["Bob"], title=None, extra={"k": 2})])
    lake = Lake(root)
    P.clean_job(spark, lake, [DAY1])
    P.enrich_job(spark, lake, [DAY1], "r")
    assert json.loads(read_partitions(spark, lake.gold(), [DAY1]).first().authors_json) == authors
    aside = spark.read.parquet(lake.silver("quarantine")).first()
    assert json.loads(aside.raw_payload)["extra"] == {"k": 2} and json.loads(aside.authors) == ["Bob"]


def test_landed_records_are_parsed_once(spark, lake, monkeypatch):
    """Quarantine and quality rows come from the checked table: the landed files are read by one job only."""
    reads = []
    read = P.bronze.read_content
    monkeypatch.setattr(P.bronze, "read_content", lambda *a, **k: reads.append(a) or read(*a, **k))
    stats = P.clean_job(spark, lake, [DAY1])
    assert stats["invalid_count"] == 4 and len(reads) == 1
    checked = read_partitions(spark, lake.silver(P.CHECKED), [DAY1])
    assert checked.groupBy("is_valid").count().select("count").collect() == [(4,), (4,)]
    assert checked.where("_error_reason IS NULL AND _line IS NOT NULL").count() == 0
    found = P.quality_job(spark, lake, DAY1, "2026-02-18 06:00:00")
    assert found["records"] == 6 and len(reads) == 1
    P.drop_checked(spark, lake, [DAY1])
    assert P.run_day(spark, lake, DAY1)["clean"] == stats
    assert not os.path.exists(f"{lake.silver(P.CHECKED)}/ingest_date={DAY1}")


def test_csv_records_across_splits(spark):
    """Random fields with quotes and line breaks, read in splits of a few bytes, against the csv module."""
    import csv
    import random

    draw, path = random.Random(8), scratch_path(spark, "csv")
    os.makedirs(path)
    pieces = ["a", "b c", ",", '"', "\n", "\n\n", "ü", "x" * 20, ""]
    expected = []
    for n, end in enumerate(["\n", "\r\n", "\n"]):
        table = [[f"{n}-{k}", *("".join(draw.choice(pieces) for _ in range(draw.randint(1, 6))) for _ in range(2))] for k in range(60)]
        table[0][1] = "\n" * 400  # over several splits
        with open(f"{path}/{n}.csv", "w", newline="", encoding="utf-8") as out:
            writer = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_ALL)
            writer.writerow(["id", "title", "summary"])
            writer.writerows(table)
        expected += table
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        found = read_staging_csv(spark, path, ["id", "title", "summary"])
        assert csv_records(spark, path).where("first").count() == 3
        assert spark.read.text(path).rdd.getNumPartitions() > 20
        assert rows(found, "id", "title", "summary") == sorted(map(tuple, expected), key=repr)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
