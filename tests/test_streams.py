"""Streams with state: repeats and late files across restarts, closed windows, compaction, expiry."""

import pathlib

import pytest
from pyspark.sql import functions as F

from tidewire.plans import temporal, volume
from tidewire.session import scratch_path
from tidewire.sources import bronze
from tidewire.streaming import incremental, stateful

SCHEMA = "content_id string, content_type string, published_at timestamp, day date"


def item(n, moment, kind="articles"):
    return (f"c{n}", kind, moment)


def land(spark, root, day, items):
    """One file below the folder of its day."""
    frame = spark.createDataFrame(items, "content_id string, content_type string, published_at string")
    frame.withColumn("published_at", F.col("published_at").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{root}/day={day}")


def stream(spark, root):
    rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(root)
    return rows.withColumn("arrived", F.col("day").cast("timestamp"))


LANDED = [  # (day, items): repeats within a file, across files and runs, a late file, old moments
    ("2026-02-10", [item(1, "2026-02-09 10:05:00"), item(2, "2026-02-09 10:50:00"), item(1, "2026-02-09 10:05:00")]),
    ("2026-02-11", [item(2, "2026-02-09 10:50:00"), item(3, "2026-02-11 01:00:00", "blogs")]),
    ("2026-02-09", [item(4, "2026-02-08 23:59:00"), item(3, "2026-02-11 01:00:00", "blogs")]),
    ("2026-02-12", [item(5, "2025-12-31 00:00:00"), item(1, "2026-02-09 10:05:00")]),
]


def test_unique_counts_equal_the_reports_over_unique_rows(spark):
    root, out = scratch_path(spark, "landed"), scratch_path(spark, "counts")
    seen = []
    for n, (day, items) in enumerate(LANDED):
        land(spark, root, day, items)
        seen += items
        said = stateful.count_unique_windows_once(
            stream(spark, root), "published_at", ["content_type"], ["content_id"], f"{out}/rows", f"{out}/checkpoint",
            arrived="arrived", keep="30 days",
        )
        assert said.too_late == 0 and said.rows == len(items) and said.held == len({i[0] for i in seen})
        if n % 2:  # readers see the same before and after
            before = sorted(map(tuple, stateful.read_windows(spark, f"{out}/rows", ["content_type"]).collect()))
            assert stateful.compact_windows(spark, f"{out}/rows", ["content_type"]) > 0
            assert sorted(map(tuple, stateful.read_windows(spark, f"{out}/rows", ["content_type"]).collect())) == before
    unique = spark.createDataFrame(sorted(set(seen)), "content_id string, content_type string, published_at string").select(
        "content_id", "content_type", F.col("published_at").cast("timestamp"), F.lit(True).alias("is_current"),
        F.lit("s").alias("news_site"),
    )
    windows = stateful.read_windows(spark, f"{out}/rows", ["content_type"])
    daily = windows.groupBy(F.date_trunc("day", "window_start"), "content_type").agg(F.sum("content_count").alias("n"))
    report = volume.daily_volume(unique, "2026-02-15", 365)
    assert sorted(map(tuple, daily.collect())) == sorted((r[0], r["content_type"], r["content_count"]) for r in report.collect())
    hours = windows.groupBy(F.hour("window_start").alias("hour")).agg(F.sum("content_count").alias("n"))
    report = temporal.hourly_pattern(unique, "2026-02-15", 365)
    assert sorted(map(tuple, hours.collect())) == sorted((r["hour_of_day"], r["content_count"]) for r in report.collect())


def test_state_expires_and_files_too_late_are_reported(spark):
    root, out = scratch_path(spark, "landed"), scratch_path(spark, "counts")

    def run(day, *items):
        land(spark, root, day, list(items))
        return stateful.count_unique_windows_once(
            stream(spark, root), "published_at", ["content_type"], ["content_id"], f"{out}/rows", f"{out}/checkpoint",
            arrived="arrived", keep="2 days",
        )

    assert run("2026-02-01", item(1, "2026-02-01 00:00:00")).held == 1
    assert run("2026-02-02", item(1, "2026-02-01 00:00:00"), item(2, "2026-02-01 00:00:00")).held == 2
    assert run("2026-02-20", item(3, "2026-02-01 00:00:00")).held == 1  # the others are forgotten
    late = run("2026-02-03", item(4, "2026-02-01 00:00:00"))
    assert late.too_late == 1
    assert run("2026-02-21", item(1, "2026-02-01 00:00:00")).too_late == 0  # known no longer, so counted again
    total = stateful.read_windows(spark, f"{out}/rows", ["content_type"]).agg(F.sum("content_count")).first()[0]
    assert total == 4


def test_windows_close_once(spark):
    root, out = scratch_path(spark, "landed"), scratch_path(spark, "closed")

    def run(*items):
        land(spark, root, "2026-02-01", list(items))
        said = stateful.close_windows_once(
            stream(spark, root), "published_at", ["content_type"], f"{out}/rows", f"{out}/checkpoint", delay="2 hours",
            keys=["content_id"],
        )
        found = stateful.read_windows(spark, f"{out}/rows", ["content_type"])
        return said, sorted((r.window_start.hour, r.content_count) for r in found.collect())

    assert run(item(1, "2026-02-01 10:10:00"), item(2, "2026-02-01 11:10:00"))[1] == []
    assert run(item(3, "2026-02-01 10:20:00"), item(1, "2026-02-01 10:10:00"))[1] == []  # late but in time, and a repeat
    said, found = run(item(4, "2026-02-01 13:30:00"))
    assert found == [(10, 2)] and said.too_late == 0
    said, found = run(item(5, "2026-02-01 10:30:00"), item(6, "2026-02-01 15:00:00"))
    assert found == [(10, 2), (11, 1)] and said.too_late >= 1


def test_a_compaction_that_breaks_off_changes_nothing(spark, monkeypatch):
    root, out = scratch_path(spark, "landed"), scratch_path(spark, "counts")
    for day, items in LANDED[:2]:
        land(spark, root, day, items)
    incremental.count_windows_once(stream(spark, root), "published_at", ["content_type"], f"{out}/rows", f"{out}/checkpoint")
    said = lambda: sorted(map(tuple, stateful.read_windows(spark, f"{out}/rows", ["content_type"]).collect()))
    before = said()
    with monkeypatch.context() as broken:
        broken.setattr(stateful, "remove", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            stateful.compact_windows(spark, f"{out}/rows", ["content_type"])
    assert said() == before
    # the next one finds the parts that were left behind
    assert stateful.compact_windows(spark, f"{out}/rows", ["content_type"]) == 2
    assert said() == before and not list(pathlib.Path(f"{out}/rows".removeprefix("file:")).glob("batch_id=*"))


def test_no_counts_yet(spark):
    with pytest.raises(ValueError):
        stateful.read_windows(spark, scratch_path(spark, "none"), ["content_type"])


def test_a_batch_of_landed_records_is_written_and_not_held(spark, monkeypatch):
    def held(*_, **__):
        raise AssertionError("a batch was held in memory")

    monkeypatch.setattr(type(spark.range(1)), "persist", held)
    root, out = scratch_path(spark, "landed"), scratch_path(spark, "stream")
    good = '{"id":"%d","title":"T","url":"https://a.example.com/x","news_site":"s","summary":"x","published_at":"2026-02-01T00:00:00Z"}'
    lines = [good % 1, good % 2, "no json"]
    bronze.land_lines(spark.createDataFrame([(x, "2026-02-01") for x in lines], "value string, ingest_date string"), root, "articles")
    incremental.ingest_once(spark, root, out, "r")
    assert sorted(r.content_id for r in spark.read.parquet(f"{out}/gold").collect()) == ["articles_1", "articles_2"]
    assert [r.raw_payload for r in spark.read.parquet(f"{out}/quarantine").collect()] == ["no json"]
    assert not list(pathlib.Path(out.removeprefix("file:")).glob("_checked/*/*.parquet"))
