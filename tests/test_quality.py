import datetime as dt

from pyspark.sql import functions as F

from tidewire.operators import quality as Q
from tidewire.operators.content import entity_coverage, union_types, year_like_topics
from tidewire.plans import advanced, aggregates, dashboard, health, monitoring, topics


def test_issue_rates_and_severity(spark):
    df = spark.createDataFrame([(51, 100), (50, 100), (1, 3), (0, 0)], "affected_records long, total_records long")
    found = [(r.failure_rate, r.severity) for r in Q.quality_issues(df).collect()]
    assert found == [(51.0, "CRITICAL"), (50.0, "WARNING"), (33.33, "WARNING"), (0.0, "WARNING")]


def test_threshold_breaches(spark):
    metrics = spark.createDataFrame([("a", 5.0), ("b", 5.0), ("c", 5.0), ("d", 1.0)], "metric_name string, current_value double")
    rules = spark.createDataFrame(
        [("a", 4.0, ">"), ("b", 5.0, ">"), ("c", 5.0, ">="), ("d", 2.0, "<")],
        "metric_name string, threshold double, comparison string")
    assert sorted(r.metric_name for r in Q.threshold_breaches(metrics, rules).collect()) == ["a", "c", "d"]


def test_layer_loss(spark):
    df = spark.createDataFrame([(1000, 950), (1000, 900), (10, 11), (0, 0)], "bronze_count long, silver_count long")
    assert [(r.loss_pct, r.acceptable) for r in Q.layer_loss(df).collect()] == [
        (5.0, True), (10.0, False), (-10.0, False), (None, True)]


def test_null_fields_and_dates(spark):
    rows = [("1", "A", "https://example.com/1", "p"), ("2", None, "https://example.com/2", "p"), ("3", "A", None, "p")]
    df = spark.createDataFrame(rows, "id string, title string, url string, published_at string")
    assert sorted((r.record_id, r.field_name) for r in Q.null_fields(df).collect()) == [("2", "title"), ("3", "url")]
    dates = spark.createDataFrame(
        [("1", "2026-02-18"), ("2", "2099-12-31"), ("3", "1950-01-01"), ("4", None)], "content_id string, d string"
    ).withColumn("published_at", F.col("d").cast("timestamp"))
    found = {r.content_id: r.issue for r in Q.suspicious_dates(dates, "2026-02-18").collect()}
    assert found == {"2": "Future date", "3": "Very old date"}


def test_runs_and_checks(spark):
    state = spark.sql("SELECT timestamp'2026-02-18 05:00:00' valid_from, true is_current FROM range(120) UNION ALL"
                      " SELECT timestamp'2026-02-17 05:00:00', true FROM range(3) UNION ALL"
                      " SELECT timestamp'2026-02-18 05:00:00', false FROM range(9)")
    run = Q.record_runs(state, "2026-02-18 06:00:00", "2026-02-18 05:45:00", ingest_date="2026-02-18").first()
    assert (run.records_processed, run.duration_seconds, run.run_status) == (120, 900, "completed")
    assert run.run_id.startswith("2026-02-18-")
    idle = Q.record_runs(state, "2026-02-19 06:00:00", "2026-02-19 05:45:00", ingest_date="2026-02-19").first()
    assert idle.records_processed == 0
    checks = {r.ingest_date.day: r.check_result for r in Q.record_content_checks(state, "2026-02-18 06:00:00").collect()}
    assert checks == {18: "PASS", 17: "WARNING"}
    none = Q.record_content_checks(state, "2026-02-18 06:00:00", ingest_date="2026-02-20").first()
    assert (none.check_result, float(none.check_value), none.error_message) == ("failed", 0.0, "no rows were loaded")
    view = Q.checks_view(Q.record_content_checks(state, "2026-02-18 06:00:00"))
    assert monitoring.failed_checks(view, "2026-02-18", results=("WARNING",)).count() == 1
    assert monitoring.failed_checks(view, "2026-02-18").count() == 0


def test_levels_and_labels(spark):
    counts = {"2026-01-01": 100, "2026-01-02": 50, "2026-01-03": 20, "2026-01-04": 19}
    rows = [(dt.datetime.fromisoformat(d), True) for d, n in counts.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "published_at timestamp, is_current boolean")
    levels = [r.activity_level for r in dashboard.activity_heatmap(df, "2026-01-05").collect()]
    assert levels == ["Low", "Medium", "High", "Very High"]
    loads = spark.createDataFrame([("a", dt.date(2026, 1, 1)), ("b", dt.date(2026, 1, 3)), ("c", dt.date(2026, 1, 4))],
                                  "content_type string, ingest_date date").withColumn("is_current", F.lit(True))
    status = {r.content_type: r.freshness_status for r in monitoring.stale_types(loads, "2026-01-05").collect()}
    assert status == {"a": "ALERT: Stale Data", "b": "WARNING: Data Aging", "c": "OK"}


def test_reports_on_an_empty_table(spark):
    empty = spark.createDataFrame([], (
        "content_id string, content_type string, news_site string, topic_name string, published_at timestamp,"
        " ingest_date date, featured boolean, is_current boolean, title string, image_url string, summary string,"
        " entities string, keywords string"))
    row = dashboard.executive_summary(empty, "2026-01-01").first()
    assert row.total_content == 0 and row.active_sources == 0 and row.latest_content_date is None
    assert {r.null_percentage for r in health.completeness(empty).collect()} == {None}
    assert monitoring.volume_anomalies(empty, "2026-01-01").count() == 0
    assert topics.trending_topics(empty, "2026-01-01").count() == 0


def test_trending_handles_one_sided_topics(spark):
    rows = [("new", "2026-01-09")] * 3 + [("old", "2026-01-02")] * 2 + [("both", "2026-01-09")] * 3 + [("both", "2026-01-01")] * 2
    rows += [("late", "2026-01-10"), ("2024", "2026-01-09")]
    df = spark.createDataFrame(rows, "topic_name string, d string").select(
        "topic_name", F.col("d").cast("timestamp").alias("published_at"), F.lit(True).alias("is_current"))
    found = {r.topic_name: tuple(r)[1:] for r in topics.trending_topics(df, "2026-01-10").collect()}
    assert found == {"new": (3, 0, 3, None), "old": (0, 2, -2, -100.0), "both": (3, 2, 1, 50.0)}


def test_topic_pairs_against_brute_force(spark):
    import itertools
    import random

    random.seed(7)
    rows = [(f"t{random.randrange(5)}", f"s{random.choice([0, 0, 0, 1, 2])}", f"2026-01-0{random.randrange(1, 4)}") for _ in range(400)]
    expected = {}
    for (t1, s1, d1), (t2, s2, d2) in itertools.product(rows, rows):
        if s1 == s2 and d1 == d2 and t1 < t2:
            expected[t1, t2] = expected.get((t1, t2), 0) + 1
    df = spark.createDataFrame(rows, "topic_name string, news_site string, d string").select(
        "topic_name", "news_site", F.col("d").cast("timestamp").alias("published_at"), F.lit(True).alias("is_current"))
    found = {(r.topic1, r.topic2): r.co_occurrence_count for r in advanced.topic_pairs(df).collect()}
    assert found == expected


def test_only_the_newest_load_counts(spark):
    rows = [("2026-01", "A", "x", 5, dt.date(2026, 1, 31)), ("2026-01", "A", "x", 9, dt.date(2026, 2, 28)),
            ("2026-02", "A", "x", 3, dt.date(2026, 2, 28)), ("2026-02", "A", "y", 4, dt.date(2026, 2, 28))]
    df = spark.createDataFrame(rows, "year_month string, topic_name string, content_type string, content_count long, ingest_date date")
    report = [tuple(r) for r in aggregates.topic_trend_report(df, "2026-03-01").collect()]
    assert report == [("2026-02", "A", 7, 3.5), ("2026-01", "A", 9, 9.0)]
    growth = [tuple(r) for r in aggregates.topic_growth(df, "2026-03-01").collect()]
    assert growth == [("2026-02", "A", 7, 9, -2, -22.22), ("2026-01", "A", 9, None, 9, None)]


def test_audit_option_for_closed_rows(spark):
    df = spark.sql("""
        SELECT 'a' content_id, 't' content_type, 1 version, timestamp'2020-01-01 00:00:00' valid_from,
               timestamp'9999-12-31 23:59:59' valid_to, true is_current, 'x' title""")
    assert health.version_audit(df, "2026-01-01").count() == 1
    assert health.version_audit(df, "2026-01-01", closed_only=True).count() == 0


def test_union_fills_missing_columns(spark):
    left = spark.createDataFrame([(1, "x")], "b int, a string")
    right = spark.createDataFrame([(2.5,)], "c double")
    union = union_types([left, right])
    assert union.columns == ["a", "b", "c"]
    assert sorted(map(str, union.collect())) == ["Row(a='x', b=1, c=None)", "Row(a=None, b=None, c=2.5)"]


def test_year_topics_and_coverage(spark):
    df = spark.createDataFrame([("1", "2024", 2024, "t", "mars"), ("2", "Mars", 2024, "t", "")],
                               "id string, topic_name string, published_year int, title string, entities string")
    assert [r.id for r in year_like_topics(df).collect()] == ["1"]
    assert tuple(entity_coverage(df).first()) == (2, 1, 50.0)
