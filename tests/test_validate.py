import json

import pytest
from pyspark.sql import functions as F

from tidewire.functions.measures import text_flag
from tidewire.operators import validate as V
from tidewire.operators.dedup import deduplicate_by_key, duplicate_keys, latest_content

GOOD = {
    "id": 1, "title": "A", "url": "https://example.com/1", "image_url": None, "news_site": "S", "summary": "x",
    "published_at": "2026-02-18T10:00:00Z", "updated_at": None, "featured": False, "launches": None, "events": None,
}


def reason_of(spark, endpoint, record):
    line = record if isinstance(record, str) else json.dumps(record)
    return V.validate_raw(spark.createDataFrame([(line,)], "value string"), endpoint).first()["_error_reason"]


SILVER = [
    ("1", "A", "https://example.com/1", "2026-02-18T10:00:00Z", None),
    (None, "A", "https://example.com/1", "2026-02-18T10:00:00Z", "Missing required field: id"),
    ("3", "", None, "bad", "Missing required field: title"),
    ("4", "A", "https://example.com/4", "", "Missing required field: published_at"),
    ("5", "A", "https://example.com/5", "bad", "Invalid timestamp format for published_at"),
]


def test_silver_reasons(spark):
    df = spark.createDataFrame(SILVER, "id string, title string, url string, published_at string, expected string")
    valid, invalid = V.validate_record(df)
    assert [r.id for r in valid.collect()] == ["1"]
    assert "_error_reason" not in valid.columns
    assert all(r["_error_reason"] == r.expected for r in invalid.collect())
    assert valid.count() + invalid.count() == df.count()


def test_numeric_id_does_not_raise(spark):
    df = spark.createDataFrame([(7, "A", "u", "2026-02-18")], "id long, title string, url string, published_at string")
    assert V.validate_record(df)[0].count() == 1


@pytest.mark.parametrize("change,expected", [
    ({}, None),
    ({"title": ""}, None),
    ({"title": None}, "Missing required field: title"),
    ({"url": "not-a-valid-url"}, "Invalid URL format for field: url"),
    ({"published_at": "2026-02-18"}, "Invalid timestamp format for field: published_at"),
    ({"published_at": 20260218}, "Invalid timestamp format for field: published_at"),
    ({"updated_at": "yesterday"}, "Invalid timestamp format for field: updated_at"),
    ({"image_url": "ftp://x.example.com"}, "Invalid URL format for field: image_url"),
    ({"launches": "none"}, "Field should be array: launches"),
    ({"launches": "[1]"}, "Field should be array: launches"),
    ({"launches": []}, None),
    ({"events": [{"id": "e"}]}, None),
    ({"authors": {"name": "x"}}, "Field should be array: authors"),
    ({"published_at": "2099-12-31T23:59:59Z"}, None),
    ({"published_at": "1957-10-04T00:00:00Z"}, None),
    ({"title": "🚀 ñáéíóú &amp; &lt;tags&gt;"}, None),
    ({"url": "no", "published_at": "no"}, "Invalid timestamp format for field: published_at"),
])
def test_article_rules(spark, change, expected):
    assert reason_of(spark, "articles", {**GOOD, **change}) == expected


def test_rules_differ_by_endpoint(spark):
    wrong = {**GOOD, "launches": "none", "authors": "none"}
    assert reason_of(spark, "blogs", wrong) == "Field should be array: launches"
    assert reason_of(spark, "blogs", {**GOOD, "authors": "none"}) is None
    assert reason_of(spark, "reports", wrong) is None
    assert reason_of(spark, "info", {"news_sites": ["a"]}) == "Missing required field: version"
    assert reason_of(spark, "info", {"version": "4", "news_sites": "a"}) == "Field should be array: news_sites"
    assert reason_of(spark, "articles", "{broken") == "Malformed record"
    with pytest.raises(ValueError):
        V.ingest_reason("podcasts", F.lit(None))


def test_missing_field_is_a_missing_value(spark):
    record = dict(GOOD)
    del record["url"]
    assert reason_of(spark, "articles", record) == "Missing required field: url"


def test_batch_split_adds_reason_and_time(spark):
    lines = spark.createDataFrame([(json.dumps(GOOD),), (json.dumps({**GOOD, "id": None}),)], "value string")
    valid, invalid = V.validate_batch(lines, "articles", "2026-02-18 00:00:00")
    assert valid.count() == 1
    row = invalid.first()
    assert row["_error_reason"] == "Missing required field: id" and row["_validation_timestamp"].year == 2026
    totals = V.validation_totals(V.validate_raw(lines, "articles")).first()
    assert (totals.total_records, totals.valid_count, totals.invalid_count) == (2, 1, 1)


def test_quarantine_keeps_the_record(spark):
    df = spark.createDataFrame(SILVER, "id string, title string, url string, published_at string, expected string")
    rows = V.to_quarantine(V.validate_record(df)[1], "2026-02-18 00:00:00").collect()
    assert {json.loads(r.raw_payload)["_error_reason"] for r in rows} == {t[4] for t in SILVER if t[4]}


def test_site_check(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "news_site string")
    sites = spark.createDataFrame([("A",), ("A",), (None,)], "news_site string")
    flags = {r.news_site: r.news_site_validated for r in V.with_site_check(df, sites).collect()}
    assert flags == {"A": True, "B": False, None: False}
    assert {r.news_site_validated for r in V.with_site_check(df, None).collect()} == {None}
    assert {r.news_site_validated for r in V.with_site_check(df, sites.limit(0)).collect()} == {None}
    assert V.with_site_check(df, sites).count() == 3


def test_normalising_and_flags(spark):
    df = spark.createDataFrame(
        [("  Test Article  ", "  Orbit Daily  ", "  Test summary  ", "HTTPS://EXAMPLE.COM/ARTICLE")],
        "title string, news_site string, summary string, url string",
    )
    assert tuple(V.normalize_content(df).first()) == (
        "Test Article", "Orbit Daily", "Test summary", "https://example.com/ARTICLE")
    rows = spark.sql("""
        SELECT repeat('A', 501) title, 'Short' summary, timestamp'2099-12-31 00:00:00' published_at UNION ALL
        SELECT repeat('A', 500), 'long enough', timestamp'1957-10-04 00:00:00' UNION ALL
        SELECT NULL, NULL, NULL""")
    flags = [tuple(r)[3:] for r in V.content_flags(rows, "2026-02-18").collect()]
    assert flags == [(True, True, True, False), (False, False, False, True), (False, False, False, False)]


def test_text_flag(spark):
    df = spark.createDataFrame([("True",), ("true",), ("1",), ("TRUE",), ("0",), (None,)], "f string")
    assert [r[0] for r in df.select(text_flag(F.col("f"))).collect()] == [True, True, True, False, False, False]


def test_dedup_order_and_ties(spark):
    rows = [
        ("a", "k", "2024-01-02", "2024-01-01", "h1"), ("a", "k", None, "2024-09-09", "h2"),
        ("a", "k", "2024-01-02", "2024-01-01", "h9"), ("a", "m", None, "2024-01-01", "h3"),
        ("a", "m", None, "2024-01-05", "h4"),
    ]
    df = spark.createDataFrame(rows, "content_type string, content_id string, updated_at string, published_at string, record_hash string")
    for parts in (1, 8):
        kept = {r.content_id: r.record_hash for r in latest_content(df.repartition(parts)).collect()}
        assert kept == {"k": "h9", "m": "h4"}
    first = deduplicate_by_key(df, ["content_id"], "published_at", ascending=True, tie_breaks=["record_hash"])
    assert {r.content_id: r.record_hash for r in first.collect()} == {"k": "h1", "m": "h3"}
    assert {(r.content_id, r.copies) for r in duplicate_keys(df, ["content_id"]).collect()} == {("k", 3), ("m", 2)}
