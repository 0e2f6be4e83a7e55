import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewire.fixed_values import ENTITY_NAMES, TOPIC_KEYWORDS
from tidewire.functions import text as X
from tidewire.functions.clock import days_between, hours_between, parse_timestamp
from tidewire.functions.measures import percent, record_hash, rounded_ratio, run_identifier
from tidewire.operators.content import exploded_items
from tidewire.plans import terms

# text, tokens, topic, entities
ENRICHED = [
    ("SpaceX Launches Starship SpaceX successfully launched Starship today.",
     "spacex,launches,starship,spacex,successfully,launched,starship,today", "SpaceX", "starship,spacex"),
    ("A new mission begins", "new,mission,begins", "Science", "iss"),
    ("Artemis crew named", "artemis,crew,named", "Moon", ""),
    ("Starlink", "starlink", "SpaceX", ""),
    ("James Webb telescope images", "james,webb,telescope,images", "Astronomy", "james webb"),
    ("Budget talks resume", "budget,talks,resume", "Other", ""),
    ("Company to start trials", "company,start,trials", "Commercial", ""),
    ("🚀 Lanzamiento Exitoso ñáéíóú", "lanzamiento,exitoso,ñáéíóú", "Other", ""),
    ("NASA and ESA probe Mars, Moon; Earth next", "nasa,and,esa,probe,mars,moon,earth,next", "Mars",
     "nasa,esa,mars,moon,earth"),
    (" ", "", "Other", ""),
]


def brute_topic(text):
    """The scoring rule in plain Python."""
    import re

    lowered = text.lower()
    tokens = {w for w in re.sub(r"[^\w\s]", " ", lowered).split() if len(w) >= 3}
    best, winner = 0, "Other"
    for topic, keywords in TOPIC_KEYWORDS.items():
        score = sum(2 * (k in lowered) + len(tokens & set(k.split())) for k in keywords)
        if score > best:
            best, winner = score, topic
    return winner


def test_enrichment_matches_expected_rows(spark):
    df = spark.createDataFrame([(i, t[0], None) for i, t in enumerate(ENRICHED)], "n int, title string, summary string")
    rows = X.enrich_text(df).orderBy("n").collect()
    # the analysis text is title, a blank and the empty summary
    assert [(r.keywords, r.topic_name, r.entities) for r in rows] == [t[1:] for t in ENRICHED]


def test_topics_match_plain_python_on_dictionary_words(spark):
    words = [k for ks in TOPIC_KEYWORDS.values() for k in ks] + ["start", "dismiss", "the", "database", "James", "webb"]
    texts = [f"{a} {b}, {c}." for a in words for b, c in zip(words[::5], words[3::7])]
    df = spark.createDataFrame([(t, None) for t in texts], "title string, summary string")
    found = X.enrich_text(df).select("title", "topic_name").collect()
    assert {r.title: r.topic_name for r in found} == {t: brute_topic(t) for t in texts}


def test_sql_functions_agree_with_columns(spark):
    X.register_sql_functions(spark)
    spark.createDataFrame([(i, t[0]) for i, t in enumerate(ENRICHED)] + [(99, None)], "n int, t string").createOrReplaceTempView("texts")
    rows = spark.sql(
        "SELECT concat_ws(',', tokenize_text_udf(t)) w, classify_topic_udf(t) c, concat_ws(',', extract_entities_udf(t)) e"
        " FROM texts ORDER BY n"
    ).collect()
    assert [tuple(r) for r in rows] == [t[1:] for t in ENRICHED] + [("", "Other", "")]


def test_token_match_ignores_parts_of_words(spark):
    df = spark.createDataFrame([("A new mission to start", None)], "title string, summary string")
    assert X.enrich_text(df, match="token").first().topic_name == "Science"
    df = spark.createDataFrame([("dismissed starting", None)], "title string, summary string")
    assert X.enrich_text(df, match="substring").first().topic_name == "ISS"
    assert X.enrich_text(df, match="token").first().topic_name == "Other"


def test_entity_records_keep_their_kind(spark):
    df = spark.createDataFrame([("elon musk on mars",)], "t string")
    found = df.select(X.entity_records(F.lower("t"), ENTITY_NAMES).alias("e")).first().e
    assert [(r["type"], r["name"]) for r in found] == [("person", "elon musk"), ("celestial_body", "mars")]


def test_tokenize_edge_cases(spark):
    df = spark.createDataFrame([(None,), ("",), ("a_b c-d l'été naïve 12 345 日本語",)], "t string")
    assert [r[0] for r in df.select(X.tokenize(F.col("t"))).collect()] == [
        [], [], ["a_b", "été", "naïve", "345", "日本語"],
    ]


def test_lists_are_read_whole(spark):
    joined = ",".join(["a", "longer"] + [f"word{i}" for i in range(2000)])
    df = spark.createDataFrame([(joined, "T", True)], "keywords string, topic_name string, is_current boolean")
    assert exploded_items(df, "keywords", "keyword", ["topic_name"]).count() == 2001  # 'a' is too short
    assert terms.top_keywords(df, limit=5000).count() == 2001


def test_items_are_trimmed_and_distinct_within_a_row(spark):
    rows = [("alpha, beta,alpha ,be", "articles", "T", True), (None, "articles", "T", True), ("", "blogs", "U", True)]
    df = spark.createDataFrame(rows, "entities string, content_type string, topic_name string, is_current boolean")
    found = {r.entity: r.mention_count for r in terms.top_entities(df).collect()}
    assert found == {"alpha": 1, "beta": 1}


def test_entity_pairs_against_brute_force(spark):
    lists = ["mars,moon", "moon,mars", "mars,moon,earth", "earth", "", None] * 3
    df = spark.createDataFrame([(e, True) for e in lists], "entities string, is_current boolean")
    found = {(r.entity1, r.entity2): r.co_occurrences for r in terms.entity_pairs(df, min_count=3).collect()}
    assert found == {("mars", "moon"): 6, ("moon", "mars"): 3, ("mars", "earth"): 3, ("moon", "earth"): 3}
    ordered = {(r.entity1, r.entity2): r.co_occurrences for r in terms.entity_pairs(df, 3, canonical=True).collect()}
    assert ordered == {("mars", "moon"): 9, ("earth", "mars"): 3, ("earth", "moon"): 3}


def utc(*parts):
    return dt.datetime(*parts)


TIMES = [
    ("2024-01-01T12:00:00Z", utc(2024, 1, 1, 12), utc(2024, 1, 1, 12)),
    ("2024-01-01T12:00:00.1Z", utc(2024, 1, 1, 12, 0, 0, 100000), utc(2024, 1, 1, 12, 0, 0, 100000)),
    ("2024-01-01T12:00:00.1", utc(2024, 1, 1, 12, 0, 0, 100000), None),
    ("2024-01-01", utc(2024, 1, 1), None),
    ("2024-01-01T12:00:00+02:00", utc(2024, 1, 1, 10), None),
    ("2024-01-01 12:00:00", utc(2024, 1, 1, 12), utc(2024, 1, 1, 12)),
    ("2024-02-30T00:00:00Z", None, None),
    ("2024", None, None), ("12:30", None, None), ("bad", None, None), ("", None, None), (None, None, None),
]


def test_timestamp_policies(spark):
    df = spark.createDataFrame([(i, t[0]) for i, t in enumerate(TIMES)], "n int, t string")
    parsed = df.select("n", parse_timestamp(F.col("t")).cast("timestamp_ntz").alias("lenient"),
                       parse_timestamp(F.col("t"), "strict").cast("timestamp_ntz").alias("strict"))
    assert [(r.lenient, r.strict) for r in parsed.orderBy("n").collect()] == [t[1:] for t in TIMES]


def test_calendar_differences(spark):
    row = spark.sql("SELECT timestamp'2024-01-01 23:00:00' a, timestamp'2024-01-02 01:00:00' b").select(
        days_between(F.col("a"), F.col("b")), hours_between(F.col("a"), F.col("b"))
    ).first()
    assert tuple(row) == (1, 2)


def test_record_hash(spark):
    df = spark.sql("SELECT '1' id, 'A' title, 'https://e.com/1' url, timestamp'2024-01-01 12:00:00' published_at,"
                   " cast(null as string) summary")
    assert df.select(record_hash(df)).first()[0] == "be2339c59904ec79f46bb4582494c3f00a29fb2e19620df5bb61373a6a859904"


@pytest.mark.parametrize("part,whole,digits,expected", [
    (2675, 1000, 2, 2.68), (1, 8, 2, 0.13), (1, 0, 2, None), (-1, 8, 2, -0.13), (1, 3, 3, 0.333), (5, 2, 0, 3.0),
])
def test_rounding_is_half_up_on_exact_values(spark, part, whole, digits, expected):
    assert spark.range(1).select(rounded_ratio(F.lit(part), F.lit(whole), digits)).first()[0] == expected


def test_percent_and_run_identifier(spark):
    row = spark.range(1).select(
        percent(F.lit(1), F.lit(3)), run_identifier(F.lit("2024-01-01").cast("date"), F.lit("x"))
    ).first()
    assert row[0] == 33.33 and row[1].startswith("2024-01-01-") and len(row[1]) == 19


@pytest.mark.parametrize("url,expected", [
    ("HTTPS://EXAMPLE.COM/ARTICLE", "https://example.com/ARTICLE"), ("https://a.b/C?D=E", "https://a.b/C?D=E"),
    ("HTTP://HOST", "http://host"), ("no url", "no url"), (None, None),
])
def test_url_normalising(spark, url, expected):
    assert spark.createDataFrame([(url,)], "u string").select(X.normalize_url(F.col("u"))).first()[0] == expected


@pytest.mark.parametrize("url,good", [
    ("http://a.bc", True), ("http://a.b", False), ("ftp://example.com", False), ("not-a-valid-url", False),
])
def test_web_addresses(spark, url, good):
    assert spark.range(1).select(X.is_web_address(F.lit(url))).first()[0] is good
