"""Large dictionaries give the same rows as a search for each name."""

import itertools
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewire.functions import dictionary as D
from tidewire.functions import text as X


@settings(deadline=None, max_examples=200)
@given(st.sets(st.text("abc.é$", min_size=1, max_size=5), min_size=1, max_size=40), st.text("abc.é$", max_size=30))
def test_tree_pattern_finds_the_longest_name_at_each_place(names, text):
    found = {m[1] for m in re.finditer(f"(?=({D.tree_pattern(names)}))", text)}
    longest = {max((n for n in names if text.startswith(n, k)), key=len, default=None) for k in range(len(text))} - {None}
    assert found == longest


def dictionary(seed, n):
    draw = random.Random(seed)
    syllables = ["ma", "ars", "moon", "lu", "nar", "x", "ß", "of", "the", ".", "re", "st"]
    return list(dict.fromkeys("".join(draw.choice(syllables) for _ in range(draw.randint(1, 4))) for _ in range(n)))


def texts(names, seed=4):
    draw = random.Random(seed)
    pieces = [*names[:60], "marsmoon", "other", "words", "lunar", "moonrest"]
    return [None, "", *("".join(draw.choice([*pieces, " ", ", "]) for _ in range(draw.randint(1, 25))) for _ in range(150))]


def test_names_against_a_search_for_each(spark):
    names = dictionary(1, 400)
    assert len(names) > D.LARGE and any(a != b and a.startswith(b) for a, b in itertools.product(names, names))
    said = texts(names)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(said)], "n int, t string")
    rows = df.select("n", D.names_in_order(F.col("t"), names).alias("a"), X.entity_list(F.col("t"), {"kind": names}).alias("b")).collect()
    for r in rows:
        expected = [n for n in names if n in (said[r.n] or "")]
        assert r.a == expected and r.b == ",".join(expected)


def test_topics_against_the_small_form(spark, monkeypatch):
    names = [n for n in dictionary(2, 300) if "." not in n]
    topics = {f"T{k}": names[k::40] + [f"{names[k]} {names[-1 - k]}", "the moon"][: 1 + k % 2] for k in range(40)}
    df = spark.createDataFrame([(t, None) for t in texts(names)], "title string, summary string")
    large = {match: X.enrich_text(df, topics=topics, match=match).collect() for match in ("substring", "token")}
    monkeypatch.setattr(X, "LARGE", 10_000)
    for match, rows in large.items():
        small = X.enrich_text(df, topics=topics, match=match).collect()
        assert [(r.title, r.topic_name, r.keywords) for r in rows] == [(r.title, r.topic_name, r.keywords) for r in small]
        assert len({r.topic_name for r in rows}) > 5


def test_names_that_are_keywords_and_entities_are_searched_once(spark):
    names = [f"name{n}x" for n in range(D.LARGE + 20)] + ["two words"]
    topics = {"A": names[::2], "B": names[1::2]}
    rows = spark.createDataFrame([("a NAME7x and", "two words name118x"), (None, None), ("", "name1")], "title string, summary string")
    one, other = X.enrich_text(rows, topics, topics), X.enrich_text(rows, topics, {"E": [*names[::2], *names[1::2], "absent"]})
    assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))
    searches = [str(d._jdf.queryExecution().optimizedPlan().toString()).count("(?=(") for d in (one, other)]
    assert searches[0] == searches[1] - 1
