import pytest
from pyspark.sql import functions as F

from tidewire.llm import urls
from tidewire.llm.queries import URL_RULES


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min([i for i in map(rest.find, "?#") if i >= 0], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


def listed(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = [
    None, "", "x", "://", "http://A.Org/x?y#z", "http://example.org/es/1", "http://www.EXAMPLE.org/en/12", "http://badexample.org/es/",
    "https://h.com/fr/a/de/", "https://h.com/de", "https://h.com/de/", "http://x.com?/de/", "http://x.com#/de/", "ftp://a://b.org/", "http://É.org/",
    "http://org", "http://org/", "http://b.org/\n/x", "http://u@h.org:80/es/",
]
SCHEMA = "page_id long, url string, html string"


def pages(spark, found, **extra):
    frame = spark.createDataFrame([(i, u, "h") for i, u in enumerate(found)], SCHEMA)
    return frame.withColumn("host", F.lit("x")).withColumn("verdict", F.lit(1)).withColumn("tokens", F.lit(2))


def no_labels(spark):
    return spark.createDataFrame([], "url string, bad boolean")


def test_parts_and_rules(spark):
    rows = urls.filter_urls(pages(spark, URLS), no_labels(spark), URL_RULES).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        host, path = parsed(URLS[r["page_id"]])
        rule, verdict = listed(host, path)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow"), URLS[r["page_id"]]


def labelled(spark, n=400):
    """Tracking paths on one site are bad; the site alone and the path alone are not."""
    rows = []
    for i in range(n):
        site, part = ("ads.net", "news.net")[i % 2], ("track", "read")[i // 2 % 2]
        rows.append((f"http://www.{site}/{part}/{i}", site == "ads.net" and part == "track"))
    return spark.createDataFrame([*rows, (None, True), ("http://x.net/", None)], "url string, bad boolean")


def test_mined_rules_are_combinations(spark):
    rules = urls.mine(labelled(spark), min_confidence=0.8)
    blocking = [r for r in rules.collect() if r["verdict"] == "block"]
    assert blocking and all({"site:ads.net", "host:ads"} & set(r["tokens"]) and "path:track" in r["tokens"] for r in blocking)
    assert all(r["confidence"] >= 0.8 and r["anchor"] in r["tokens"] and len(r["tokens"]) == 2 for r in blocking)


def test_mined_verdicts(spark):
    found = ["http://www.ads.net/track/9999", "http://www.ads.net/read/1", "http://www.news.net/track/1", "http://other.net/", None]
    found = found + found  # repeated rows
    rows = urls.filter_urls(pages(spark, found), labelled(spark), URL_RULES, min_confidence=0.8).collect()
    assert {r["page_id"]: r["verdict"] for r in rows} == {i: "block" if i % 5 == 0 else "allow" for i in range(10)}


def test_empty_table_and_long_url(spark):
    assert urls.filter_urls(pages(spark, []), labelled(spark), URL_RULES).collect() == []
    long = "http://h.net/" + "a/" * 20_000
    assert urls.filter_urls(pages(spark, [long]), labelled(spark), URL_RULES).first()["verdict"] == "allow"


@pytest.mark.parametrize("part", ["PythonUDF", "ArrowEval", "InPandas", "InArrow"])
def test_plan_is_native(spark, part):
    plan = urls.filter_urls(pages(spark, URLS), labelled(spark), URL_RULES)._jdf.queryExecution().toString()
    assert part not in plan
