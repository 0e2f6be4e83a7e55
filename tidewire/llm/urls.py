"""URL filter by association rules, native throughout.

Labelled URLs become transactions of tokens plus their label. FP-growth finds the frequent combinations; rules whose
consequent is a label are pruned by support and confidence, and by any rule with fewer tokens that is as sure. The
kept rules are an inverted index: each is filed under its rarest token, a URL looks up its tokens and tests only the
rules filed there.

A list of (verdict, host, path) rules goes first: the longest that fits decides. URLs that neither a list rule nor a
mined rule decides are allowed. Null URLs, and those without ``://``, have empty host and path and no tokens. Without
labels, or with no combination frequent and sure enough, nothing is mined and the list decides alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialized
from .words import bounded

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LABEL = "label="


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 2)


def tokens(url: Column) -> Column:
    """Host labels, the host without its first label, path segments, file endings and parameter names, each once."""
    labels = F.filter(F.split(host(url), r"\."), lambda x: x != "")
    segments = F.filter(F.split(path(url), "[/._-]"), lambda x: x != "")
    params = F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit(r"[?&]([^=&#]+)"), 1)
    return F.array_distinct(F.concat(
        F.transform(labels, lambda x: F.concat(F.lit("host:"), x)),
        F.when(F.size(labels) > 2, F.array(F.concat(F.lit("site:"), F.array_join(F.slice(labels, -2, 2), "."))))
        .otherwise(F.array().cast("array<string>")),
        F.transform(segments, lambda x: F.concat(F.lit("path:"), x)),
        F.transform(params, lambda x: F.concat(F.lit("param:"), x)),
    ))


def listed(host_: Column, path_: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest list rule that fits, as struct(length, rule, verdict); null if none does.

    A rule (verdict, host, path) fits its host and all subdomains if the path starts with the rule's.
    """
    fits = [
        F.when(
            ((host_ == h) | F.endswith(host_, F.lit(f".{h}"))) & F.startswith(path_, F.lit(p)),
            F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for v, h, p in rules
    ]
    return F.array_max(F.array(*fits))


def mine(
    labelled: DataFrame,
    *,
    min_support: float = 0.005,
    min_confidence: float = 0.5,
    url: str = "url",
    label: str = "bad",
) -> DataFrame:
    """(rule_id, tokens, verdict, confidence, support, anchor) from URLs with a boolean label (null: not used)."""
    spark = labelled.sparkSession
    items = labelled.filter(F.col(label).isNotNull()).select(
        F.array_append(tokens(F.col(url)), F.when(F.col(label), LABEL + BLOCK).otherwise(LABEL + ALLOW)).alias("items")
    )
    items = materialized(spark, items, "url-items")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    single = model.freqItemsets.filter(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    verdict = F.replace(F.col("consequent")[0], F.lit(LABEL), F.lit(""))
    sure = materialized(
        spark,
        model.associationRules.filter(F.startswith(F.col("consequent")[0], F.lit(LABEL))).select(
            F.xxhash64(F.array_sort("antecedent"), verdict).alias("rule_id"), F.array_sort("antecedent").alias("tokens"),
            verdict.alias("verdict"), "confidence", "support",
        ),
        "url-rules",
    )
    # A rule is needless if one of its tokens can go without loss of confidence.
    shorter = sure.filter(F.size("tokens") > 1).select(
        "rule_id", "verdict", "confidence",
        F.explode(F.transform("tokens", lambda t: F.array_remove(F.col("tokens"), t))).alias("tokens"),
    )
    needless = shorter.alias("a").join(sure.alias("b"), ["tokens", "verdict"]).filter(
        "b.confidence >= a.confidence"
    ).select("a.rule_id").distinct()
    kept = sure.join(needless, "rule_id", "left_anti")
    anchors = kept.select("rule_id", F.explode("tokens").alias("token")).join(single, "token").groupBy("rule_id").agg(
        F.min_by("token", F.struct("freq", "token")).alias("anchor")
    )
    return materialized(spark, kept.join(anchors, "rule_id"), "url-index")


def judged(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """(url, mined): the different URLs for which the surest mined rule that fits says block."""
    different = urls.select(F.col(url)).filter(F.col(url).isNotNull()).distinct().withColumn("url_tokens", tokens(F.col(url)))
    probes = different.select(url, "url_tokens", F.explode("url_tokens").alias("anchor"))
    found = probes.join(bounded(rules), "anchor").filter(
        F.size(F.array_intersect("tokens", "url_tokens")) == F.size("tokens")
    )
    return found.groupBy(url).agg(F.max(F.struct("confidence", "support", "verdict"))["verdict"].alias("mined")).filter(
        F.col("mined") == BLOCK
    )


def filter_urls(
    urls: DataFrame,
    labelled: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    *,
    key: str = "page_id",
    url: str = "url",
    **mining,
) -> DataFrame:
    """(key, host, path, rule, verdict) for every row: the list's verdict, else the mined one, else allow."""
    mined = materialized(urls.sparkSession, judged(urls, mine(labelled, url=url, **mining), url), "url-verdicts")
    parts = urls.select(F.col(key), F.col(url), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    best = parts.withColumn("best", listed(F.col("host"), F.col("path"), rules))
    return best.join(bounded(mined), url, "left").select(
        key, "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.col("mined"), F.lit(ALLOW)).alias("verdict"),
    )
