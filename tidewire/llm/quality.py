"""Quality rules with risk-controlled cutoffs, native throughout.

Each rule rejects a document whose measure is above a cutoff. Cutoffs come from labelled documents, per stratum. One
half of the labels (by hash of the id) tells which cutoffs catch more bad documents than good ones. The other half is
the holdout: from lax to strict, a cutoff passes while the exact binomial bound says that, at the confidence asked for,
it rejects at most ``risk / number of rules`` of the good documents; the first failure ends the sequence. Only rules for
which the tuning half leaves the stratum a cutoff count there, and only their sequences share the error probability; as
the holdout has no part in that choice, all guarantees hold together, and all rules together falsely reject at most
``risk``. A stratum with too few labels gets no cutoff and loses nothing.

Null texts have no words. Null strata are a stratum of their own. Repeated labels of a document count once, as bad if
one of them is; labels with a null id or quality are not used. Documents with a null id are judged, but teach nothing.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialized
from .words import BLANKS, bound, bounded, word_array

WINDOW = 8
MEASURES = "quality_measures"

# What a rule measures, and the cutoffs it may take, from lax to strict.
RULES = {
    "symbols_per_word": (2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1),
    "marks_per_word": (3.0, 2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1),
    "capitals_share": (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2),
    "repeat_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1),
    "dup_line_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1),
    "mean_word_length": (50.0, 40.0, 30.0, 25.0, 20.0, 16.0, 14.0, 12.0, 11.0, 10.0),
}


def _kept_chars(text: Column, others: str) -> Column:
    return F.char_length(F.regexp_replace(text, others, "")).cast("long")


def _repeated_words(words: Column) -> Column:
    """Words inside windows of 8 that occur twice or more; windows are compared by a 64-bit hash."""

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = bound(pairs, lambda p: F.filter(
            p, lambda x, j: F.coalesce(F.get(p, j - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(p, j + 1)["h"] == x["h"], F.lit(False)),
        ))
        starts = F.sort_array(F.transform(again, lambda x: x["i"]))
        return bound(starts, lambda s: F.aggregate(
            F.transform(s, lambda x, j: F.least(F.coalesce(F.get(s, j + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))),
            F.lit(0), lambda a, b: a + b,
        ))

    hashes = F.when(F.size(words) > WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    ))
    return bound(hashes, lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h), covered(h)
    ).otherwise(0))


def measures(text: Column) -> Column:
    """struct of counts: words, code points in words, symbols, lines with a word, repeated lines, repeated words, ..."""

    def counted(raw: Column) -> Column:
        lines = F.filter(F.split(raw, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
        return bound(word_array(raw), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _kept_chars(raw, "[^#*$%&|<>]+").alias("n_symbols"),
            _kept_chars(raw, "[^!?]+").alias("n_marks"),
            _kept_chars(raw, r"[^\p{Lu}]+").alias("n_capitals"),
            bound(lines, lambda x: F.struct(
                F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("again")
            )).alias("lines"),
            F.coalesce(_repeated_words(w), F.lit(0)).cast("long").alias("n_repeat_words"),
        ))

    return bound(F.coalesce(text, F.lit("")), counted)


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns and the measures, as a written table: texts are read and measured once."""
    return materialized(docs.sparkSession, docs.withColumn(MEASURES, measures(F.col(text))), "quality-measures")


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])


def rule_values(m: Column) -> dict[str, Column]:
    words = F.greatest(m["n_words"], F.lit(1)).cast("double")
    return {
        "symbols_per_word": m["n_symbols"] / words,
        "marks_per_word": m["n_marks"] / words,
        "capitals_share": m["n_capitals"] / F.greatest(m["word_chars"], F.lit(1)).cast("double"),
        "repeat_share": m["n_repeat_words"] / words,
        "dup_line_share": m["lines"]["again"] / F.greatest(m["lines"]["n"], F.lit(1)).cast("double"),
        "mean_word_length": m["word_chars"] / words,
    }


def log_factorial(n: Column) -> Column:
    """ln(n!): exact values below 32, Stirling's series from there (error under 1e-13)."""
    small = F.array(*[F.lit(math.lgamma(i + 1)) for i in range(32)])
    x = F.greatest(n, F.lit(1)).cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x * x * x)
    return F.coalesce(F.get(small, F.when(n < 32, n).cast("int")), series)


def binomial_tail(k: Column, n: Column, p: Column | float, terms: int = 4000) -> Column:
    """P(X <= k) for X of n trials with probability p; 1 where k is at or above n p, where no bound can hold.

    Terms are added from k downwards, where they fall at least as fast as a geometric row; beyond ``terms`` of them the
    row's sum stands for the rest, so the value is never too small.
    """
    p = F.lit(p)
    odds = (1 - p) / p
    last = F.least(k, F.lit(terms))
    summed = F.aggregate(
        F.sequence(F.lit(0).cast("long"), last),
        F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda acc, j: F.struct(
            (acc["term"] * (k - j) / (n - k + j + 1) * odds).alias("term"), (acc["sum"] + acc["term"]).alias("sum")
        ),
        lambda acc: acc["sum"] + F.when(k > terms, acc["term"] / (1 - k / (n - k + 1) * odds)).otherwise(0.0),
    )
    first = log_factorial(n) - log_factorial(k) - log_factorial(n - k) + k * F.log(p) + (n - k) * F.log1p(-p)
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(first) * summed)


def learn_cutoffs(
    measured: DataFrame, labels: DataFrame, *, key: str = "doc_id", stratum: str = "lang", label: str = "quality",
    risk: float = 0.02, delta: float = 0.05,
) -> DataFrame:
    """(stratum, *rules): the strictest cutoff that each rule may take, null for none; a small written table.

    ``measured``: key, stratum and measures. ``labels``: key and a quality of 1 (good) or 0 (bad).
    """
    spark = measured.sparkSession
    truth = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(
        F.min(label).alias("good")
    )
    values = rule_values(F.col(MEASURES))
    known = measured.select(F.col(key), F.col(stratum).alias("stratum"), base_failed(F.col(MEASURES)).alias("failed"),
                            *[v.alias(r) for r, v in values.items()]).join(truth, key)
    tests = F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(i).alias("step"), F.lit(c).alias("cutoff"), (F.col(rule) > c).alias("over"))
        for rule, cutoffs in RULES.items() for i, c in enumerate(cutoffs)
    ]))
    good, held = F.col("good") == 1, F.abs(F.xxhash64(F.lit("holdout"), F.col(key)) % 2) == 1
    count = lambda what: F.sum(F.when(what, 1).otherwise(0)).cast("long")
    table = known.filter("NOT failed").select("stratum", good.alias("good"), held.alias("held"), tests.alias("t")).select(
        "stratum", "good", "held", "t.*"
    ).groupBy("stratum", "rule", "step", "cutoff").agg(
        count(F.col("good") & F.col("held")).alias("n"),
        count(F.col("good") & F.col("held") & F.col("over")).alias("k"),
        count(F.col("good") & ~F.col("held") & F.col("over")).alias("tuned_good"),
        count(~F.col("good") & ~F.col("held") & F.col("over")).alias("tuned_bad"),
    )
    table = materialized(spark, table, "quality-counts")
    table = table.filter(F.col("tuned_bad") > F.col("tuned_good"))
    sequences = max(1, table.select("stratum", "rule").distinct().count())
    rules = F.size(F.collect_set("rule").over(Window.partitionBy("stratum")))
    line = Window.partitionBy("stratum", "rule").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    admitted = table.withColumn("rules", rules).withColumn(
        "admitted", F.min(
            (binomial_tail(F.col("k"), F.col("n"), risk / F.col("rules")) <= delta / sequences).cast("int")
        ).over(line)
    ).filter("admitted = 1")
    return materialized(
        spark, admitted.groupBy("stratum").pivot("rule", list(RULES)).agg(F.min("cutoff")), "quality-cutoffs"
    )


def judge(measured: DataFrame, cutoffs: DataFrame, *, stratum: str = "lang", kept: str = "kept") -> DataFrame:
    """Adds a boolean column: false for documents that the base rules or a cutoff of their stratum rejects."""
    own = {r: f"quality_cutoff_{r}" for r in RULES}
    table = cutoffs.select(F.col("stratum").alias("quality_stratum"), *[F.col(r).alias(c) for r, c in own.items()])
    over = reduce(
        Column.__or__, [F.coalesce(v > F.col(own[r]), F.lit(False)) for r, v in rule_values(F.col(MEASURES)).items()]
    )
    return measured.join(bounded(table), F.col(stratum).eqNullSafe(F.col("quality_stratum")), "left").withColumn(
        kept, ~(base_failed(F.col(MEASURES)) | over)
    ).drop("quality_stratum", *own.values())
