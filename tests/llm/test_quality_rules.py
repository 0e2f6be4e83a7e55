import math
import random
from fractions import Fraction

import pytest
from helpers import documents, vocabulary, words
from pyspark.sql import functions as F

from tidewire.llm import quality
from tidewire.llm.queries import op8_quality_rules


def brute(text):
    w, text = words(text), text or ""
    lines = [x for x in text.split("\n") if words(x)]
    seen, again = {}, set()
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            again.update(i + k for i in at for k in range(8))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again)


def texts():
    draw, vocab = random.Random(6), vocabulary(6, 12)
    out = [None, "", " \n\t", "a", "# | <b>\n\n# | <b>\n # | <b>", "x y z w v u t s " * 2, "x y z w v u t s " * 2 + "x", "é ß \x0b😀 & $", "a " * 100_000]
    for _ in range(150):
        out.append(" ".join(draw.choice(vocab) + draw.choice(["", "", "\n", "#", "!"]) for _ in range(draw.randint(0, 80))))
    sentence = " ".join(vocabulary(7, 10))
    return [*out, f"{sentence} x {sentence} y {sentence[:20]}", f"{sentence}\n{sentence}\n{sentence}"]


def test_measures_equal_brute_force(spark):
    found = texts()
    rows = quality.with_measures(documents(spark, found)).collect()
    assert len(rows) == len(found)
    for r in rows:
        m = r[quality.MEASURES]
        got = (m["n_words"], m["word_chars"], m["n_symbols"], m["lines"]["again"], m["n_repeat_words"])
        assert got == brute(found[r["doc_id"]]), repr(found[r["doc_id"]])[:80]


def exact_tail(k, n, p):
    p = Fraction(p)
    return float(sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))


def test_binomial_tail(spark):
    cases = [(0, 10), (0, 1), (3, 400), (10, 5000), (200, 50_000), (0, 31), (0, 32), (1, 33)]
    frame = spark.createDataFrame(cases, "k long, n long")
    for r in frame.withColumn("tail", quality.binomial_tail(F.col("k"), F.col("n"), 0.0078125)).collect():
        want = 1.0 if r["k"] >= r["n"] * 0.0078125 else exact_tail(r["k"], r["n"], 0.0078125)
        assert r["tail"] == pytest.approx(want, rel=1e-7)
    few = frame.withColumn("tail", quality.binomial_tail(F.col("k"), F.col("n"), 0.0078125, terms=40))
    assert all(r["tail"] >= exact_tail(r["k"], r["n"], 0.0078125) * (1 - 1e-9) for r in few.filter("k = 200").collect())


def labelled(spark, n=12_000):
    """In stratum a shouting marks bad documents; in b it doesn't; c has few labels."""
    draw, vocab, rows = random.Random(8), vocabulary(9, 40), []
    for i in range(n):
        lang, bad = ("a", "b", "c")[0 if i % 2 else 1 if i % 200 else 2], draw.random() < 0.2
        loud = bad if lang == "a" else draw.random() < 0.3
        text = " ".join(draw.choice(vocab) + ("!!" if loud else "") for _ in range(25))
        rows.append((i, text, lang, 0 if bad else 1))
    docs = documents(spark, [r[1] for r in rows], langs=[r[2] for r in rows])
    return docs, spark.createDataFrame([(r[0], r[3], 0) for r in rows], "doc_id long, quality int, toxic int"), rows


def test_cutoffs_hold_their_guarantee(spark):
    docs, labels, rows = labelled(spark)
    measured = quality.with_measures(docs)
    cutoffs = quality.learn_cutoffs(measured, labels)
    found = {r["stratum"]: r.asDict() for r in cutoffs.collect()}
    assert set(found) == {"a"} and found["a"]["marks_per_word"] is not None
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(measured, cutoffs).collect()}
    good = [i for i, _, lang, q in rows if lang == "a" and q]
    assert sum(not kept[i] for i in good) <= 0.02 * len(good)
    assert not any(kept[i] for i, _, lang, q in rows if lang == "a" and not q)
    assert all(kept[i] for i, _, lang, _ in rows if lang != "a")


def test_unsure_rules_get_no_cutoff(spark):
    docs, labels, _ = labelled(spark, 300)
    assert quality.learn_cutoffs(quality.with_measures(docs), labels).collect() == []


def test_nulls_extra_columns_and_empty_tables(spark, tmp_path):
    docs = documents(spark, texts()[:12], ids=[None, 1, 1, *range(2, 11)], langs=[None] * 12, extra=("kept", "stratum", "rule", "good", "n"))
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    measured = quality.with_measures(docs)
    rows = quality.judge(measured, quality.learn_cutoffs(measured, labels), kept="quality_kept").collect()
    assert len(rows) == 12 and not any(r["quality_kept"] for r in rows if len(words(r["text"])) < 20)
    for name, frame in (("documents", documents(spark, [])), ("labels", labels.limit(0))):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    assert op8_quality_rules(spark, str(tmp_path)).collect() == []


def test_plan_is_native(spark):
    measured = quality.with_measures(documents(spark, ["a"]))
    cutoffs = quality.learn_cutoffs(measured, spark.createDataFrame([(0, 1)], "doc_id long, quality int"))
    plan = quality.judge(measured, cutoffs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("PythonUDF", "ArrowEval", "InPandas", "InArrow"))


def test_small_strata_learn_too(spark):
    """Four strata with some 480 good labels each, half of them held out, in which only marks tell bad documents."""
    draw, vocab, rows = random.Random(12), vocabulary(12, 40), []
    for i in range(2400):
        bad = draw.random() < 0.2
        text = " ".join(draw.choice(vocab) + ("!!" if bad else "") for _ in range(25))
        rows.append((i, text, "abcd"[i % 4], 0 if bad else 1))
    docs = documents(spark, [r[1] for r in rows], langs=[r[2] for r in rows])
    labels = spark.createDataFrame([(r[0], r[3], 0) for r in rows], "doc_id long, quality int, toxic int")
    measured = quality.with_measures(docs)
    cutoffs = quality.learn_cutoffs(measured, labels)
    assert {r["stratum"] for r in cutoffs.collect() if r["marks_per_word"] is not None} == set("abcd")
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(measured, cutoffs).collect()}
    assert all(kept[i] == bool(q) for i, _, _, q in rows)
