import hashlib
import random

import pytest
from helpers import documents, vocabulary, words
from pyspark.sql import functions as F

from tidewire.llm import fingerprints


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(a, b):
    h = len(a) // 2
    return a[: len(a) - h] + b[:h]


def texts(n=120):
    draw, vocab = random.Random(11), vocabulary(11, 3000)
    out = [None, "", "one two", "one two", "a b c d e", "😀é " * 40, " \n ", "x" * 50_000, "w " * 60_000]
    while len(out) < n:
        if out[-1] and draw.random() < 0.5:
            w = out[-1].split()
            for _ in range(draw.randint(0, 12)):
                w[draw.randrange(len(w))] = draw.choice(vocab)
            out.append(" ".join(w))
        else:
            out.append(" ".join(draw.choice(vocab) for _ in range(draw.randint(1, 900))))
    return out


def check(rows, ordered):
    """``ordered``: (id, text) in the order of the successors."""
    by_text = {}
    for k, (i, t) in enumerate(ordered):
        t, follower = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        r = rows[k]
        assert r["doc_id"] == i and r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256(edited(t, follower).encode()).hexdigest()
        assert by_text.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        if edited(t, follower) == t:
            assert r["fingerprint"] == r["edited_fingerprint"] and r["near_edited"] == 1.0
        assert abs(r["near_edited"] - jaccard(t, edited(t, follower))) < 0.25
        assert abs(r["near_next"] - jaccard(t, follower)) < 0.25
        assert len(r["fingerprint"]) == (2 * fingerprints.BINS if words(t) else 0)


def test_rows_over_many_ranges(spark):
    found = texts()
    docs = documents(spark, found, ids=[3 * i for i in range(len(found))], extra=("bucket", "copy", "tie", "next_text", "home"))
    rows = sorted(fingerprints.compare_edited(docs).collect(), key=lambda r: r["doc_id"])
    check(rows, [(3 * i, t) for i, t in enumerate(found)])


def test_estimates_are_unbiased(spark):
    draw, vocab = random.Random(12), vocabulary(12, 5000)
    pairs = []
    for _ in range(150):
        w = [draw.choice(vocab) for _ in range(200)]
        other = w[:140] + [draw.choice(vocab) for _ in range(60)]
        pairs.append((" ".join(w), " ".join(other)))
    frame = spark.createDataFrame(pairs, "a string, b string")
    got = frame.select(fingerprints.likeness(fingerprints.fingerprint(F.col("a")), fingerprints.fingerprint(F.col("b"))).alias("j")).collect()
    error = [r["j"] - jaccard(a, b) for r, (a, b) in zip(got, pairs, strict=True)]
    assert abs(sum(error) / len(error)) < 0.015


def test_short_texts_share_filled_bins_evenly(spark):
    draw, vocab = random.Random(13), vocabulary(13, 5000)
    base = [" ".join(draw.choice(vocab) for _ in range(24)) for _ in range(200)]
    pairs = [(t, t + " " + " ".join(draw.choice(vocab) for _ in range(10))) for t in base]
    frame = spark.createDataFrame(pairs, "a string, b string")
    got = frame.select(fingerprints.likeness(fingerprints.fingerprint(F.col("a")), fingerprints.fingerprint(F.col("b"))).alias("j")).collect()
    error = [r["j"] - jaccard(a, b) for r, (a, b) in zip(got, pairs, strict=True)]
    assert abs(sum(error) / len(error)) < 0.03


def test_null_and_repeated_ids(spark):
    docs = documents(spark, ["b b b b b b", "a a a a a a", "c c", None], ids=[1, 1, None, 0])
    rows = fingerprints.compare_edited(docs).collect()
    assert len(rows) == 4 and sorted(r["n_chars"] for r in rows) == [0, 3, 11, 11]
    ordered = sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    assert ordered[-1]["edited_sha256"] == hashlib.sha256(b"c ").hexdigest()  # the null id comes last; the first is empty


def test_empty_table_and_one_row(spark):
    assert fingerprints.compare_edited(documents(spark, [])).collect() == []
    row = fingerprints.compare_edited(documents(spark, ["a b c d"])).first()
    assert row["near_next"] == 1.0 and row["edited_sha256"] == hashlib.sha256(b"a b a b").hexdigest()


def test_plan_is_native_with_one_shuffle_of_texts(spark):
    plan = fingerprints.compare_edited(documents(spark, ["a b"] * 5))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert not any(x in plan for x in ("PythonUDF", "ArrowEval", "InPandas", "InArrow"))


@pytest.mark.parametrize("b", [0, 5])
def test_equal_texts_have_equal_fingerprints(spark, b):
    text = " ".join(vocabulary(b, 50))
    rows = documents(spark, [text, text]).select(fingerprints.fingerprint(F.col("text")).alias("f")).collect()
    assert rows[0] == rows[1]
