import glob
import math
import os
import random
from collections import Counter, defaultdict

import pytest
from helpers import documents, lower_ascii, words
from pyspark.sql import functions as F

from tidewire.llm import ngrams, queries
from tidewire.llm.tallies import pack, pack_sorted, unpack, unpack_sorted

START, END = "<start>", "<end>"


class Katz:
    """The model in dictionaries."""

    def __init__(self, texts, order):
        self.order = order
        self.counts = [Counter() for _ in range(order + 1)]
        for tokens in texts:
            padded = [START] * (order - 1) + tokens
            for i in range(order - 1, len(padded)):
                for n in range(1, order + 1):
                    self.counts[n][tuple(padded[i - n + 1 : i + 1])] += 1
        self.discounts = [None] + [
            ngrams.good_turing([sum(c == r for c in self.counts[n].values()) for r in range(1, 7)]) for n in range(1, order + 1)
        ]
        self.after = defaultdict(dict)
        for n in range(2, order + 1):
            for gram, c in self.counts[n].items():
                self.after[gram[:-1]][gram[-1]] = c

    def reduced(self, n, c):
        return c * (self.discounts[n][c - 1] if c <= 5 else 1.0)

    def word(self, w):
        total = sum(self.counts[1].values())
        kept = sum(self.reduced(1, c) for c in self.counts[1].values())
        total, left = (total, total - kept) if total - kept > 1e-12 else (total + 1, 1)
        c = self.counts[1].get((w,), 0)
        return self.reduced(1, c) / total if c else left / total

    def p(self, history, w):
        if not history:
            return self.word(w)
        lower = history[1:]
        seen = self.after.get(history)
        if not seen:
            return self.p(lower, w)
        n, total = len(history) + 1, sum(seen.values())
        freed = sum(c - self.reduced(n, c) for c in seen.values())
        if freed <= 1e-12:
            total, freed = total + 1, 1
        if w in seen:
            return self.reduced(n, seen[w]) / total
        return freed / total / (1 - sum(self.p(lower, x) for x in seen)) * self.p(lower, w)

    def score(self, tokens):
        n = self.order - 1
        padded = [START] * n + tokens
        return sum(math.log10(self.p(tuple(padded[i : i + n]), w)) for i, w in enumerate(tokens))


def tokens_of(text):
    return words(lower_ascii(text or "")) + [END]


def corpus(n, seed=3):
    draw = random.Random(seed)
    return [" ".join(f"w{min(int(draw.paretovariate(0.7)), 60)}" for _ in range(draw.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(spark, order):
    texts = [*corpus(120), "New WORDS w1 w2", "", None, "w1", "w1 w2 w3 w1 w2 w3"]
    held = [i % 5 == 0 for i in range(len(texts))]
    docs = documents(spark, texts, extra=("train", "score", "block", "size"))
    rows = ngrams.katz_scores(docs, F.col("doc_id") % 5 != 0, order=order).collect()
    assert len(rows) == len(texts)
    train = [tokens_of(t) for t, h in zip(texts, held, strict=True) if not h]
    model, known = Katz(train, order), Counter(w for t in train for w in t)
    n, v = sum(known.values()), len(known)
    for r in rows:
        tokens = tokens_of(texts[r["doc_id"]])
        assert (r["train"], r["n_tokens"], r["train_tokens"], r["train_words"]) == (not held[r["doc_id"]], len(tokens), n, v)
        assert r["n_known"] == sum(w in known for w in tokens)
        assert r["base_score"] == pytest.approx(sum(math.log10((known[w] + 1) / (n + v + 1)) for w in tokens), abs=1e-9)
        assert r["score"] == pytest.approx(model.score(tokens), rel=1e-9)


def test_distributions_add_up_to_one():
    model = Katz([tokens_of(t) for t in corpus(80)], 3)
    vocabulary = [w for (w,) in model.counts[1]] + ["<unknown>"]
    for history in [(), *list(model.after)[:60]]:
        assert sum(model.p(history, w) for w in vocabulary) == pytest.approx(1, abs=1e-9)


def test_frequent_histories_are_dealt_by_whole_ngram(spark, monkeypatch):
    # Every text starts with the start mark, whose n-grams are always dealt that way; so are all with a limit of 0.
    texts = corpus(60, seed=5)
    rows = ngrams.katz_scores(documents(spark, texts), F.lit(True)).collect()
    model = Katz([tokens_of(t) for t in texts], 2)
    assert [r["score"] for r in sorted(rows)] == pytest.approx([model.score(tokens_of(t)) for t in texts])


def test_hot_keys_can_be_turned_back():
    import numpy as np

    bits, word_bits = 40, 17
    whole = np.array([0, 1, (1 << 40) - 1, 123456789], np.uint64)
    spread = ngrams.scrambled(whole, bits)
    back = (spread * np.uint64(pow(ngrams.ODD, -1, 1 << 64))) & np.uint64((1 << bits) - 1)
    assert back.tolist() == whole.tolist() and word_bits < bits


def test_without_training_texts(spark):
    rows = ngrams.katz_scores(documents(spark, ["a b", None]), F.lit(False)).collect()
    assert [(r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in rows] == [(0, 0, 0.0, 0.0)] * 2


def test_empty_table_nulls_repeated_rows_and_long_texts(spark):
    assert ngrams.katz_scores(documents(spark, []), F.lit(True)).collect() == []
    docs = documents(spark, ["a b", "a b", "x " * 100_000, None], ids=[None, 7, 7, 8])
    rows = ngrams.katz_scores(docs, F.lit(True)).collect()
    assert sorted((r["n_tokens"] for r in rows)) == [1, 3, 3, 100_001]
    assert all(r["score"] < 0 for r in rows)


def test_packed_arrays_come_back():
    import numpy as np

    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2))
    assert (unpack_sorted(pack_sorted(keys)) == keys).all()
    assert unpack(pack(np.arange(5, dtype="<i4")), "<i4").tolist() == [0, 1, 2, 3, 4]
    assert unpack_sorted(pack_sorted(np.empty(0, np.uint64))).tolist() == []


def test_registered_query_scores_with_trigrams(spark, tmp_path):
    texts = corpus(60, seed=9)
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = sorted(queries.op2_katz_scores(spark, str(tmp_path)).collect())
    model = Katz([tokens_of(texts[r["doc_id"]]) for r in rows if not r["held_out"]], 3)
    assert [r["score"] for r in rows] == pytest.approx([model.score(tokens_of(texts[r["doc_id"]])) for r in rows])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_no_shard_ends_within_a_history(spark, seed):
    """Shards that are no power of two once cut the n-grams of a history, whose sums then came from one part only."""
    texts = corpus(150, seed=seed)
    train = [tokens_of(t) for i, t in enumerate(texts) if i % 3]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        rows = sorted(ngrams.katz_scores(documents(spark, texts), F.col("doc_id") % 3 != 0, order=3).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    model = Katz(train, 3)
    assert [r["score"] for r in rows] == pytest.approx([model.score(tokens_of(t)) for t in texts], rel=1e-9)


def test_lower_orders_leave_no_tables_and_training_texts_ask_for_no_sums(spark):
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file://").removeprefix("file:")
    there = set(glob.glob(f"{shared}/ngrams-*"))
    texts = corpus(80)
    rows = sorted(ngrams.katz_scores(documents(spark, texts), F.lit(True), order=3).collect())
    model = Katz([tokens_of(t) for t in texts], 3)
    assert [r["score"] for r in rows] == pytest.approx([model.score(tokens_of(t)) for t in texts], rel=1e-9)
    left = set(glob.glob(f"{shared}/ngrams-*")) - there
    assert ["-".join(os.path.basename(p).split("-")[:2]) for p in left] == ["ngrams-3"]
    told = spark.read.parquet(*left).filter("kind = 'answer'")
    assert told.count() > 0 and told.filter("sums IS NOT NULL OR extra IS NOT NULL OR keys IS NOT NULL").count() == 0
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
