import os
import random

import pytest
from helpers import documents, words
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.compare import compare, connect
from tidewire.llm import mixing
from tidewire.llm.words import word_count

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def mixed(docs):
    return mixing.mix(docs, word_count(F.col("text"))).collect()


def expected_targets(sizes: dict, weights=(3, 1, 2)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    budget, capped = 1.5 * sum(sizes.values()), set()
    while True:
        left = budget - sum(2 * sizes[s] for s in capped)
        rest = sum(weight[s] for s in order if s not in capped)
        target = {s: 2.0 * sizes[s] if s in capped else left * weight[s] / rest for s in order}
        above = {s for s in order if target[s] > 2 * sizes[s]}
        if not above:
            return target
        capped |= above


def test_targets_and_taken_words(spark):
    draw = random.Random(1)
    names = ["b", "a", None, "Z", "é", "big"]
    sources = [draw.choice(names + ["big"] * 8) for _ in range(900)]
    texts = [" ".join("w" * draw.randint(1, 5) for _ in range(draw.randint(0, 40))) for _ in sources]
    docs = documents(spark, texts, sources=sources, extra=("size", "target", "position", "copy", "source_key"))
    rows = mixed(docs)
    assert len(rows) == len(texts)
    sizes = {}
    for t, s in zip(texts, sources, strict=True):
        sizes[s] = sizes.get(s, 0) + len(words(t))
    target = expected_targets(sizes)
    taken = {}
    for r in rows:
        assert r["size"] == len(words(texts[r["doc_id"]])) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] = taken.get(r["source"], 0) + r["copies"] * r["size"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= 20  # half of the longest text
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mixed(docs)), key=repr)


def test_one_source_takes_all_once_and_half_twice(spark):
    rows = mixed(documents(spark, ["a b"] * 200, sources=["x"] * 200))
    assert sum(r["copies"] for r in rows) == 300 and {r["copies"] for r in rows} == {1, 2}


def test_nulls_repeated_rows_and_long_texts(spark):
    docs = documents(
        spark, [None, "", "a b", "a b", "c " * 200_000, "d"], ids=[None, 1, 2, 2, 3, None], sources=[None, "x", "x", "x", "y", None]
    )
    rows = mixed(docs)
    assert len(rows) == 6
    assert len({r["copies"] for r in rows if r["doc_id"] == 2}) == 1
    assert [r["size"] for r in rows if r["doc_id"] == 3] == [200_000]


def test_empty_table_and_empty_texts(spark):
    assert mixed(documents(spark, [])) == []
    assert [(r["size"], r["target"], r["copies"]) for r in mixed(documents(spark, ["", None]))] == [(0, 0.0, 0)] * 2


def test_weights_and_many_sources(spark):
    n = 400
    docs = documents(spark, ["a b c"] * n, sources=[f"s{i:04}" for i in range(n)])
    rows = {r["source"]: r["target"] for r in mixed(docs)}
    assert rows == pytest.approx(expected_targets({f"s{i:04}": 3 for i in range(n)}))


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")
def test_query_equals_sql(spark):
    problems = compare(spark, connect(SF), SF, entry.queries()["op1_mix_sources"], entry.oracle_sql()["op1_mix_sources"])
    assert [p for p in problems if not p.startswith("note")] == []
