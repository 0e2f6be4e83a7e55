"""Similarity classes by T-occurrence search, against all pairs of documents."""

import random

import numpy as np
from helpers import components, documents, shingles, vocabulary
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewire.llm import overlap, tallies


def corpus(seed=7, families=6):
    draw, vocab = random.Random(seed), vocabulary(seed, 2000)
    said = lambda n: [draw.choice(vocab) for _ in range(n)]
    passage, out = said(40), []
    for f in range(families):
        base = said(draw.randint(30, 90))
        for _ in range(14):
            text = list(base)
            for _ in range(draw.randint(0, 4)):
                text[draw.randrange(len(text))] = draw.choice(vocab[:3])  # copies share edits
            if draw.random() < 0.3:
                text = text[: draw.randint(len(text) // 2, len(text))]
            out.append(" ".join(text))
        out += [" ".join(passage + said(draw.randint(2, 30))), " ".join(base).upper(), " ".join(base)]
    out += [" ".join(said(draw.randint(1, 60))) for _ in range(20)]
    return [*out, None, "", " \n", "one", "ONE", "a b c d", "a b c d e", "a b c d e f g h", "a b c d e f g h i", "x " * 3000]


def found(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in frame.collect()}


def expected(texts, percent=80):
    sets = [shingles(t, 5) for t in texts]
    return {i: (len(s), root) for i, (s, root) in enumerate(zip(sets, components(sets, percent), strict=True))}


def test_against_all_pairs(spark):
    texts = corpus()
    docs = documents(spark, texts, extra=("block", "vid", "n", "digest", "shingles", "least", "root")).repartition(5)
    said = found(overlap.similarity_classes(docs))
    assert said == expected(texts)
    assert len({c for _, c in said.values()}) < len(texts) - 25


def test_components_across_blocks(spark, monkeypatch):
    """Blocks of a few documents: links within them, between those that stand for components, and of the others."""
    for name in ("BLOCK_TOKENS", "BLOCK_DOCS", "COUNTED"):
        monkeypatch.setattr(overlap, name, 3 if name == "BLOCK_DOCS" else 150)
    texts = corpus(11)
    for many in (32, 1):  # with 1, most shingles are in too many blocks to be listed
        monkeypatch.setattr(overlap, "MANY", many)
        assert found(overlap.similarity_classes(documents(spark, texts))) == expected(texts)


def test_other_thresholds_and_sizes(spark):
    texts = corpus(5, 3)
    docs = documents(spark, texts)
    said = found(overlap.similarity_classes(docs, size=2, threshold=0.6))
    sets = [shingles(t, 2) for t in texts]
    assert said == {i: (len(s), root) for i, (s, root) in enumerate(zip(sets, components(sets, 60), strict=True))}


def test_null_ids_repeated_rows_and_empty_tables(spark):
    text = "the same ten words are in both of these texts here"
    rows = [(5, text), (5, text), (3, text + " again"), (None, text + " again and"), (None, "alone " * 30), (8, None), (8, "")]
    docs = documents(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    said = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in overlap.similarity_classes(docs).collect())
    assert said == sorted([
        ("5", 7, "3"), ("5", 7, "3"), ("3", 8, "3"), ("None", 9, "3"), ("None", 1, "None"), ("8", 0, "8"), ("8", 0, "8"),
    ])
    for none in (docs.filter(F.lit(False)), docs.filter("doc_id = 8")):
        assert {r["component_id"] for r in overlap.similarity_classes(none).collect()} <= {8}


@settings(deadline=None, max_examples=150)
@given(st.lists(st.sets(st.integers(0, 25), min_size=1), min_size=2, max_size=12), st.sampled_from([50, 80, 90]))
def test_divide_skip(sets, percent):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    lists, group = overlap.Lists(arrays), np.arange(len(sets))
    for q, s in enumerate(sets):
        alike = [i for i, t in enumerate(sets) if i != q and 100 * len(s & t) >= percent * len(s | t)]
        assert overlap.divide_skip(lists, arrays[q], percent, group, q).tolist() == alike


def test_packed_empty_arrays():
    assert len(tallies.unpack(tallies.pack(np.empty(0, "<i8")), "<i8")) == 0
