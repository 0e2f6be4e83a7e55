import random

import numpy as np
import pytest
from helpers import components, documents, shingles, vocabulary

from tidewire.llm import graph, setsketch


def family(draw, vocab, text, edits):
    w = text.split()
    for _ in range(edits):
        w[draw.randrange(len(w))] = draw.choice(vocab)
    return " ".join(w)


def texts(seed=21):
    draw, vocab = random.Random(seed), vocabulary(seed, 2000)
    out = [None, "", " \n", "one", "ONE", "one two", "One  Two", "one two three"]
    for _ in range(40):
        text = " ".join(draw.choice(vocab) for _ in range(draw.randint(5, 300)))
        out.append(text)
        for _ in range(draw.randint(0, 6)):
            out.append(family(draw, vocab, draw.choice([text, out[-1]]), draw.randint(0, 1 + len(text.split()) // 12)))
    draw.shuffle(out)
    return [*out, "w " * 50_000, " ".join(vocab)]


def expected(found, size):
    sets = [shingles(t, size) for t in found]
    return [(len(s), c, i == c) for i, (s, c) in enumerate(zip(sets, components(sets, 80), strict=True))]


@pytest.mark.parametrize("size", [2, 5])
def test_components_equal_brute_force(spark, size):
    found = texts()
    docs = documents(spark, found, extra=("n", "digest", "registers", "vid", "root", "bucket", "component_id"))
    rows = sorted(setsketch.near_duplicates(docs, size=size).collect())
    assert [tuple(r)[1:] for r in rows] == expected(found, size)


def test_group_of_many_near_copies(spark):
    draw, vocab = random.Random(5), vocabulary(5, 500)
    base = " ".join(draw.choice(vocab) for _ in range(120))
    found = [family(draw, vocab, base, 3) for _ in range(300)] + [base] * 50
    draw.shuffle(found)
    rows = sorted(setsketch.near_duplicates(documents(spark, found), size=2).collect())
    assert [tuple(r)[1:] for r in rows] == expected(found, 2)


def test_null_and_repeated_ids(spark):
    found = ["a b c d e f", "a b c d e f", "a b c d e f", "x y z", None]
    rows = setsketch.near_duplicates(documents(spark, found, ids=[None, 4, 4, 9, 4])).collect()
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows), key=repr)
    assert got == sorted([(None, 2, None, True), (4, 2, 4, True), (4, 2, 4, True), (9, 1, 9, True), (4, 0, 4, True)], key=repr)


def test_empty_table(spark):
    assert setsketch.near_duplicates(documents(spark, [])).collect() == []


def random_sets(draw, shared, only):
    both = draw.integers(0, 1 << 63, shared, dtype=np.uint64)
    return [np.unique(np.concatenate([both, draw.integers(0, 1 << 63, only, dtype=np.uint64)])) for _ in range(2)]


def test_sketches_merge_and_estimate():
    draw = np.random.default_rng(3)
    for shared, only in ((400, 50), (80, 10), (10, 10), (3000, 700)):
        pairs = [random_sets(draw, shared, only) for _ in range(60)]
        a, b = (setsketch.sketches([p[i] for p in pairs]) for i in (0, 1))
        union = setsketch.sketches([np.unique(np.concatenate(p)) for p in pairs])
        assert (setsketch.merge(a, b) == union).all()
        n = np.full(60, shared + only)
        error = setsketch.joint_estimate(a, b, n, n) - shared / (shared + 2 * only)
        assert abs(error.mean()) < 0.02 and np.abs(error).max() < 0.2


def test_shingle_sets_are_those_of_the_words():
    found = texts()[:60]
    for size in (1, 2, 5):
        for t, s in zip(found, setsketch.shingle_sets(found, size), strict=True):
            assert len(s) == len(shingles(t, size))


def test_chains_become_one_component(spark):
    n = 400
    links = spark.createDataFrame([(i, i + 1) for i in range(n) if i != 200], "a long, b long")
    roots = dict(graph.components(links).collect())
    assert roots == {i: 0 if i <= 200 else 201 for i in range(n + 1)}


def test_components_of_nothing(spark):
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_group_of_copies_with_much_noise(spark):
    """Copies of one text with 0 to 30 changes: some are linked, many are alike to none."""
    draw, vocab = random.Random(15), vocabulary(15, 3000)
    base = " ".join(draw.choice(vocab) for _ in range(140))
    found = [family(draw, vocab, base, draw.randint(0, 30)) for _ in range(250)]
    rows = sorted(setsketch.near_duplicates(documents(spark, found), size=2).collect())
    want = expected(found, 2)
    assert [tuple(r)[1:] for r in rows] == want and 20 < sum(k for _, _, k in want) < 230


def test_shared_shingles(spark):
    found = ["a b c", "b c d", "x y", "x y", "z"]
    texts = spark.createDataFrame(list(enumerate(found)), "vid long, text string")
    assert dict(setsketch.shared_shingles(texts, 2).collect()) == {0: 1, 1: 1, 2: 1, 3: 1, 4: 0}


def test_noisy_copies_are_tested_a_few_times_each(spark, monkeypatch):
    """No step tests all pairs of a bucket: a class meets one other per band, and later one centre per band."""
    tested, verified = [], setsketch.verified
    monkeypatch.setattr(setsketch, "verified", lambda pairs, *more: tested.append(pairs.count()) or verified(pairs, *more))
    draw, vocab = random.Random(15), vocabulary(15, 3000)
    base = " ".join(draw.choice(vocab) for _ in range(140))
    found = [family(draw, vocab, base, draw.randint(0, 30)) for _ in range(250)]
    rows = sorted(setsketch.near_duplicates(documents(spark, found), size=2).collect())
    assert [tuple(r)[1:] for r in rows] == expected(found, 2)
    assert len(tested) == 2 and sum(tested) <= 2 * setsketch.BANDS * len(found)
