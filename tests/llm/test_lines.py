import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents, lower_ascii, vocabulary, words

from tidewire.llm import lines
from tidewire.llm.tallies import pack


def numbered(ids, found):
    """(order, row, line number, set) of all lines that have words."""
    out = []
    for row, (i, text) in enumerate(zip(ids, found, strict=True)):
        for k, line in enumerate((text or "").split("\n")):
            if s := frozenset(words(lower_ascii(line))):
                out.append(((i is None, i or 0, k), row, k, s))
    return out


def expected(ids, found, percent=80):
    every = numbered(ids, found)
    gone = {}
    for order, row, k, s in every:
        if any(o < order and 100 * len(s & x) >= percent * len(s | x) for o, _, _, x in every):
            gone.setdefault(row, []).append(k)
    return gone


def texts(seed=31, n=60):
    draw, vocab = random.Random(seed), vocabulary(seed, 400)
    pool = [" ".join(draw.choice(vocab) for _ in range(draw.randint(1, 30))) for _ in range(120)]
    out = [None, "", "\n\n", "a\nA\n a \nb", "one two three four\none two three four five"]
    for _ in range(n):
        made = []
        for _ in range(draw.randint(1, 8)):
            w = draw.choice(pool).split()
            for _ in range(draw.choice([0, 0, 1, 1, 2])):
                w[draw.randrange(len(w))] = draw.choice(vocab)
            made.append(" ".join(w))
        out.append("\n".join(made))
    return out


def result(docs):
    return sorted(lines.dedup_lines(docs).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))


def test_removed_lines_equal_brute_force(spark):
    found = [*texts(), "z " * 100_000]
    ids = list(range(len(found)))
    rows = result(documents(spark, found, extra=("doc", "rid", "line", "words", "set", "removed")))
    gone = expected(ids, found)
    assert len(rows) == len(found) and len(gone) > 20
    for r in rows:
        mine = gone.get(r["doc_id"], [])
        assert (r["removed_lines"] or []) == mine
        before = found[r["doc_id"]]
        assert r["text"] == (before if not mine else "\n".join(x for k, x in enumerate(before.split("\n")) if k not in mine))


def test_group_of_many_near_lines(spark):
    draw, vocab = random.Random(8), vocabulary(8, 300)
    base = [draw.choice(vocab) for _ in range(40)]
    found = []
    for _ in range(200):
        w = list(base)
        for _ in range(draw.randint(0, 6)):
            w[draw.randrange(40)] = draw.choice(vocab)
        found.append(" ".join(w))
    rows = result(documents(spark, found))
    assert {r["doc_id"] for r in rows if r["removed_lines"]} == set(expected(range(200), found))


def test_null_and_repeated_ids(spark):
    found = ["x y z", "x y z\nq", "x y z", "p", "p"]
    rows = lines.dedup_lines(documents(spark, found, ids=[None, 5, 6, 7, 7])).collect()
    assert {(r["doc_id"], r["text"]) for r in rows} == {(None, ""), (5, "x y z\nq"), (6, ""), (7, "p")} and len(rows) == 5
    mixed_up = lines.dedup_lines(documents(spark, ["a b", "c d\na b", "c d"], ids=[7, 7, 8])).collect()
    assert sorted((r["doc_id"], r["text"]) for r in mixed_up) == [(7, "a b"), (7, "c d"), (8, "")]


def test_empty_table(spark):
    assert lines.dedup_lines(documents(spark, [])).collect() == []


@pytest.mark.parametrize("hot", [0, 3, 5000])
def test_prefixes_lose_no_pair(monkeypatch, hot):
    monkeypatch.setattr(lines, "HOT", hot)
    found = texts(seed=hot, n=120)
    block = lines.Block()
    for i, t in enumerate(found):
        block.add(i, 0, t)
    row = {"block": 7, **block.packed()}
    row["totals"] = [row["counts"]]
    row["firsts"] = [pack(np.ones(len(lines.own_sets(row)[1]), bool))]
    p = lines.unpacked_postings([{"block": 7, **lines.packed_postings(lines.prefixes(row, 80))}])
    pairs = {(int(p["at_line"][a]), int(p["at_line"][b])) for y, x, _ in lines.similar(p, 80) for a, b in zip(y, x, strict=True)}
    every = [s for _, _, _, s in numbered(range(len(found)), found)]
    first = {s: i for i, s in reversed(list(enumerate(every)))}
    assert lines.first_lines(row).tolist() == [first[s] == i for i, s in enumerate(every)]
    linked = 0
    for i, s in enumerate(every):
        for j, t in enumerate(every[:i]):
            if s != t and first[s] == i and first[t] == j and 100 * len(s & t) >= 80 * len(s | t):
                linked += 1
                assert (i, j) in pairs
    assert linked > 50


def test_null_ids_are_documents_of_their_own(spark):
    words_of = lambda a, z: " ".join(f"w{i}" for i in range(a, z))
    same, near = words_of(0, 20) + "\n\nq r s", words_of(0, 19) + " other"
    found = [same, same, same, near, "only here", "", None, None, words_of(50, 60)]
    rows = lines.dedup_lines(documents(spark, found, ids=[None] * 8 + [3])).collect()
    left = sorted(r["text"] or "" for r in rows)
    first = {(same, ""), ("\nq r s", near)}  # either text may come first
    assert any(left == sorted([a, b, "", "", "only here", "", "", "", words_of(50, 60)]) for a, b in first)


def test_template_lines_are_ruled_out_together(monkeypatch):
    """Ten frequent words and two of its own per line: all lines are filed under one pair, and none is like another."""
    p = np.zeros(3000, lines.POSTING)
    p["n"], p["at"], p["doc"], p["at_line"] = 12, 2, np.arange(3000), np.arange(3000)
    overlap, tested = lines.overlap, []
    monkeypatch.setattr(lines, "overlap", lambda x, y, percent: tested.append(len(x)) or overlap(x, y, percent))
    assert list(lines.similar(p, 80)) == [] and sum(tested) < 3000
    p["at"][:3] = 1  # these may be alike
    p = p[np.lexsort((p["at_line"], p["at"]))]
    assert {(int(a), int(b)) for y, x, _ in lines.similar(p, 80) for a, b in zip(y, x, strict=True)} == {(1, 0), (2, 0), (2, 1)}


def test_long_unlike_lines_are_ruled_out_by_their_maps():
    """Pairs of lines of 100 words of which 80 are shared (a Jaccard similarity of 0.67): few are left to be verified."""
    draw, block, n = random.Random(3), lines.Block(), 400
    common = vocabulary(3, 400)  # so the shared words are the rarer ones
    for i in range(n):
        shared = [f"w{draw.getrandbits(40)}" for _ in range(80)]
        for k in range(2):
            block.add(2 * i + k, 0, " ".join(shared + draw.sample(common, 20)))
    row = {"block": 7, **block.packed()}
    row |= {"totals": [row["counts"]], "firsts": [pack(np.ones(2 * n, bool))]}
    p = lines.unpacked_postings([{"block": 7, **lines.packed_postings(lines.prefixes(row, 80))}])
    left = sum(len(y) for y, _, _ in lines.similar(p, 80))
    p["high"] = 0  # as with a map of half the width
    assert 3 * left < sum(len(y) for y, _, _ in lines.similar(p, 80))


def test_texts_are_dealt_without_a_sort(spark):
    docs = documents(spark, ["x y z", "x y z"])
    plan = lines.dedup_lines(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=shuffle_hash" in plan


def test_words_are_hashed_together(monkeypatch):
    """Words once were looked up and hashed one by one, the larger part of the operator's time."""
    called = []
    digest = lines.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(lines.xxhash, "xxh3_64_intdigest", lambda w: called.append(w) or digest(w))
    found = [*texts(seed=5), None, " \t\n\x0b\x0c\r", "A\u00a0b\x1cC\x85d É é \0 a\0", "y" * 256 + " " + "Y" * 257]
    block = lines.Block()
    for i, t in enumerate(found):
        block.add(i, -i, t)
    row = block.packed()
    assert set(called) == {b"y" * 257}
    every = [(i, k, frozenset(words(lower_ascii(x)))) for i, t in enumerate(found) if t for k, x in enumerate(t.split("\n"))]
    every = [x for x in every if x[2]]
    own, sizes = lines.unpack_sorted(row["keys"]), lines.unpack(row["sizes"], "<i4")
    ends, tokens = np.cumsum(sizes), lines.unpack(row["tokens"], "<i4")
    got = [frozenset(own[tokens[z - n : z]].tolist()) for z, n in zip(ends, sizes, strict=True)]
    hashed = lambda s: frozenset(lines.word_hashes(pa.array(sorted(s), pa.string())).tolist())
    assert got == [hashed(s) for _, _, s in every] and len(own) == len(set().union(*(s for _, _, s in every)))
    assert lines.unpack(row["doc"], "<i8").tolist() == [i for i, _, _ in every]
    assert lines.unpack(row["rid"], "<i8").tolist() == [-i for i, _, _ in every]
    assert lines.unpack(row["line"], "<i4").tolist() == [k for _, k, _ in every]


def test_pieces_are_bounded_and_slices_hash_alike(monkeypatch):
    monkeypatch.setattr(lines, "PIECE_BYTES", 10)
    found = ["abcd", None, "efgh", "ijkl", "m" * 50, "", "n", "o p"]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(8), pa.int64()), pa.array(range(8), pa.int64()), pa.array(found)], names=["doc", "rid", "text"]
    )
    made = [p.column(2).to_pylist() for p in lines.pieces(batch)]
    assert made == [["abcd", None, "efgh"], ["ijkl"], ["m" * 50], ["", "n", "o p"]]
    at_once, by_piece = lines.Block(), lines.Block()
    at_once.add_rows(*batch.columns)
    for p in lines.pieces(batch):
        by_piece.add_rows(*p.columns)
    assert at_once.packed() == by_piece.packed()


@pytest.mark.parametrize("spread", [1, 1 << 20, 1 << 63])
def test_sort_order_is_that_of_a_stable_sort(spread):
    draw = np.random.default_rng(5)
    # Many equal keys, and keys that differ in the low bits only, where their places are sorted.
    near = draw.integers(0, 300, 3000).astype(np.uint64) + np.uint64(spread)
    keys = np.concatenate([near, draw.integers(0, 2**64, 3000, np.uint64), near, near[:1] * 0])
    assert (lines.sort_order(keys) == np.argsort(keys, kind="stable")).all()
    assert (lines.sort_order(near) == np.argsort(near, kind="stable")).all()
    own, rank = lines.ranked(keys)
    expected_own, expected_rank = np.unique(keys, return_inverse=True)
    assert (own == expected_own).all() and (rank == expected_rank).all()
    assert len(lines.sort_order(keys[:0])) == 0 and (lines.sort_order(keys[:1] * 0) == [0]).all()


def test_words_and_postings_are_sorted_as_numbers(monkeypatch):
    block = lines.Block()
    for doc, text in enumerate(texts()):
        block.add(doc, doc, text)
    monkeypatch.setattr(np, "unique", None)  # sorts places, which takes several times as long
    row = {"block": 0, **block.packed()}
    monkeypatch.undo()
    counts = lines.unpack(row["counts"], "<i8")
    order, starts = lines.own_sets(row)
    p = lines.prefixes(row | {"totals": [pack(counts + 1)], "firsts": [pack(np.ones(len(starts), bool))]}, 80)
    halves = [{"block": b, **lines.packed_postings(x)} for b, x in ((1, p[::2]), (0, p[1::2]))]
    monkeypatch.setattr(np, "lexsort", None)
    found = lines.unpacked_postings(halves)
    monkeypatch.undo()
    assert len(found) == len(p) > 100
    assert (np.lexsort((found["block"], found["at"], found["n"], found["key"])) == np.arange(len(p))).all()
