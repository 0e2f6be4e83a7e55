"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from helpers import documents, lower_ascii
from pyspark.sql import functions as F

from tidewire.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def changed(key, run):
    h = zlib.crc32(f"{key}:{run}".encode())
    return run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run


def counts(texts, ids):
    seen = Counter()
    for i, text in zip(ids, texts, strict=True):
        seen.update(changed("" if i is None else i, r) for r in RUN.findall(lower_ascii(text or "")))
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(words, ratio=10):
    forms, rows = {}, {}
    for w, n in words.items():
        others = [v for v in words if near(w, v)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= ratio * n:
            forms[w] = best
        rows[w] = len(others)
    out = set()
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        form = forms.get(w)
        out.add((w, form, root, n, rows[w], words[form] if form else None))
    return out


def said(frame):
    rows = frame.collect()
    out = {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def query(docs):
    return spelling.spelling_groups(spelling.word_counts(docs, one_in=31))


def texts():
    draw = random.Random(3)
    base = ["letterform", "aabbccdd", "naïveté", "Ärgernis", "÷×÷×÷×÷", "mississippi", "bookkeeper"]
    out = []
    for _ in range(120):
        line = []
        for w in base:
            for _ in range(draw.randint(0, 4)):
                at, kind = draw.randrange(len(w)), draw.random()
                x = draw.choice("abcdeéßp")
                line.append(w[:at] + w[at + 1 :] if kind < 0.1 else w[:at] + x + w[at:] if kind < 0.2 else w[:at] + x + w[at + 1 :] if kind < 0.3 else w)
        draw.shuffle(line)
        out.append(draw.choice([" ", ", ", "1", "\n"]).join(line))
    return [*out, None, "", "  ", "short words only", "x" * 5000, "x" * 5000, "x" * 4999 + " " + "x" * 4999]


def test_against_all_pairs(spark):
    found = texts()
    docs = documents(spark, found, extra=("word", "n", "key", "run", "prefix")).repartition(4)
    words = counts(found, range(len(found)))
    assert len(words) > 60 and said(query(docs)) == brute(words)


def test_chains_of_forms(spark):
    words = {"abcdefg": 5000, "abcdefh": 400, "abcdeih": 30, "abcdjih": 2, "abcdefgg": 5000, "zzzzzzz": 3, "zzzzzzzz": 29}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert said(spelling.spelling_groups(table)) == brute(words)
    assert {r["word"]: r["root"] for r in spelling.spelling_groups(table).collect()}["abcdjih"] == "abcdefg"
    with pytest.raises(ValueError):
        spelling.spelling_groups(table, ratio=1)


def test_runs_of_equal_letters_meet_once(spark):
    words = {"aaaaaaa": 2, "aaaaaaaa": 50, "aaaaaaab": 3, "baaaaaaa": 3, "aaabaaaa": 2}
    table = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert said(spelling.spelling_groups(table)) == brute(words)


def test_null_ids_repeated_rows_and_empty_table(spark):
    ids = [None, 4, 4, None]
    found = ["wordforms wordforms wordformz", "wordforms " * 9, "wordforms " * 9, "wordformz"]
    assert said(query(documents(spark, found, ids=ids))) == brute(counts(found, ids))
    none = query(documents(spark, found).filter(F.lit(False)))
    assert none.count() == 0 and none.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_list_is_sorted_once(spark):
    """The window uses the order of the dealt list: no second exchange or sort of the rotations."""
    words = spark.createDataFrame([("letters", 2)], "word string, n long")
    plan = spelling.neighbours(words)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning(prefix") == 1 and "hashpartitioning(prefix" not in plan
