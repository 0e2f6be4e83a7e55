"""Small tables and brute-force forms for the tests of this folder."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lower_ascii(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def documents(spark, texts, **columns):
    """A documents table: ids count from 0 unless given; extra columns clash with the names operators use inside."""
    n = len(texts)
    ids = columns.get("ids", list(range(n)))
    langs = columns.get("langs", ["en"] * n)
    sources = columns.get("sources", ["s0"] * n)
    rows = [(i, t, g, s, None if t is None else len(t)) for i, t, g, s in zip(ids, texts, langs, sources, strict=True)]
    frame = spark.createDataFrame(rows, DOC_SCHEMA)
    for name in columns.get("extra", ()):
        frame = frame.selectExpr("*", f"'x' AS `{name}`")
    return frame


def vocabulary(seed: int, n: int) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(draw.randint(2, 8))) for _ in range(n)]


def shingles(text: str | None, size: int) -> frozenset:
    w = words(lower_ascii(text or ""))
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def components(sets: list[frozenset], percent: int) -> list[int]:
    """The first index of each one's component under Jaccard similarity; empty sets stay alone."""
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]
