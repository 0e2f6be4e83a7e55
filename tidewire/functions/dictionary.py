"""Searching a text for all names of a large dictionary at once, as native column expressions.

The names become one pattern, a tree of their letters, that is tried at each place of the text: a few comparisons decide
that no name begins there, however many names there are. Each place gives the longest name that begins at it; shorter
names that begin a longer one are looked up afterwards. Lookups go by the first two letters and then by name, so that
they too stay short.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

LARGE = 100
BRANCHES = 6


def _letter(c: str) -> str:
    return re.escape(c) if c.isascii() else c


def _guarded(children: list[tuple[str, str]]) -> str:
    """Alternatives with different first letters, halved by letter classes while there are many."""
    if len(children) <= BRANCHES:
        return "|".join(pattern for _, pattern in children)
    half = len(children) // 2
    first, second = children[:half], children[half:]
    letters = "".join(_letter(c) for c, _ in first)
    return f"(?=[{letters}])(?:{_guarded(first)})|{_guarded(second)}"


def tree_pattern(names: Iterable[str]) -> str:
    """A pattern that matches the longest of the names that begins at a place."""
    tree: dict = {}
    for name in names:
        node = tree
        for c in name:
            node = node.setdefault(c, {})
        node[""] = {}

    def written(node: dict) -> str:
        ends, run = "" in node, ""
        while not ends and len(node) == 1:
            (c, node), = node.items()
            run, ends = run + _letter(c), "" in node
        children = [(c, _letter(c) + written(child)) for c, child in sorted(node.items()) if c]
        if not children:
            return run
        body = f"(?:{_guarded(children)})" + ("?" if ends else "")
        return run + body

    return written(tree)


class NameTable:
    """A literal map from names to numbers that is looked up in two steps."""

    def __init__(self, values: Mapping[str, object], kind: str):
        parts: dict[str, dict] = {}
        for name, value in values.items():
            parts.setdefault(name[:2], {})[name] = value
        # A constant that the optimizer evaluates once.
        self.parts = F.from_json(F.lit(json.dumps(parts)), f"map<string,map<string,{kind}>>")

    def __call__(self, name: Column) -> Column:
        return F.try_element_at(F.try_element_at(self.parts, F.substring(name, 1, 2)), name)


def names_found(text: Column, names: Iterable[str]) -> Column:
    """The different names that occur in the text, anywhere and in any order; null text has none."""
    names = {n for n in names if n}
    if not names:
        return F.array().cast("array<string>")
    found = F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?=({tree_pattern(names)}))"), F.lit(1)))
    begun = {}
    for name in names:
        shorter = [name[:k] for k in range(1, len(name)) if name[:k] in names]
        if shorter:
            begun[name] = [*shorter, name]
    if not begun:
        return found
    inner = NameTable(begun, "array<string>")
    return F.array_distinct(F.flatten(F.transform(found, lambda n: F.coalesce(inner(n), F.array(n)))))


def names_in_order(text: Column, names: Iterable[str], found: Column | None = None) -> Column:
    """The different names that occur in the text, in the order of ``names``; ``found``: those, where they are known."""
    order = {name: at for at, name in enumerate(dict.fromkeys(names))}
    place = NameTable(order, "int")
    placed = F.transform(names_found(text, order) if found is None else found, lambda n: F.struct(place(n).alias("at"), n.alias("name")))
    return F.transform(F.array_sort(placed), lambda x: x["name"])


def topic_totals(
    lowered: Column, joined: Column, topics: Mapping[str, Iterable[str]], match: str = "substring", found: Column | None = None
) -> Column:
    """(minus, topic) of each topic that scored: two points per keyword that occurs, one for each of a keyword's
    different words that is a token. ``joined`` is the token list as ',a,b,c,'; ``found``: the keywords that occur, where
    these are known."""
    phrases: dict[str, dict[int, int]] = {}
    words: dict[str, dict[int, int]] = {}
    for number, keywords in enumerate(topics.values()):
        for keyword in keywords:
            phrase = keyword if match == "substring" else "," + ",".join(keyword.split()) + ","
            topic_points = phrases.setdefault(phrase, {})
            topic_points[number] = topic_points.get(number, 0) + 2
            for word in dict.fromkeys(keyword.split()):
                token_points = words.setdefault(f",{word},", {})
                token_points[number] = token_points.get(number, 0) + 1

    def points(text: Column, table: dict[str, dict[int, int]], found: Column | None = None) -> Column:
        rows = {name: [{"topic": t, "points": n} for t, n in by.items()] for name, by in table.items()}
        known = NameTable(rows, "array<struct<topic:int,points:int>>")
        return F.flatten(F.transform(names_found(text, table) if found is None else found, lambda n: known(n)))

    hits = F.concat(points(lowered if match == "substring" else joined, phrases, found), points(joined, words))

    def totals(all_hits: Column) -> Column:
        topic = F.array_distinct(F.transform(all_hits, lambda h: h["topic"]))
        return F.transform(topic, lambda t: F.struct(
            F.aggregate(all_hits, F.lit(0), lambda s, h: s - F.when(h["topic"] == t, h["points"]).otherwise(0)).alias("minus"),
            t.alias("topic"),
        ))

    return F.transform(F.array(hits), totals)[0]


def best_of(totals: Column, topics: Iterable[str], fallback: str) -> Column:
    """Highest total wins, the first topic wins a tie, none gives the fallback."""
    names = F.from_json(F.lit(json.dumps(list(topics))), "array<string>")
    return F.coalesce(F.try_element_at(names, F.array_min(totals)["topic"] + 1), F.lit(fallback))
