"""Katz backoff language model, trained and evaluated in tables.

Texts become blocks of numbered tokens. Order by order, blocks send their different n-grams with training counts to
shards; a shard adds them up and answers every block with the totals, in the order asked. From the counts of counts come
Good-Turing discounts (counts up to 5); from sums per history over its seen words come backoff weights that make each
distribution add up to one: what discounting frees is shared among unseen words in proportion to the next lower order.
Below single words stands one unknown word, which takes what is left there. Where nothing is freed (all counts
undiscounted), the history counts one more token, so that unseen words keep a chance.

Only what a block cannot know by itself is sent. A history is followed as often as it occurs (the end has nothing after
it), so its tokens are its own count of the order before; that some of its counts are discounted is told by a mark per
n-gram. Sums go to a block for those histories only after which it has an n-gram that its own training texts lack.

Scoring goes down recursively per token: a seen n-gram has its discounted share, an unseen one the history's weight
times the lower order, an unseen history the lower order itself.

Histories with many tokens are dealt by whole n-gram, others by history, so that no shard has to hold a frequent
history; their partial sums are added in a second step. Blocks, shards and their number follow the data, and a block has
each n-gram once. The order is a parameter; ids of histories and words must fit 63 bits together. What is answered for an
order lies beside the blocks for the orders above; the shards' own tables and shuffles go once it does.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; each text ends with one end token and starts after start
marks. Null texts are empty: one end token. Without training texts everything is unknown. Rows are scored one by one, so
repeated rows and null ids get rows of their own.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import remove, scratch_path, shuffles_removed
from .tallies import bucketed, dealt, pack, pack_sorted, shard_count, shard_edges, summed, unpack, unpack_sorted

BLOCK_TOKENS = 1 << 19  # what a task holds some twenty numbers for
TOP_DISCOUNTED = 5
HOT_HISTORY = 1 << 20
END = b"\n"
ODD = 0x9E3779B97F4A7C15
BLOCK_FIELDS = ("keys", "counts", "tokens", "sizes", "ids", "missing", "train")
MERGED_SCHEMA = (
    "kind string, shard int, block long, hot boolean, keys binary, counts binary, extra binary, marks binary, sums binary, "
    "found long, count_counts array<long>, tokens long"
)


class Block:
    """Texts as token numbers; words are numbered in the order of their hashes once the block is packed."""

    def __init__(self) -> None:
        self.words: dict[bytes, int] = defaultdict()
        self.words.default_factory = self.words.__len__
        self.tokens: list[np.ndarray] = []
        self.ids: list[int | None] = []
        self.train: list[bool] = []
        self.size = 0

    def add(self, doc_id: int | None, train: bool, text: str | None) -> None:
        words = (text or "").encode().lower().split()
        words.append(END)
        self.tokens.append(np.fromiter(map(self.words.__getitem__, words), np.int64, len(words)))
        self.ids.append(doc_id)
        self.train.append(bool(train))
        self.size += len(words)

    def packed(self) -> dict[str, bytes]:
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in self.words], np.uint64)
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        tokens, sizes = rank[np.concatenate(self.tokens)], np.array([len(t) for t in self.tokens], "<i4")
        learnt = np.repeat(np.array(self.train), sizes)
        return {
            "keys": pack_sorted(hashes[order]), "counts": pack(np.bincount(tokens[learnt], minlength=len(order)).astype("<i8")),
            "tokens": pack(tokens.astype("<i4")), "sizes": pack(sizes),
            "ids": pack(np.array([0 if x is None else x for x in self.ids], "<i8")),
            "missing": pack(np.array([x is None for x in self.ids])), "train": pack(np.array(self.train)),
        }


def text_blocks(docs: DataFrame, train: Column, key: str, text: str) -> DataFrame:
    """Blocks of numbered tokens, a written table."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, block = 0, Block()
        schema = pa.schema([("block", pa.int64()), *((f, pa.binary()) for f in BLOCK_FIELDS)])

        def done() -> pa.RecordBatch:
            nonlocal made, block
            row, number = block.packed(), (TaskContext.get().partitionId() << 32) + made
            made, block = made + 1, Block()
            return pa.RecordBatch.from_pylist([{"block": number, **row}], schema)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                block.add(*row)
                if block.size >= BLOCK_TOKENS:
                    yield done()
        if block.size:
            yield done()

    rows = docs.select(F.col(key).cast("long").alias("id"), train.alias("train"), F.col(text).alias("text"))
    return bucketed(rows.mapInArrow(read, "block long, " + ", ".join(f"{f} binary" for f in BLOCK_FIELDS)), "text_blocks", "block")


@dataclass(frozen=True)
class Level:
    """What all blocks need to know of an order: discounts, tokens, the number of n-grams and what discounting frees."""

    discounts: tuple[float, ...]
    tokens: int
    found: int
    freed: float

    def discounted(self, counts: np.ndarray) -> np.ndarray:
        table = np.array([1.0, *self.discounts, 1.0])
        return table[np.minimum(counts, TOP_DISCOUNTED + 1)] * counts

    def word_chance(self, counts: np.ndarray) -> np.ndarray:
        """The probability of single words with these counts; what is left of all tokens is the unknown word's."""
        total = self.tokens if self.freed > 0 else self.tokens + 1
        return np.where(counts > 0, self.discounted(counts) / total, (self.freed if self.freed > 0 else 1) / total)

    def frees(self, marks: np.ndarray) -> np.ndarray:
        """Whether discounting frees anything after histories, by which of the counts 1 to 5 their words have (bits)."""
        return (marks & sum(1 << r for r, d in enumerate(self.discounts) if d < 1)) > 0

    def backoff(self, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens and backoff weights of histories with these sums."""
        freed = sums["n"] @ np.array([(1 - d) * r for r, d in enumerate(self.discounts, 1)])
        total = np.where(freed > 0, sums["tokens"], sums["tokens"] + 1)
        return total, np.where(freed > 0, freed, 1.0) / total / np.maximum(1 - sums["lower"], 1e-300)


def good_turing(n: list[int]) -> tuple[float, ...]:
    """Katz discounts of the counts 1 to 5, from how many n-grams have the counts 1 to 6; 1 where undefined."""
    if not n or not n[0]:
        return (1.0,) * TOP_DISCOUNTED
    beyond = (TOP_DISCOUNTED + 1) * n[TOP_DISCOUNTED] / n[0]
    out = []
    for r in range(1, TOP_DISCOUNTED + 1):
        d = ((r + 1) * n[r] / (r * n[r - 1]) - beyond) / (1 - beyond) if n[r - 1] and beyond != 1 else 1.0
        out.append(d if 0 < d < 1 else 1.0)
    return tuple(out)


def scrambled(x: np.ndarray, bits: int) -> np.ndarray:
    """A one-to-one spread of numbers below 2^bits over that range."""
    return (x.astype(np.uint64) * np.uint64(ODD)) & np.uint64((1 << bits) - 1)


def merged_row(kind: str, shard: int, block: int | None = None, hot: bool = False, **more) -> dict:
    return {"kind": kind, "shard": shard, "block": block, "hot": hot, "keys": None, "counts": None, "extra": None,
            "marks": None, "sums": None, "found": None, "count_counts": None, "tokens": None, **more}


def merged_frame(rows: list[dict]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.strip().split()[0] for c in MERGED_SCHEMA.split(",")])
    return frame.astype({"block": "Int64", "found": "Int64", "tokens": "Int64"})


def add_up(
    group: pd.DataFrame, shard: int, hot: bool, before: int = 0, ids: bool = True
) -> tuple[dict, list[dict], np.ndarray, np.ndarray, list[np.ndarray]]:
    """The size and the answers for the parts of one shard; its keys, totals and each part's places among them.

    Blocks ask in the order of the keys, so the ids of those that are in training rise.
    """
    keys, totals, places = summed(group)
    seen = totals > 0
    index = (np.cumsum(seen) - 1 + before).astype(np.uint64)
    size = merged_row(
        "table", shard, hot=hot, found=int(seen.sum()), tokens=int(totals.sum()),
        count_counts=np.bincount(totals[seen], minlength=TOP_DISCOUNTED + 2)[1 : TOP_DISCOUNTED + 2].tolist(),
    )
    told = [
        merged_row("answer", shard, int(block), hot, counts=pack(totals[p]), extra=pack_sorted(index[p[seen[p]]]) if ids else None)
        for block, p in zip(group["block"], places, strict=True)
    ]
    return size, told, keys, totals, places


def merge_words(group: pd.DataFrame) -> pd.DataFrame:
    size, told, *_ = add_up(group, int(group["shard"].iloc[0]), False)
    return merged_frame([size, *told])


def stored(df: DataFrame, order: int) -> tuple[DataFrame, str]:
    """Writes what the shards of an order made, a table partitioned by kind; and its path."""
    path = scratch_path(df.sparkSession, f"ngrams-{order}")
    df.write.partitionBy("kind").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def level_of(merged: DataFrame) -> Level:
    tables = merged.filter("kind = 'table'")
    sums = [F.sum(F.get("count_counts", F.lit(i))) for i in range(TOP_DISCOUNTED + 1)]
    tokens, found, *n = tables.agg(F.sum("tokens"), F.sum("found"), *sums).first()
    n = [x or 0 for x in n]
    discounts = good_turing(n)
    return Level(discounts, tokens or 0, found or 0, sum((1 - d) * r * n[r - 1] for r, d in enumerate(discounts, 1)))


def answered(merged: DataFrame, order: int) -> DataFrame:
    """(block, answers_<order>): per block the totals and ids of its n-grams; ids start anew in each shard and are
    shifted by the n-grams of earlier shards."""
    sizes = merged.filter("kind = 'table'").groupBy("shard").agg(F.sum("found").alias("found"))
    line = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    shift = sizes.select("shard", F.coalesce(F.sum("found").over(line), F.lit(0)).alias("shift"))
    fields = ("hot", "shard", "counts", "extra", "marks", "sums")
    parts = merged.filter("kind = 'answer'").select("block", *fields).join(F.broadcast(shift), "shard")
    return parts.groupBy("block").agg(F.array_sort(F.collect_list(F.struct(*fields, "shift"))).alias(f"answers_{order}"))


def concatenated(answers: list[dict], hot: bool | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Totals and ids (-1: not in training) in the order in which the block asked."""
    chosen = [a for a in answers if hot is None or a["hot"] == hot]
    if not chosen:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    counts, ids = [unpack(a["counts"], "<i8") for a in chosen], []
    for a, c in zip(chosen, counts, strict=True):
        own = np.full(len(c), -1)
        if a["extra"] is not None:  # not after the last order
            own[c > 0] = unpack_sorted(a["extra"]).astype(np.int64) + a["shift"]
        ids.append(own)
    return np.concatenate(counts), np.concatenate(ids)


class Walk:
    """A block on its way up the orders: per token its word id, its n-gram of the present order and its probability."""

    def __init__(self, row: dict, level: Level) -> None:
        tokens, self.sizes = unpack(row["tokens"], "<i4"), unpack(row["sizes"], "<i4").astype(np.int64)
        counts, ids = concatenated(row["answers_1"])
        self.counts, self.word = counts[tokens], ids[tokens]
        self.gram, self.gram_count, self.words = self.word, self.counts, level.found
        self.train = np.repeat(unpack(row["train"], "?"), self.sizes)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.found = level.found
        self.p = level.word_chance(self.counts)

    def step(self) -> None:
        """To the next order: the history of a token is the n-gram that ended before it, or the start mark."""
        history = np.empty_like(self.gram)
        history[1:] = self.gram[:-1]
        history[self.first] = self.found  # the number after the last n-gram stands for the start
        counts = np.empty_like(self.gram_count)
        counts[1:] = self.gram_count[:-1]
        counts[self.first] = HOT_HISTORY + 1
        self.before, hot_history = counts, counts > HOT_HISTORY
        self.history_bits, self.word_bits = int(self.found + 1).bit_length(), max(1, int(self.words).bit_length())
        if self.history_bits + self.word_bits > 63:
            raise ValueError("too many different n-grams for this order")
        self.asked = {}
        spread = scrambled(np.maximum(history, 0), self.history_bits)
        unsure = (history >= 0) & ~hot_history
        for hot in (False, True):
            at = np.flatnonzero((history >= 0) & (self.word >= 0) & (hot_history == hot))
            word = self.word[at].astype(np.uint64)
            if hot:
                key = scrambled((history[at].astype(np.uint64) << np.uint64(self.word_bits)) | word, self.history_bits + self.word_bits)
            else:
                key = (spread[at] << np.uint64(self.word_bits)) | word
            keys, first, place = np.unique(key, return_index=True, return_inverse=True)
            learnt = np.bincount(place[self.train[at]], minlength=len(keys)).astype("<i8")
            unsure[at[learnt[place] > 0]] = False
            self.asked[hot] = (at, keys, first, place, learnt)
        self.unsure, self.hot_at = np.flatnonzero(unsure), np.flatnonzero(hot_history)
        self.wanted, self.wanted_place = np.unique(spread[self.unsure], return_inverse=True)
        self.hot_histories, self.hot_place = np.unique(spread[self.hot_at], return_inverse=True)

    def climb(self, answers: list[dict], weights: list[dict], level: Level) -> None:
        """Takes up what the shards answered for the order that ``step`` asked about."""
        counts, ids = np.zeros(len(self.p), np.int64), np.full(len(self.p), -1)
        for hot, (at, _, _, place, _) in self.asked.items():
            totals, own = concatenated(answers, hot)
            counts[at], ids[at] = totals[place], own[place]
        weight, total = np.ones(len(self.p)), np.ones(len(self.p), np.int64)
        if marks := [unpack(a["marks"], "u1") for a in answers if not a["hot"]]:
            at, _, _, place, _ = self.asked[False]
            total[at] = self.before[at] + ~level.frees(np.concatenate(marks))[place]
        if sums := [unpack(a["sums"], SUMS) for a in answers if a["sums"] is not None]:
            weight[self.unsure] = level.backoff(np.concatenate(sums))[1][self.wanted_place]
        if weights:
            weight[self.hot_at] = np.concatenate([unpack(w["extra"], "<f8") for w in weights])[self.hot_place]
            total[self.hot_at] = np.concatenate([unpack(w["counts"], "<i8") for w in weights])[self.hot_place]
        self.p = np.where(counts > 0, level.discounted(counts) / total, weight * self.p)
        self.gram, self.gram_count, self.total, self.found = ids, counts, total, level.found
        del self.asked, self.before, self.unsure, self.hot_at, self.wanted, self.wanted_place, self.hot_histories, self.hot_place


def walked(row: dict, levels: list[Level]) -> Walk:
    walk = Walk(row, levels[0])
    for order, level in enumerate(levels[1:], 2):
        walk.step()
        walk.climb(row[f"answers_{order}"] or [], row[f"weights_{order}"] or [], level)
    return walk


def ask(levels: list[Level], shards: int) -> Callable:
    """A function for mapInArrow: what blocks ask of the shards of the next order."""
    schema = pa.schema([
        ("shard", pa.int32()), ("block", pa.int64()), ("hot", pa.bool_()), ("keys", pa.binary()), ("counts", pa.binary()),
        ("lower", pa.binary()), ("lower_at", pa.binary()), ("wanted", pa.binary()), ("bits", pa.int32()), ("word_bits", pa.int32()),
    ])

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                walk = walked(row, levels)
                walk.step()
                bits, history_bits = walk.history_bits + walk.word_bits, walk.history_bits
                common = {"block": row["block"], "bits": bits, "word_bits": walk.word_bits}
                parts = []
                wants = shard_edges(walk.wanted, shards, history_bits)
                for hot, (at, keys, first, _, counts) in walk.asked.items():
                    # No shard ends within a history that is dealt as a whole.
                    edges = shard_edges(keys, shards, bits) if hot else shard_edges(keys >> np.uint64(walk.word_bits), shards, history_bits)
                    one = at[first]
                    for s in range(shards):
                        a, z = edges[s], edges[s + 1]
                        wanted = walk.wanted[wants[s] : wants[s + 1]] if not hot else walk.wanted[:0]
                        if a < z or len(wanted):
                            parts.append(common | {
                                "shard": s, "hot": hot, "keys": pack_sorted(keys[a:z]), "counts": pack(counts[a:z]),
                                "wanted": pack_sorted(wanted) if len(wanted) else None,
                                **lower_order(walk, one[a:z][counts[a:z] > 0], len(levels)),
                            })
                # Frequent histories go to the shard that adds up their partial sums.
                edges = shard_edges(walk.hot_histories, shards, history_bits)
                parts += [
                    common | {"shard": s, "hot": None, "keys": pack_sorted(walk.hot_histories[edges[s] : edges[s + 1]])}
                    for s in range(shards) if edges[s] < edges[s + 1]
                ]
                yield pa.RecordBatch.from_pylist(parts, schema)

    return asked


def lower_order(walk: Walk, at: np.ndarray, order: int) -> dict[str, bytes | None]:
    """What gives the lower-order chances of the tokens at these places: counts and, but for single words, their
    histories' tokens. The lower n-grams are in training, as theirs are."""
    if order == 1:
        return {"lower": None, "lower_at": pack(walk.counts[at])}
    return {"lower": pack(walk.total[at]), "lower_at": pack(walk.gram_count[at])}


ASKED_SCHEMA = (
    "shard int, block long, hot boolean, keys binary, counts binary, lower binary, lower_at binary, wanted binary, "
    "bits int, word_bits int"
)
SUMS = np.dtype([("history", "<u8"), ("tokens", "<i8"), ("lower", "<f8"), ("n", "<i8", (TOP_DISCOUNTED,))])


def history_sums(history: np.ndarray, totals: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Per history: its tokens, the lower-order chances of its seen words, and how many of them have counts 1 to 5."""
    names, place = np.unique(history, return_inverse=True)
    out = np.zeros(len(names), SUMS)
    out["history"] = names
    out["tokens"] = np.bincount(place, totals, len(names))
    out["lower"] = np.bincount(place, lower, len(names))
    for r in range(TOP_DISCOUNTED):
        out["n"][:, r] = np.bincount(place[totals == r + 1], minlength=len(names))
    return out


def history_marks(history: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Which of the counts 1 to 5 the n-grams of each one's history have, as bits; histories are sorted."""
    marks = np.where((totals > 0) & (totals <= TOP_DISCOUNTED), 1 << np.maximum(totals - 1, 0), 0).astype(np.uint8)
    if not len(marks):
        return marks
    new = np.concatenate([[True], history[1:] != history[:-1]])
    return np.bitwise_or.reduceat(marks, np.flatnonzero(new))[np.cumsum(new) - 1]


def sums_of(names: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """The sums of these histories, 0 for those that have none."""
    out = np.zeros(len(names), SUMS)
    if len(sums):
        at = np.minimum(np.searchsorted(sums["history"], names), len(sums) - 1)
        known = sums["history"][at] == names
        out[known] = sums[at[known]]
    out["history"] = 0  # the block knows which it asked for
    return out


def merge_grams(shards: int, levels: list[Level], last: bool) -> Callable:
    """A function for applyInPandas: adds up a shard's n-grams and answers the blocks. ``levels``: of the lower orders."""

    def chances(tokens: bytes | None, counts: bytes) -> np.ndarray:
        counts = unpack(counts, "<i8")
        return levels[0].word_chance(counts) if tokens is None else levels[-1].discounted(counts) / unpack(tokens, "<i8")

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        shard, bits, word_bits = int(group["shard"].iloc[0]), int(group["bits"].iloc[0]), int(group["word_bits"].iloc[0])
        rows, before = [], 0
        for hot in (False, True):
            part = group[group["hot"].map(lambda h: h is not None and h == hot)]
            if not len(part):
                continue
            size, told, keys, totals, places = add_up(part, shard, hot, before, not last)
            before += size["found"]
            rows.append(size)
            lower = np.empty(len(keys))
            for place, counts, *given in zip(places, part["counts"], part["lower"], part["lower_at"], strict=True):
                lower[place[unpack(counts, "<i8") > 0]] = chances(*given)
            seen = totals > 0
            if hot:
                whole = (keys[seen] * np.uint64(pow(ODD, -1, 1 << 64))) & np.uint64((1 << bits) - 1)
                sums = history_sums(scrambled(whole >> np.uint64(word_bits), bits - word_bits), totals[seen], lower[seen])
                edges = shard_edges(sums["history"], shards, bits - word_bits)
                rows += [
                    merged_row("sums", s, hot=hot, sums=pack(sums[edges[s] : edges[s + 1]]))
                    for s in range(shards) if edges[s] < edges[s + 1]
                ]
            else:
                history = keys >> np.uint64(word_bits)
                marks, sums = history_marks(history, totals), history_sums(history[seen], totals[seen], lower[seen])
                for answer, place, wanted in zip(told, places, part["wanted"], strict=True):
                    answer["marks"] = pack(marks[place])
                    if isinstance(wanted, bytes):
                        answer["sums"] = pack(sums_of(unpack_sorted(wanted), sums))
            rows += told
        for block, keys in zip(group["block"], group["keys"].where(group["hot"].isna()), strict=True):
            if isinstance(keys, bytes):
                rows.append(merged_row("history", shard, int(block), keys=keys))
        return merged_frame(rows)

    return merge


def weigh(level: Level) -> Callable:
    """Tokens and backoff weights of a shard's frequent histories, for every block that asked for them."""

    def weights(group: pd.DataFrame) -> pd.DataFrame:
        shard = int(group["shard"].iloc[0])
        parts = [unpack(x, SUMS) for x in group["sums"][group["kind"] == "sums"]]
        parts = np.concatenate(parts) if parts else np.empty(0, SUMS)
        names, place = np.unique(parts["history"], return_inverse=True)
        sums = np.zeros(len(names), SUMS)
        sums["history"] = names
        for field in ("tokens", "lower", "n"):
            np.add.at(sums[field], place, parts[field])
        rows = []
        for block, keys in zip(group["block"], group["keys"], strict=True):
            if isinstance(keys, bytes):
                total, weight = level.backoff(sums_of(unpack_sorted(keys), sums))
                rows.append((int(block), shard, pack(total), pack(weight)))
        return pd.DataFrame(rows, columns=["block", "shard", "counts", "extra"])

    return weights


def next_order(blocks: DataFrame, known: list[DataFrame], levels: list[Level], shards: int, last: bool) -> tuple[Level, DataFrame, str]:
    """Counts one more order; its level, what blocks get to know (answers and weights) and the path this is read from."""
    order = len(levels) + 1
    frame = reduce(lambda a, b: a.join(b, "block", "left"), known, blocks)
    asked = frame.mapInArrow(ask(levels, shards), ASKED_SCHEMA)
    merged, path = stored(asked.groupBy("shard").applyInPandas(merge_grams(shards, levels, last), MERGED_SCHEMA), order)
    level = level_of(merged)
    told = merged.filter("kind IN ('sums', 'history')").select("kind", "shard", "block", "keys", "sums").groupBy("shard").applyInPandas(
        weigh(level), "block long, shard int, counts binary, extra binary"
    )
    weights = told.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("shard", "counts", "extra"))).alias(f"weights_{order}"))
    return level, answered(merged, order).join(weights, "block", "full"), path


def beside(told: DataFrame, order: int, path: str) -> DataFrame:
    """What blocks get to know of an order, written so that it is not moved again; the table it came from goes."""
    kept = bucketed(told, f"answers_{order}", "block")
    remove(told.sparkSession, path)
    return kept


def katz_scores(
    docs: DataFrame, train: Column, *, order: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, train, n_tokens, n_known, train_tokens, train_words, base_score, score) per row.

    ``train`` tells which rows the model learns from. Scores are sums of log10 probabilities; the base is add-one
    smoothing over single words. ``order`` is the longest n-gram.
    """
    spark = docs.sparkSession
    blocks = text_blocks(docs, train, key, text)
    size = blocks.agg(F.sum(F.octet_length("tokens"))).first()[0] or 0  # some two bytes a token
    shards = shard_count(spark, size // 2)
    with shuffles_removed(spark):
        merged, path = stored(dealt(blocks, shards).groupBy("shard").applyInPandas(merge_words, MERGED_SCHEMA), 1)
        levels, known = [level_of(merged)], [answered(merged, 1)]
        for n in range(2, order + 1):
            known[-1] = beside(known[-1], n - 1, path)
            level, told, path = next_order(blocks, known, levels, shards, n == order)
            levels, known = [*levels, level], [*known, told]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = levels[0]
        for batch in batches:
            for row in batch.to_pylist():
                walk = walked(row, levels)
                add = lambda x: np.add.reduceat(x, walk.first)
                n, ids = len(walk.sizes), unpack(row["ids"], "<i8")
                base = np.log10((walk.counts + 1) / (first.tokens + first.found + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64(), mask=unpack(row["missing"], "?")), pa.array(unpack(row["train"], "?")),
                        pa.array(walk.sizes), pa.array(add((walk.counts > 0).astype(np.int64))),
                        pa.array(np.full(n, first.tokens)), pa.array(np.full(n, first.found)),
                        pa.array(add(base)), pa.array(add(np.log10(walk.p))),
                    ],
                    names=[key, "train", "n_tokens", "n_known", "train_tokens", "train_words", "base_score", "score"],
                )

    frame = reduce(lambda a, b: a.join(b, "block", "left"), known, blocks)
    return frame.mapInArrow(
        score, f"{key} long, train boolean, n_tokens long, n_known long, train_tokens long, train_words long, "
        "base_score double, score double",
    )
