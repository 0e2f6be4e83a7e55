"""Line deduplication by an exact set-similarity join.

A line is the set of its words, A-Z lower-cased. A line is removed if an earlier line (by document id, then place in the
document) has the same set, or one with a Jaccard similarity of at least the threshold. Whether that earlier line is
itself removed makes no difference.

Equal sets are found by a 128-bit hash. For the others, words are ordered by rarity over all lines, and by hash among
equally rare ones. Two similar sets share a word among the first few of this order (prefix filter), lengths that differ
little (length filter) and enough words from the shared one on (positional filter); words that only one line has are
left out, and a 128-bit parity map bounds the difference of two sets from below. Words that more than ``HOT`` lines have
are filed in pairs: sets whose first shared word is that frequent share a second one at least as frequent within one more
place of the prefix. Nothing is left out. The list of a pair has no bound and lies in one shard; in it, lines of the same
size and place are ruled out together, and other lines are compared in pairs. What passes is verified on the words.

Each line first names, per word, only its most similar earlier line; lines for which none of these is verified name all
their candidates in a second pass. Groups of many similar lines so cost a few pairs per line.

Texts are read twice: once into blocks of numbered words, which stay where they are while small answers are joined to
them, and once to take lines out. Words are compared by a 64-bit hash, taken of all words of some rows together.

Blank lines are kept and match nothing. Null ids come last, by the hash of their text, and are documents of their own: of
those with the same text all but one lose all their lines. Null texts have no lines. Lines at the same place of rows that
share an id are not compared with each other; so rows with the same id and text lose the same lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialized
from .shingles import mixed
from .tallies import (
    answers, bucketed, dealt, distinct, dropped, gathered, pack, pack_sorted, shard_count, shard_edges, tidied,
    unpack, unpack_sorted,
)
from .words import BLANKS

BLOCK_TOKENS = 1 << 19
PIECE_BYTES = 1 << 19  # a block may have so many more
LONG_WORD = 256
ALL_BITS = np.uint64((1 << 64) - 1)
HOT = 5000
NO_ID = (1 << 63) - 1
POSTINGS_PER_SHARD = 1 << 19
PAIRS_AT_ONCE = 1 << 18
ASKED_AT_ONCE = 1 << 14  # pairs of a block that are sent to be verified in one part
POSTING = np.dtype([
    ("key", "<u8"), ("map", "<u8"), ("high", "<u8"), ("doc", "<i8"), ("tie", "<i8"), ("line", "<i4"), ("at_line", "<i4"), ("n", "<i4"), ("at", "<i4"), ("block", "<i8")
])
SENT = [f for f in POSTING.names if f != "block"]  # a posting says its line's number in the block as at_line
CANDIDATE_SCHEMA = "shard int, block_y long, at_y int, block_x long, at_x int, differ int, more boolean, kept binary"
Y, X = ("block_y", "at_y"), ("block_x", "at_x")
BLOCK_FIELDS = ("keys", "counts", "tokens", "sizes", "doc", "rid", "line", "set_a", "set_b")


def overlap(n_x: np.ndarray, n_y: np.ndarray, percent: int) -> np.ndarray:
    """The fewest shared words that make two sets of these sizes similar."""
    return -(-percent * (n_x + n_y) // (100 + percent))


def lowered_words(lines: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all lines, A-Z lower-cased, and how many each line has."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(lines))
    words, owner = parts.flatten(), pc.list_parent_indices(parts)
    full = pc.greater(pc.binary_length(words), 0)  # blanks around a line leave empty ones
    return words.filter(full), np.bincount(owner.filter(full).to_numpy(), minlength=len(lines))


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash per word: eight bytes at a time are mixed in, for all words together; long words go one by one."""
    words = words.cast(pa.large_binary())
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, "<i8")[words.offset : words.offset + len(words) + 1]
    size = np.diff(offsets)
    padded = np.concatenate([np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8), np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))  # from every byte on
    out = mixed(size.astype(np.uint64))
    at, left, done = offsets[:-1], size, 0
    live = np.flatnonzero(left <= LONG_WORD)
    while len(live):
        more = left[live] - done
        part = eight[at[live] + done] & (ALL_BITS >> (8 * np.maximum(8 - more, 0)).astype(np.uint64))
        out[live] = mixed((out[live] ^ part) + np.uint64(0x9E3779B97F4A7C15))
        done += 8
        live = live[more > 8]
    for i in np.flatnonzero(left > LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(padded[offsets[i] : offsets[i + 1]].tobytes())
    return out


def sort_order(keys: np.ndarray) -> np.ndarray:
    """Where the sorted keys, none below 0, come from; equal keys stay in their order.

    Sorting numbers is quicker than sorting places, so the places are sorted as the low bits of the keys. Keys that
    differ in these bits only are put in order afterwards.
    """
    if not len(keys):
        return np.empty(0, np.int64)
    keys = keys.astype(np.uint64)
    keys <<= np.uint64(64 - max(1, int(keys.max()).bit_length()))
    low = np.uint64((1 << len(keys).bit_length()) - 1)
    order = (np.sort((keys & ~low) | np.arange(len(keys), dtype=np.uint64)) & low).astype(np.int64)
    found = keys[order]
    return order[np.argsort(found, kind="stable")] if (found[1:] < found[:-1]).any() else order


def ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted different values, and each value's place among them."""
    order = sort_order(values)
    found = values[order]
    new = np.concatenate([[True], found[1:] != found[:-1]])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new) - 1
    return found[new], rank


class Block:
    """Lines of some documents, with words numbered in the order of their hashes."""

    def __init__(self) -> None:
        self.words: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.size = 0

    def add(self, doc: int, rid: int, text: str | None) -> None:
        self.add_rows(pa.array([doc], pa.int64()), pa.array([rid], pa.int64()), pa.array([text], pa.string()))

    def add_rows(self, doc: pa.Array, rid: pa.Array, text: pa.Array) -> None:
        parts = pc.split_pattern(text, "\n")  # none of null
        row = pc.list_parent_indices(parts).to_numpy()
        words, sizes = lowered_words(parts.flatten())
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else row
        number = np.arange(len(row)) - np.repeat(first, np.diff(first, append=len(row)))
        full = sizes > 0
        row = row[full]
        self.places.append(np.array([doc.to_numpy()[row], rid.to_numpy()[row], number[full]], np.int64))
        self.words.append(word_hashes(words))
        self.sizes.append(sizes[full])
        self.size += len(words)

    def packed(self) -> dict[str, bytes]:
        own, rank = ranked(np.concatenate(self.words))
        sizes = np.concatenate(self.sizes)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        once = distinct((owner << 32) | rank)
        sizes, words = np.bincount(once >> 32), once & 0xFFFFFFFF
        a, b = (np.add.reduceat(mixed(own[words] + np.uint64(salt)), np.cumsum(sizes) - sizes) for salt in (1, 2))
        doc, rid, line = np.concatenate(self.places, axis=1)
        return {
            "keys": pack_sorted(own), "counts": pack(np.bincount(words, minlength=len(own)).astype("<i8")),
            "tokens": pack(words.astype("<i4")), "sizes": pack(sizes.astype("<i4")), "doc": pack(doc), "rid": pack(rid),
            "line": pack(line.astype("<i4")), "set_a": pack(a), "set_b": pack(b),
        }


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, rid, text): the id, the largest long for null, and the hash of the text."""
    doc = F.coalesce(F.col(key), F.lit(NO_ID)).cast("long")
    return docs.select(doc.alias("doc"), F.xxhash64(text).alias("rid"), F.col(text).alias("text"))


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have some ``PIECE_BYTES`` together, or one row with more."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(), dtype=np.int64)
    low = 0
    while low < len(ends):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + PIECE_BYTES, "right")))
        yield batch.slice(low, high - low)
        low = high


def line_blocks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Blocks of lines with their words, a written table."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidied()
        made, block = 0, Block()

        def done() -> pa.RecordBatch:
            nonlocal made, block
            row, number = block.packed(), (TaskContext.get().partitionId() << 32) + made
            made, block = made + 1, Block()
            return pa.RecordBatch.from_pylist(
                [{"block": number, **row}], pa.schema([("block", pa.int64()), *((f, pa.binary()) for f in BLOCK_FIELDS)])
            )

        for batch in batches:
            for piece in pieces(batch):
                block.add_rows(*piece.columns)
                if block.size >= BLOCK_TOKENS:
                    yield done()
        if block.size:
            yield done()

    schema = "block long, " + ", ".join(f"{f} binary" for f in BLOCK_FIELDS)
    return bucketed(keyed(docs, key, text).mapInArrow(read, schema), "line_blocks", "block")


def line_places(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All lines' document, what orders documents without id (the hash of their text), and number."""
    doc = unpack(row["doc"], "<i8")
    return doc, np.where(doc == NO_ID, unpack(row["rid"], "<i8"), 0), unpack(row["line"], "<i4")


def own_sets(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """The block's lines by set and place, and where each set begins among them."""
    a, b = unpack(row["set_a"], "<u8"), unpack(row["set_b"], "<u8")
    doc, tie, line = line_places(row)
    order = np.lexsort((line, tie, doc, b, a))
    a, b = a[order], b[order]
    starts = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return order, starts


def first_places(blocks: DataFrame, shards: int) -> DataFrame:
    """(block, firsts): for each different set of a block, in order, whether its first place in the block is its first of all."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.int32()), ("block", pa.int64()), *((f, pa.binary()) for f in ("a", "b", "doc", "tie", "line"))])
        for batch in batches:
            for row in batch.to_pylist():
                order, starts = own_sets(row)
                at = order[starts]
                fields = {"a": unpack(row["set_a"], "<u8")[at], "b": unpack(row["set_b"], "<u8")[at]}
                fields |= {f: x[at] for f, x in zip(("doc", "tie", "line"), line_places(row), strict=True)}
                edges = shard_edges(fields["a"], shards)
                yield pa.RecordBatch.from_pylist([
                    {"shard": s, "block": row["block"], **{f: pack(x[edges[s] : edges[s + 1]]) for f, x in fields.items()}}
                    for s in range(shards) if edges[s] < edges[s + 1]
                ], schema)

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        a, b, doc, tie, line = (
            [unpack(x, t) for x in group[f]]
            for f, t in (("a", "<u8"), ("b", "<u8"), ("doc", "<i8"), ("tie", "<i8"), ("line", "<i4"))
        )
        ends = np.cumsum([len(x) for x in a])
        a, b, doc, tie, line = (np.concatenate(x) for x in (a, b, doc, tie, line))
        order = np.lexsort((line, tie, doc, b, a))
        new = np.concatenate([[True], (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)])
        least = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        first = np.empty(len(order), bool)
        first[order] = (doc[order] == doc[least]) & (tie[order] == tie[least]) & (line[order] == line[least])
        parts = np.split(first, ends[:-1])
        return pd.DataFrame({"block": group["block"], "shard": group["shard"], "firsts": [pack(p) for p in parts]})

    fields = ("block", "doc", "rid", "line", "set_a", "set_b")
    parts = blocks.select(*fields).mapInArrow(deal, "shard int, block long, a binary, b binary, doc binary, tie binary, line binary")
    return gathered(parts.groupBy("shard").applyInPandas(answer, "block long, shard int, firsts binary"), "firsts")


def first_lines(row: dict) -> np.ndarray:
    """Which lines of a block are at the first place of their set."""
    order, starts = own_sets(row)
    doc, tie, line = line_places(row)
    known = np.concatenate([unpack(x, "?") for x in row["firsts"]])
    group = np.cumsum(np.isin(np.arange(len(order)), starts)) - 1
    least = order[starts][group]
    out = np.empty(len(order), bool)
    out[order] = known[group] & (doc[order] == doc[least]) & (tie[order] == tie[least]) & (line[order] == line[least])
    return out


def prefixes(row: dict, percent: int) -> np.ndarray:
    """The postings of one block's first lines, sorted by key; ``row`` has the block and what it was answered."""
    own, sizes = unpack_sorted(row["keys"]), unpack(row["sizes"], "<i4").astype(np.int64)
    totals = np.concatenate([unpack(t, "<i8") for t in row["totals"]])
    order = np.argsort(totals, kind="stable")  # the words come by hash
    rarity = np.empty(len(order), np.int64)
    rarity[order] = np.arange(len(order))
    starts, tokens = np.cumsum(sizes) - sizes, unpack(row["tokens"], "<i4")
    bit = mixed(own) >> np.uint64(57)
    one = np.uint64(1) << (bit & np.uint64(63))
    low, high = (np.bitwise_xor.reduceat(np.where(half, one, np.uint64(0))[tokens], starts) for half in (bit < 64, bit >= 64))
    reach = sizes - -(-percent * sizes // 100) + 1
    # Smaller sets are similar to equal ones only, and those are found by their hash.
    can = (sizes * 100 >= percent * (sizes + 1)) & first_lines(row)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    by_rarity = np.sort((owner << 32) | rarity[tokens])
    # Of each line only the words up to one beyond its reach count.
    some = np.where(can, np.minimum(reach + 1, sizes), 0)
    owner = np.repeat(np.arange(len(sizes)), some)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(some) - some, some)
    word = order[by_rarity[starts[owner] + at] & 0xFFFFFFFF]
    count = totals[word]
    single = np.flatnonzero((at < reach[owner]) & (count > 1) & (count <= HOT))
    hot = np.flatnonzero(count > HOT)
    keys, first = [own[word[single]]], [single]
    for step in range(1, len(hot)):  # pairs of frequent words of a line; ends when no line has so many
        left, right = hot[:-step], hot[step:]
        same = owner[left] == owner[right]
        if not same.any():
            break
        left, right = left[same], right[same]
        keys.append(mixed(own[word[left]] * np.uint64(3) + own[word[right]]))
        first.append(left)
    key, first = np.concatenate(keys), np.concatenate(first)
    by_key = sort_order(key)
    key, first = key[by_key], first[by_key]
    line = owner[first]
    out = np.empty(len(key), POSTING)
    out["key"], out["at"], out["n"], out["at_line"] = key, at[first], sizes[line], line
    out["map"], out["high"] = low[line], high[line]
    out["doc"], out["tie"], out["line"] = (x[line] for x in line_places(row))
    out["block"] = row["block"]
    return out


def packed_postings(p: np.ndarray) -> dict[str, bytes]:
    return {f: (pack_sorted if f == "key" else pack)(np.ascontiguousarray(p[f])) for f in SENT}


def unpacked_postings(rows: list[dict]) -> np.ndarray:
    """The postings of several blocks, by key, set size and place; equal ones by block, and in one as they come."""
    parts = []
    for row in sorted(rows, key=lambda row: row["block"]):
        key = unpack_sorted(row["key"])
        part = np.empty(len(key), POSTING)
        part["key"], part["block"] = key, row["block"]
        for f in SENT[1:]:
            part[f] = unpack(row[f], POSTING[f].str)
        parts.append(part)
    p = np.concatenate(parts)
    by_place = sort_order((p["n"].astype(np.int64) << 32) | p["at"])
    return p[by_place[sort_order(p["key"][by_place])]]


def postings(answered: DataFrame, shards: int, percent: int) -> DataFrame:
    """(shard, block, fields...): postings of all blocks, dealt by key."""
    schema = "shard int, block long, " + ", ".join(f"{f} binary" for f in SENT)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.schema([("shard", pa.int32()), ("block", pa.int64()), *((f, pa.binary()) for f in SENT)])
        for batch in batches:
            for row in batch.to_pylist():
                p = prefixes(row, percent)
                edges = shard_edges(np.ascontiguousarray(p["key"]), shards)
                yield pa.RecordBatch.from_pylist([
                    {"shard": s, "block": row["block"], **packed_postings(p[edges[s] : edges[s + 1]])}
                    for s in range(shards) if edges[s] < edges[s + 1]
                ], arrow)

    needed = ("block", "keys", "tokens", "sizes", "doc", "rid", "line", "set_a", "set_b", "totals", "firsts")
    return answered.select(*needed).mapInArrow(file, schema)


def possible(p: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(x, y): pairs of postings, sorted by key, n and at, with a common key, whose lengths and places allow the similarity.

    Postings of the same key, length and place are ruled out together, and pairs come in steps of bounded size.
    """
    key, n, place = p["key"], p["n"].astype(np.int64), p["at"].astype(np.int64)
    new = (key[1:] != key[:-1]) | (n[1:] != n[:-1]) | (place[1:] != place[:-1])
    starts = np.flatnonzero(np.concatenate([[True], new])) if len(p) else np.empty(0, np.int64)
    length = np.diff(starts, append=len(p))
    at, gap = np.arange(len(starts)), 0
    while len(at):
        at = at[at + gap < len(starts)]
        at = at[(key[starts[at]] == key[starts[at + gap]]) & (100 * n[starts[at]] >= percent * n[starts[at + gap]])]
        a, b = starts[at], starts[at + gap]  # larger sets only follow
        need = overlap(n[a], n[b], percent)
        fits = (n[a] - place[a] >= need) & (n[b] - place[b] >= need) & ((length[at] > 1) | (gap > 0))
        a, b, rows, width = a[fits], b[fits], length[at][fits], length[at + gap][fits]
        ends = np.cumsum(rows * width)
        for low in range(0, int(ends[-1]) if len(ends) else 0, PAIRS_AT_ONCE):
            t = np.arange(low, min(low + PAIRS_AT_ONCE, int(ends[-1])))
            run = np.searchsorted(ends, t, "right")
            t -= ends[run] - rows[run] * width[run]
            x, y = a[run] + t // width[run], b[run] + t % width[run]
            yield (x, y) if gap else (x[x < y], y[x < y])
        gap += 1


def similar(p: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(later, earlier, difference): candidate pairs of postings that are sorted by key, n and at.

    They share a key, and lengths, places and maps allow the similarity.
    """
    n, low, high = p["n"].astype(np.int64), p["map"], p["high"]
    for x, y in possible(p, percent):
        need = overlap(n[x], n[y], percent)
        differ = np.bitwise_count(low[x] ^ low[y]).astype(np.int64) + np.bitwise_count(high[x] ^ high[y])
        same_doc = (p["doc"][x] == p["doc"][y]) & (p["tie"][x] == p["tie"][y])
        fits = (differ <= n[x] + n[y] - 2 * need) & ~(same_doc & (p["line"][x] == p["line"][y]))
        x, y, differ = x[fits], y[fits], differ[fits]
        if len(x):
            after, same = np.zeros(len(x), bool), np.ones(len(x), bool)
            for f in ("doc", "tie", "line"):
                after |= same & (p[f][x] > p[f][y])
                same &= p[f][x] == p[f][y]
            yield np.where(after, x, y), np.where(after, y, x), differ


def named(p: np.ndarray, shard: int, later: np.ndarray, earlier: np.ndarray, differ: np.ndarray, more: np.ndarray) -> pd.DataFrame:
    y, x = p[later], p[earlier]
    return pd.DataFrame({
        "shard": np.full(len(y), shard, np.int32), "block_y": y["block"], "at_y": y["at_line"], "block_x": x["block"],
        "at_x": x["at_line"], "differ": differ.astype(np.int32), "more": more, "kept": None,
    }).astype({c: "Int64" for c in (*Y, *X)} | {"kept": object})


def closest(group: pd.DataFrame, percent: int) -> pd.DataFrame:
    """For each posting its most similar earlier line and whether there are others; one more row keeps the postings
    of the keys where there are."""
    p = unpacked_postings(group.to_dict("records"))
    best, partner, seen = np.full(len(p), 1 << 30), np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
    for later, earlier, differ in similar(p, percent):
        seen += np.bincount(later, minlength=len(p))
        order = np.argsort(-differ, kind="stable")  # of several for one line the closest is written last
        later, earlier, differ = later[order], earlier[order], differ[order]
        better = differ < best[later]
        best[later[better]], partner[later[better]] = differ[better], earlier[better]
    found = np.flatnonzero(seen)
    shard = int(group["shard"].iloc[0])
    out = named(p, shard, found, partner[found], best[found], seen[found] > 1)
    open_ = p[np.isin(p["key"], p["key"][seen > 1])]
    if len(open_):
        keeps = pd.DataFrame({"shard": [shard], **{c: pd.array([pd.NA], "Int64") for c in (*Y, *X)}, "differ": [0], "more": [False], "kept": [pack(open_)]})
        out = pd.concat([out, keeps], ignore_index=True)
    return out


def all_candidates(percent: int):
    """A function for mapInPandas over (shard, kept, wanted): all earlier candidates of the wanted lines."""

    def name(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, kept, wanted in zip(batch["shard"], batch["kept"], batch["wanted"], strict=True):
                p = unpack(kept, POSTING.descr)
                blocks, number = np.unique(p["block"], return_inverse=True)
                asked = np.array([(w["block_y"], w["at_y"]) for w in wanted], np.int64)
                known = np.minimum(np.searchsorted(blocks, asked[:, 0]), len(blocks) - 1)
                asked = (known[blocks[known] == asked[:, 0]] << 32) | asked[blocks[known] == asked[:, 0], 1]
                is_asked = np.isin((number << 32) | p["at_line"], asked)
                near = np.isin(p["key"], p["key"][is_asked])
                p, is_asked = p[near], is_asked[near]
                for later, earlier, differ in similar(p, percent):
                    keep = is_asked[later]
                    yield named(p, shard, later[keep], earlier[keep], differ[keep], np.zeros(int(keep.sum()), bool))

    return name


def confirmed(pairs: DataFrame, blocks: DataFrame, percent: int) -> DataFrame:
    """(block_y, at_y): the later lines of pairs whose word sets are similar, a written table.

    The later line's words go with the pair to the earlier line's, which are fetched once for each line.
    """
    spark = pairs.sparkSession
    pairs = materialized(spark, pairs.select(*Y, *X).distinct(), "line-pairs")
    source = blocks.select("block", "keys", "tokens", "sizes")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own, words, sizes = unpack_sorted(row["keys"]), unpack(row["tokens"], "<i4"), unpack(row["sizes"], "<i4")
                ends, asked = np.cumsum(sizes), row["asked"]
                sets = [own[words[ends[x["at"]] - sizes[x["at"]] : ends[x["at"]]]].tobytes() for x in asked]
                fields = [f for f in asked[0] if f != "at"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["block"]] * len(asked), pa.int64()), pa.array([x["at"] for x in asked], pa.int32()),
                        *[pa.array([x[f] for x in asked], pa.int64() if f == "block_x" else pa.int32()) for f in fields],
                        pa.array(sets, pa.binary()),
                    ],
                    names=["block", "at", *fields, "words"],
                )

    asked_x = pairs.select(F.col("block_x").alias("block"), F.struct(F.col("at_x").alias("at")).alias("x"))
    asked_x = asked_x.groupBy("block").agg(F.collect_set("x").alias("asked"))  # as large as the block
    sets = source.join(asked_x, "block").mapInArrow(fetch, "block long, at int, words binary").toDF(*X, "words_x")
    # In parts, where a block has many more pairs than lines.
    parts = pairs.groupBy("block_y").agg(F.ceil(F.count("*") / ASKED_AT_ONCE).alias("parts"))
    part = F.pmod(F.xxhash64(*Y, *X), F.col("parts"))
    asked_y = pairs.join(parts, "block_y").groupBy(F.col("block_y").alias("block"), part).agg(
        F.collect_list(F.struct(F.col("at_y").alias("at"), *X)).alias("asked")
    ).select("block", "asked")
    sent = source.join(asked_y, "block").mapInArrow(fetch, "block long, at int, block_x long, at_x int, words binary")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                p, q = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
                both = np.sort(np.concatenate([p, q]))
                both = int((both[1:] == both[:-1]).sum())
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    wide = sent.toDF(*Y, *X, "words_y").join(sets, list(X)).select(*Y, "words_y", "words_x")
    return materialized(spark, wide.mapInArrow(check, "block_y long, at_y int").distinct(), "line-matches")


def removed_lines(docs: DataFrame, *, threshold: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, rid, removed): the numbers of the lines to remove, per document that has some; a written table.

    ``doc`` is the id, the largest long for null; ``rid`` is the 64-bit hash of the text.
    """
    spark = docs.sparkSession
    percent = round(threshold * 100)
    blocks = line_blocks(docs, key, text)
    size = blocks.agg(F.sum(F.octet_length("tokens"))).first()[0] or 0  # some two bytes a word, a posting per five
    shards = shard_count(spark, size // 10, POSTINGS_PER_SHARD)
    flags = materialized(spark, first_places(blocks, shards), "line-firsts")

    def name(group: pd.DataFrame) -> pd.DataFrame:
        tidied()
        return closest(group, percent)

    answered = blocks.join(answers(dealt(blocks, shards)), "block").join(flags, "block")
    first = postings(answered, shards, percent).groupBy("shard").applyInPandas(
        name, CANDIDATE_SCHEMA
    )
    first = materialized(spark, first, "line-closest")
    named_pairs = first.filter("kept IS NULL")
    best = named_pairs.groupBy(*Y).agg(F.min(F.struct("differ", *X)).alias("best")).select(*Y, "best.block_x", "best.at_x")
    matched = confirmed(best, blocks, percent)
    others = named_pairs.select(*Y, *X).join(matched, list(Y), "left_anti").join(best, [*Y, *X], "left_anti")
    wanted = first.filter("more").join(matched, list(Y), "left_anti").groupBy("shard").agg(
        F.collect_set(F.struct(*Y)).alias("wanted")
    )
    second = first.filter("kept IS NOT NULL").select("shard", "kept").join(
        materialized(spark, wanted, "line-open"), "shard"
    ).mapInPandas(all_candidates(percent), CANDIDATE_SCHEMA)
    second = second.select(*Y, *X).unionByName(others).join(best, [*Y, *X], "left_anti")
    matched = matched.unionByName(confirmed(second, blocks, percent)).groupBy(F.col("block_y").alias("block")).agg(
        F.collect_set("at_y").alias("near")
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc", pa.int64()), ("rid", pa.int64()), ("removed", pa.list_(pa.int32()))])
        for batch in batches:
            for row in batch.to_pylist():
                gone = ~first_lines(row)
                gone[row["near"] or []] = True
                doc, rid, line = (unpack(row[f], t) for f, t in (("doc", "<i8"), ("rid", "<i8"), ("line", "<i4")))
                # Lines stand by document; one begins where the number does not rise or the document changes.
                new = np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(rid) != 0) | (np.diff(line) <= 0)])
                starts = np.flatnonzero(new)
                lists = [x[g].tolist() for x, g in zip(np.split(line, starts[1:]), np.split(gone, starts[1:]), strict=True)]
                full = [k for k, x in enumerate(lists) if x]
                yield pa.RecordBatch.from_pylist(
                    [{"doc": int(doc[starts[k]]), "rid": int(rid[starts[k]]), "removed": lists[k]} for k in full], schema
                )

    needed = blocks.select("block", "doc", "rid", "line", "set_a", "set_b").join(flags, "block").join(matched, "block", "left")
    gone = needed.mapInArrow(remove, "doc long, rid long, removed array<int>")
    gone = materialized(spark, gone.groupBy("doc", "rid").agg(F.max("removed").alias("removed")), "line-removed")
    dropped(blocks)
    return gone


def without_lines(docs: DataFrame, removed: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns, with the removed lines taken out of the text, and ``removed_lines``: their numbers, or null.

    Of rows without id that have the same text, one loses the lines said for it and the others lose all. Texts are dealt
    once, to what is removed from them, and not sorted. The plan is the same at every size: both sides grow alike.
    """

    @F.pandas_udf("string")
    def cut(texts: pd.Series, gone: pd.Series) -> pd.Series:
        def left(t: str | None, numbers) -> str | None:
            if numbers is None or t is None:
                return t
            numbers = set(numbers)
            return "\n".join(line for i, line in enumerate(t.split("\n")) if i not in numbers)

        return pd.Series([left(t, g) for t, g in zip(texts, gone, strict=True)], dtype=object)

    table = removed.toDF("removed_doc", "removed_rid", "removed_lines")
    same = (F.coalesce(F.col(key), F.lit(NO_ID)) == F.col("removed_doc")) & (F.xxhash64(text) == F.col("removed_rid"))
    copies = Window.partitionBy(F.xxhash64(text)).orderBy(F.xxhash64(*docs.columns))
    rows = docs.filter(F.col(key).isNotNull()).withColumn("removed_copy", F.lit(False)).unionByName(
        docs.filter(F.col(key).isNull()).withColumn("removed_copy", F.row_number().over(copies) > 1)
    )
    every = F.filter(F.transform(
        F.split(F.col(text), "\n"), lambda x, i: F.when(F.btrim(x, F.lit(BLANKS)) != "", i)
    ), lambda i: i.isNotNull())
    gone = F.when(F.col("removed_copy") & (F.size(every) > 0), every).otherwise(F.col("removed_lines"))
    return rows.join(table.hint("shuffle_hash"), same, "left").withColumn("removed_lines", gone).drop(
        "removed_doc", "removed_rid", "removed_copy"
    ).withColumn(text, cut(F.col(text), F.col("removed_lines")))


def dedup_lines(docs: DataFrame, *, threshold: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns, with later matching lines taken out of the text, and their numbers in ``removed_lines``."""
    return without_lines(docs, removed_lines(docs, threshold=threshold, key=key, text=text), key=key, text=text)
