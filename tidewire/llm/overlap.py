"""Documents whose n-gram sets are alike, by T-occurrence search over inverted lists.

A set of n shingles can only be alike (Jaccard similarity of ``threshold`` or more) to one that shares T = threshold * n
of them. Documents with equal sets are one class. Shingles are counted over blocks of documents first: a set with fewer
than T shingles that occur in any other set is alike to none, and goes no further.

The others lie in blocks, sorted by their smallest shingle hash, so that copies mostly lie together. A block has an
inverted list per shingle, and a query searches it by DivideSkip: its lists are parted by length, the short ones are
merged by a heap, documents that the merge meets often enough are then looked up in each long list by binary search, and
those that reach the overlap the two sizes ask for are linked. How many lists count as long is chosen per query by the
cost of both steps. Documents already in the query's component are left out of the lists, and one link to each other
component is enough, so a group of copies gives a link per copy and not all pairs.

Documents search their own block first. Then one of each component found there searches the other blocks with which it
shares T shingles (an inverted list per shingle says in which blocks it occurs; shingles in over ``MANY`` blocks count
for every block). Two linked documents that are in different components even then share T shingles, and each of these is
commonest in one component: at least half of them are foreign to one of the two. So of the remaining documents those
search other blocks that have T / 2 shingles which are commonest in another component. No link between two components is
lost, however large a group is, and nothing is capped.

Shingles are 64-bit hashes of the words in order; two different shingles of a pair of documents coincide with a chance
below 1e-9 for documents of 100,000 words. Null texts and blank ones have no shingles and are linked with nothing.
Fewer words than a shingle count as one shingle. Rows with a null id take part; their component is the smallest id
reached, null without one. Repeated rows share their component.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialized
from .graph import components
from .shingles import shingle_sets
from .tallies import (
    BLOCK_TOKENS, answers, bucketed, dealt, dropped, gathered, pack, pack_sorted, shard_count, unpack, unpack_sorted,
)
from .words import bounded

BLOCK_DOCS = 1 << 14
COUNTED = 1 << 19  # shingles of a block that is only counted
MANY = 32
PROBE_COST = 0.05


def needed(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The least overlap with any set that is alike to one of n."""
    return -(-n * percent // 100)


def needed_by_both(n: int, m: np.ndarray | int, percent: int) -> np.ndarray | int:
    return -(-(n + m) * percent // (100 + percent))


class Lists:
    """Inverted lists of a block: for each shingle, the ascending numbers of the sets that have it."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(flat, kind="stable")
        flat, self.owner = flat[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.empty(0, np.int64)
        self.keys, self.starts = flat[first], np.append(first, len(flat))

    def of(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the lists of these shingles begin and end, without those that the block lacks."""
        at = np.searchsorted(self.keys, shingles)
        at = at[at < len(self.keys)] if not len(self.keys) else np.minimum(at, len(self.keys) - 1)
        at = at[self.keys[at] == shingles] if len(at) else at
        return self.starts[at], self.starts[at + 1]


def divide_skip(lists: Lists, shingles: np.ndarray, percent: int, group: np.ndarray, own: int) -> np.ndarray:
    """Sets of the block that are alike to a query of these shingles, but none whose group is ``own``."""
    n, (start, end) = len(shingles), lists.of(shingles)
    least = needed(n, percent)
    if len(start) < least:
        return np.empty(0, np.int64)
    order = np.argsort(end - start, kind="stable")
    start, end = start[order], end[order]
    upto = np.cumsum(end - start)
    skipped = np.arange(least)  # of so many lists at most: a set must still meet one of those merged
    merged = upto[len(start) - 1 - skipped]
    long = int(np.argmin(merged * (1 + PROBE_COST * skipped / (least - skipped))))
    short = len(start) - long

    runs = []
    for a, z in zip(start[:short], end[:short], strict=True):
        run = lists.owner[a:z]
        run = run[group[run] != own]
        if len(run):
            runs.append(run.tolist())
    found, times, last, count = [], [], -1, 0
    for x in heapq.merge(*runs):
        if x == last:
            count += 1
            continue
        if count >= least - long:
            found.append(last)
            times.append(count)
        last, count = x, 1
    if count >= least - long:
        found.append(last)
        times.append(count)
    found, times = np.array(found, np.int64), np.array(times, np.int64)

    size = lists.sizes[found]
    fits = 100 * np.minimum(size, n) >= percent * np.maximum(size, n)
    found, times = found[fits], times[fits]
    for k, (a, z) in enumerate(zip(start[short:], end[short:], strict=True)):
        if not len(found):
            break
        run = lists.owner[a:z]
        at = np.minimum(np.searchsorted(run, found), len(run) - 1)
        times = times + (run[at] == found)
        if k % 16 == 15:  # those that can't reach it any more
            can = times + (long - 1 - k) >= needed_by_both(n, lists.sizes[found], percent)
            found, times = found[can], times[can]
    return found[times >= needed_by_both(n, lists.sizes[found], percent)]


def local_components(lists: Lists, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set of the block, the number of the set that stands for its component within the block.

    Sets whose shingles are common in the block come first and stand for their components.
    """
    group = np.arange(len(sets))
    again = np.diff(lists.starts) > 1
    common = np.zeros(len(sets))
    several = np.zeros(len(sets), np.int64)
    if len(lists.keys):
        length = np.repeat(np.diff(lists.starts), np.diff(lists.starts))
        common = np.bincount(lists.owner, length, len(sets)) / np.maximum(lists.sizes, 1)
        several = np.bincount(lists.owner, np.repeat(again, np.diff(lists.starts)), len(sets)).astype(np.int64)
    rank = np.empty(len(sets), np.int64)
    rank[np.argsort(-common, kind="stable")] = np.arange(len(sets))
    for q in np.argsort(rank):
        if several[q] < needed(len(sets[q]), percent):
            continue
        for other in divide_skip(lists, sets[q], percent, group, group[q]):
            a, b = group[q], group[other]
            if a != b:
                a, b = (a, b) if rank[a] < rank[b] else (b, a)
                group[group == b] = a
    return group


def split(flat: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    return np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else []


def shingled(docs: DataFrame, size: int, percent: int, key: str, text: str) -> DataFrame:
    """(id, n, digest, least, shingles) per row, a written table; the smallest shingle and all of them are null where
    nothing else can be alike."""
    spark = docs.sparkSession
    key_type = docs.schema[key].dataType.simpleString()
    binary = ("ids", "sizes", "digests", "keys", "counts", "places")
    schema = pa.schema([("block", pa.int64()), *((c, pa.binary()) for c in binary)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, ids, sets, total = 0, [], [], 0

        def done() -> pa.RecordBatch:
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            keys, place = np.unique(np.concatenate(sets), return_inverse=True)
            different = dict(zip(digests, range(len(sets)), strict=True)).values()  # equal sets count once
            parts = split(place, np.array([len(s) for s in sets]))
            counts = np.bincount(np.concatenate([parts[i] for i in different]), minlength=len(keys))
            row = {
                "block": (TaskContext.get().partitionId() << 32) + made, "ids": json.dumps(ids).encode(),
                "sizes": pack(np.array([len(s) for s in sets], "<i4")), "digests": b"".join(digests),
                "keys": pack_sorted(keys), "counts": pack(counts.astype("<i8")), "places": pack(place.astype("<i4")),
            }
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            said = batch.column(0).cast(pa.string()).to_pylist()
            for own, shingles in zip(said, shingle_sets(batch.column(1).to_pylist(), size), strict=True):
                ids.append(own)
                sets.append(shingles)
                total += len(shingles) + 1
                if total >= COUNTED:
                    yield done()
                    made, ids, sets, total = made + 1, [], [], 0
        if ids:
            yield done()

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, place, sizes = unpack_sorted(row["keys"]), unpack(row["places"], "<i4"), unpack(row["sizes"], "<i4")
                told = [unpack(t, "<i8") for t in row["totals"] or []]
                again = np.concatenate(told) > 1 if told else np.empty(0, bool)
                digests = [row["digests"][i : i + 16] for i in range(0, len(row["digests"]), 16)]
                kept, least = [], []
                for own in split(place, sizes):
                    n = len(own)
                    alive = 100 * n >= percent * (n + 1) and again[own].sum() >= needed(n, percent)  # smaller sets have equals only
                    kept.append(pack_sorted(keys[own]) if alive else None)
                    least.append(int(keys[own[0]].astype(np.int64)) if alive else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(json.loads(row["ids"]), pa.string()), pa.array(sizes.astype(np.int64)),
                        pa.array([d if n else None for d, n in zip(digests, sizes, strict=True)], pa.binary()),
                        pa.array(least, pa.int64()), pa.array(kept, pa.binary()),
                    ],
                    names=["id", "n", "digest", "least", "shingles"],
                )

    fields = "block long, " + ", ".join(f"{c} binary" for c in binary)
    blocks = bucketed(docs.select(F.col(key), F.col(text).alias("text")).mapInArrow(read, fields), "overlap_blocks", "block")
    weight = blocks.agg(F.sum(F.octet_length("keys"))).first()[0] or 0
    totals = answers(dealt(blocks, shard_count(spark, weight // 6)))
    own = blocks.drop("counts").join(totals, "block", "left").mapInArrow(sift, "id string, n long, digest binary, least long, shingles binary")
    own = materialized(spark, own.withColumn("id", F.col("id").cast(key_type)), "overlap-sets")
    dropped(blocks)
    return own


INDEX = ("sizes", "shingles", "digests", "keys", "counts", "groups")


def index_blocks(classes: DataFrame, percent: int) -> DataFrame:
    """Blocks of classes (digest, n, shingles) that lie together by their smallest shingle, with the components found
    within each block. A class is known as ``vid``, the block's number shifted by 22 bits and its place in the block."""
    schema = pa.schema([("block", pa.int64()), *((c, pa.binary()) for c in INDEX)])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, digests, sets, total = 0, [], [], 0

        def done() -> pa.RecordBatch:
            lists = Lists(sets)
            row = {
                "block": (TaskContext.get().partitionId() << 20) + made, "sizes": pack(lists.sizes.astype("<i4")),
                "shingles": pack(np.concatenate(sets)), "digests": b"".join(digests), "keys": pack_sorted(lists.keys),
                "counts": pack(np.ones(len(lists.keys), "<i8")),
                "groups": pack(local_components(lists, sets, percent).astype("<i4")),
            }
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for digest, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                digests.append(digest)
                sets.append(unpack_sorted(blob))
                total += len(sets[-1])
                if total >= BLOCK_TOKENS or len(sets) >= BLOCK_DOCS:
                    yield done()
                    made, digests, sets, total = made + 1, [], [], 0
        if sets:
            yield done()

    spark = classes.sparkSession
    weight = classes.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-weight // BLOCK_TOKENS))
    laid = classes.select("digest", "shingles", "least").repartitionByRange(parts, "least", "digest")
    laid = laid.sortWithinPartitions("least", "digest").select("digest", "shingles")
    return bucketed(laid.mapInArrow(build, "block long, " + ", ".join(f"{c} binary" for c in INDEX)), "overlap_index", "block")


def places(parts: DataFrame) -> DataFrame:
    """(block, elsewhere): for each key of a block, in order, the number of other blocks that have it, -1 if these are
    over ``MANY``, and their numbers; a list of parts by shard."""

    def tell(group: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_sorted(k) for k in group["keys"]]
        owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        flat = np.concatenate(keys)
        order = np.argsort(flat, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], flat[order][1:] != flat[order][:-1]]))
        length = np.diff(np.append(first, len(flat)))
        run = np.empty(len(flat), np.int64)  # the number of each posting's list
        run[order] = np.repeat(np.arange(len(first)), length)
        numbers = group["block"].to_numpy()
        rows = []
        for k, own in enumerate(split(run, np.array([len(x) for x in keys]))):
            n = length[own] - 1
            counts = np.where(n > MANY, -1, n)
            few = own[(n > 0) & (n <= MANY)]
            size = length[few]
            at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first[few], size)
            others = owner[order[at]]
            rows.append((numbers[k], group["shard"].iloc[0], pack(counts.astype("<i4")), pack(numbers[others[others != k]].astype("<i8"))))
        return pd.DataFrame(rows, columns=["block", "shard", "counts", "blocks"])

    told = parts.groupBy("shard").applyInPandas(tell, "block long, shard int, counts binary, blocks binary")
    return gathered(told.select("block", "shard", F.struct("counts", "blocks").alias("elsewhere")), "elsewhere")


def homes(parts: DataFrame) -> DataFrame:
    """(block, homes): for each key of a block, the component that is commonest for it in most blocks; parts by shard.

    ``counts`` of the parts has the component that is commonest for a key within its block.
    """

    def tell(group: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_sorted(k) for k in group["keys"]]
        flat, said = np.concatenate(keys), np.concatenate([unpack(c, "<i8") for c in group["counts"]])
        order = np.lexsort((said, flat))
        key, root = flat[order], said[order]
        new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (root[1:] != root[:-1])]))
        votes = np.diff(np.append(new, len(flat)))
        best = np.lexsort((root[new], -votes, key[new]))
        key, root = key[new][best], root[new][best]
        top = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        home = root[top][np.searchsorted(key[top], flat)]
        sizes = np.array([len(k) for k in keys])
        return pd.DataFrame({"block": group["block"], "shard": group["shard"], "homes": [pack(h) for h in split(home, sizes)]})

    return gathered(parts.groupBy("shard").applyInPandas(tell, "block long, shard int, homes binary"), "homes")


QUERY = "target long, vids binary, groups binary, sizes binary, shingles binary"


def routed(blocks: DataFrame, percent: int, everywhere: list[int], away: bool) -> DataFrame:
    """(target, vids, groups, sizes, shingles): queries of each block for each other block in which they may find a
    partner. ``blocks`` has ``elsewhere``; with ``away`` also ``roots`` and ``homes``, else one set per local component
    asks. ``everywhere`` has the numbers of all blocks, for queries whose shingles are in too many to be listed."""
    schema = pa.schema([("target", pa.int64()), *((c, pa.binary()) for c in ("vids", "groups", "sizes", "shingles"))])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = unpack(row["sizes"], "<i4").astype(np.int64)
                sets, keys = split(unpack(row["shingles"], "<u8"), sizes), unpack_sorted(row["keys"])
                counts = np.concatenate([unpack(p["counts"], "<i4") for p in row["elsewhere"]])
                blocks = np.concatenate([unpack(p["blocks"], "<i8") for p in row["elsewhere"]])
                upto = np.concatenate([[0], np.cumsum(np.maximum(counts, 0))])
                local = unpack(row["groups"], "<i4").astype(np.int64)
                first_vid = row["block"] << 22
                roots = unpack(row["roots"], "<i8") if away else local + first_vid
                home = np.concatenate([unpack(h, "<i8") for h in row["homes"]]) if away else None
                wanted: dict[int, list[int]] = {}
                for i, shingles in enumerate(sets):
                    if away == (local[i] == i):
                        continue
                    least, at = needed(len(shingles), percent), np.searchsorted(keys, shingles)
                    if away and 2 * (home[at] != roots[i]).sum() < least:
                        continue
                    many = int((counts[at] < 0).sum())
                    if many >= least:
                        targets = [b for b in everywhere if b != row["block"]]
                    else:
                        n = np.maximum(counts[at], 0)
                        if (n > 0).sum() + many < least:
                            continue
                        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(upto[at], n)
                        other, times = np.unique(blocks[place], return_counts=True)
                        targets = other[times + many >= least].tolist()
                    for target in targets:
                        wanted.setdefault(target, []).append(i)
                for target, numbers in wanted.items():
                    yield pa.RecordBatch.from_pylist([{
                        "target": target, "vids": pack((first_vid + np.array(numbers)).astype("<i8")),
                        "groups": pack(roots[numbers].astype("<i8")), "sizes": pack(sizes[numbers].astype("<i4")),
                        "shingles": pack(np.concatenate([sets[i] for i in numbers])),
                    }], schema)

    return blocks.mapInArrow(route, QUERY)


def searched(queries: DataFrame, blocks: DataFrame, percent: int, rooted: bool) -> DataFrame:
    """(a, b): a link of each query to every other component of its target block that has a set alike to it.

    A block comes first in its task, and its queries pass by one after another.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, groups, first_vid = None, None, 0
        for batch in batches:
            for row in batch.to_pylist():
                sets = split(unpack(row["shingles"], "<u8"), unpack(row["sizes"], "<i4"))
                if row["vids"] is None:
                    lists, first_vid = Lists(sets), row["block"] << 22
                    groups = unpack(row["groups"], "<i8") if rooted else unpack(row["groups"], "<i4") + np.int64(first_vid)
                    continue
                a, b = [], []
                for vid, own, shingles in zip(unpack(row["vids"], "<i8"), unpack(row["groups"], "<i8"), sets, strict=True):
                    found = divide_skip(lists, shingles, percent, groups, own)
                    _, one = np.unique(groups[found], return_index=True)
                    a += [int(vid)] * len(one)
                    b += (found[one] + first_vid).tolist()
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    index = blocks.select(
        "block", F.lit(None).cast("binary").alias("vids"), F.col("roots" if rooted else "groups").alias("groups"), "sizes", "shingles"
    )
    rows = index.unionByName(queries.withColumnRenamed("target", "block")).repartition("block")
    rows = rows.sortWithinPartitions("block", F.col("vids").isNotNull())
    return materialized(queries.sparkSession, rows.mapInArrow(search, "a long, b long"), "overlap-links")


def local_links(blocks: DataFrame) -> DataFrame:
    """(a, b): each class with the one that stands for its component within its block."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                group, first_vid = unpack(row["groups"], "<i4").astype(np.int64), row["block"] << 22
                member = np.flatnonzero(group != np.arange(len(group)))
                yield pa.RecordBatch.from_arrays([pa.array(group[member] + first_vid), pa.array(member + first_vid)], names=["a", "b"])

    return materialized(blocks.sparkSession, blocks.select("block", "groups").mapInArrow(tell, "a long, b long"), "overlap-links")


def with_roots(blocks: DataFrame, reached: DataFrame) -> DataFrame:
    """Blocks with the component of each class, and each key's commonest component in the block as ``counts``."""
    fields = "block long, roots binary, counts binary"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = unpack(row["sizes"], "<i4")
                roots = np.arange(len(sizes), dtype=np.int64) + (row["block"] << 22)
                for part in row["reached"] or []:
                    roots[part["id"] - (row["block"] << 22)] = part["root"]
                owner = np.repeat(np.arange(len(sizes)), sizes)
                key, root = unpack(row["shingles"], "<u8"), roots[owner]
                order = np.lexsort((root, key))
                key, root = key[order], root[order]
                new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (root[1:] != root[:-1])]))
                votes = np.diff(np.append(new, len(key)))
                best = np.lexsort((-votes, key[new]))
                top = np.flatnonzero(np.concatenate([[True], np.diff(key[new][best]) != 0]))
                yield pa.RecordBatch.from_pylist([{
                    "block": row["block"], "roots": pack(roots), "counts": pack(root[new][best][top].astype("<i8")),
                }])

    lists = reached.withColumn("block", F.shiftright("id", 22)).groupBy("block").agg(F.collect_list(F.struct("id", "root")).alias("reached"))
    placed = blocks.select("block", "sizes", "shingles").join(lists, "block", "left").mapInArrow(place, fields)
    return materialized(blocks.sparkSession, placed, "overlap-roots")


def grouped(classes: DataFrame, percent: int) -> DataFrame:
    """(digest, root) of the classes (digest, n, shingles, least) that are linked with others, a written table.

    ``shingles`` are packed, sorted and different; ``least`` is the smallest of them; root is the same within a component.
    """
    spark = classes.sparkSession
    blocks = index_blocks(classes, percent)
    numbers = [r[0] for r in blocks.select("block").collect()]  # one number per block of a million shingles
    shards = shard_count(spark, blocks.agg(F.sum(F.octet_length("keys"))).first()[0] or 0, 1 << 23)

    elsewhere = materialized(spark, places(dealt(blocks, shards)), "overlap-places")
    placed = blocks.join(elsewhere, "block")
    links = local_links(blocks).unionByName(searched(routed(placed, percent, numbers, False), blocks, percent, False))
    reached = components(links)
    rooted = with_roots(blocks, reached)
    known = homes(dealt(blocks.drop("counts").join(rooted.select("block", "counts"), "block"), shards))
    asking = placed.join(rooted.select("block", "roots"), "block").join(known, "block")
    more = searched(routed(asking, percent, numbers, True), blocks.join(rooted.select("block", "roots"), "block"), percent, True)
    if not more.isEmpty():
        reached = components(links.unionByName(more))

    vids = blocks.select("block", F.posexplode(F.expr(
        "transform(sequence(0, int(octet_length(digests) / 16) - 1), i -> substring(digests, 16 * i + 1, 16))"
    )).alias("at", "digest")).select((F.shiftleft("block", 22) + F.col("at")).alias("vid"), "digest")
    tree = materialized(spark, vids.join(reached.withColumnRenamed("id", "vid"), "vid").select("digest", "root"), "overlap-tree")
    dropped(blocks)
    return tree


def similarity_classes(
    docs: DataFrame, *, size: int = 5, threshold: float = 0.8, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n_shingles, component_id) per row: documents are linked if their shingle sets have a Jaccard similarity of
    ``threshold`` (hundredths) or more; component_id is the smallest id that can be reached."""
    spark = docs.sparkSession
    percent = round(threshold * 100)
    own = shingled(docs, size, percent, key, text)
    classes = own.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.max("least").alias("least"),
        F.first("shingles", ignorenulls=True).alias("shingles"),
    )
    classes = materialized(spark, classes, "overlap-classes")
    tree = grouped(classes.filter("shingles IS NOT NULL"), percent).join(classes.select("digest", "id"), "digest")
    tree = materialized(spark, tree, "overlap-tree")
    linked = tree.join(tree.groupBy("root").agg(F.min("id").alias("smallest")), "root").select("digest", "smallest")
    smallest = classes.select("digest", "id").join(linked, "digest", "left").select(
        "digest", F.coalesce("smallest", "id").alias("smallest")
    )
    return own.select("id", "n", "digest").join(bounded(materialized(spark, smallest, "overlap-smallest")), "digest", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("smallest", "id").alias("component_id")
    )
