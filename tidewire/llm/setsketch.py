"""Near-duplicate documents by SetSketch.

A sketch has 128 registers. Each shingle sends a row of points with exponential spacing to registers drawn by hash; a
register keeps its smallest point x as floor(1 - log_b x), cut to 16 bits, so that sketches of two sets merge into that
of their union by the larger register. A set's points end as soon as none can change a register. Registers of two sets
agree with a probability close to their Jaccard similarity: 32 bands of four registers each collect candidates (a pair
at 0.8 is missed by all bands with a probability under 1e-7), the joint likelihood of larger, smaller and equal
registers estimates their similarity, and pairs estimated within 0.2 of the threshold are verified on their full sets.

Documents with equal sets are one class from the start. In a bucket each class is first compared with one other only.
For buckets that are then still apart in components, the shingles that a class shares with any other such class are
counted: no overlap can exceed them. Each class is compared with the one that shares most of its set; what is apart even
then, and shares enough of its set, is searched by the inverted lists of ``overlap`` on the full sets, which gives a link
per component and not per pair. So every pair that shares a bucket is in one component, or tested, or impossible, and no
step makes all pairs of a large group of noisy copies. Nothing is capped.

Empty and blank texts and null texts have no shingles and are linked with nothing. Fewer words than a shingle count as
one shingle. Rows with a null id are kept and have no component. Repeated rows share their component; rows that have the
same id as their component are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialized
from . import overlap
from .graph import components
from .shingles import mixed, shingle_sets
from .tallies import BLOCK_TOKENS, answers, bucketed, dealt, pack, pack_sorted, shard_count, tidied, unpack
from .words import bounded

REGISTERS, BAND = 128, 4
BANDS = REGISTERS // BAND
BASE, RATE, TOP = 1.001, 20.0, 65535
MARGIN = 0.2


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Registers of each set, one row of 16-bit integers per set."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    seed = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    least = np.full((len(sets), REGISTERS), np.inf)
    flat, point, step = least.ravel(), np.zeros(len(seed)), 0
    while len(seed):
        step += 1
        bits = mixed(seed + np.uint64((step * 0x9E3779B97F4A7C15) & ((1 << 64) - 1)))
        point = point - np.log(((bits >> np.uint64(11)) + np.uint64(1)) * 2.0**-53) / (RATE * REGISTERS)
        register = (mixed(bits) >> np.uint64(57)).astype(np.int64)
        np.minimum.at(flat, owner * REGISTERS + register, point)
        live = point < least.max(axis=1)[owner]
        seed, owner, point = seed[live], owner[live], point[live]
    with np.errstate(divide="ignore"):
        return np.clip(np.floor(1 - np.log(least) / np.log(BASE)), 0, TOP).astype("<u2")


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def joint_estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The Jaccard similarity that makes the registers of each pair most likely, given the set sizes."""
    over, under = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - over - under
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        more, less = np.maximum(chance(u - v * j), 1e-12), np.maximum(chance(v - u * j), 1e-12)
        return over * np.log(more) + under * np.log(less) + same * np.log(np.maximum(1 - more - less, 1e-12))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):  # the likelihood has one maximum
        left, right = low + (high - low) / 3, high - (high - low) / 3
        rises = likelihood(left) < likelihood(right)
        low, high = np.where(rises, left, low), np.where(rises, high, right)
    return (low + high) / 2


def sketch_table(docs: DataFrame, size: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n, digest, registers) per row, a written table; digest and registers are null for empty sets."""
    key_type = docs.schema[key].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidied()
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist(), size)
            rows = sketches(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([r.tobytes() if len(s) else None for s, r in zip(sets, rows, strict=True)], pa.binary()),
                ],
                names=[key, "n", "digest", "registers"],
            )

    table = docs.select(key, F.col(text).alias("text")).mapInArrow(
        sketch, f"{key} {key_type}, n long, digest binary, registers binary"
    )
    return materialized(docs.sparkSession, table, "sketches")


def exact_sets(text: str | None, size: int) -> frozenset[tuple[bytes, ...]]:
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*[words[k:] for k in range(size)], strict=False))


def estimated(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) that the joint estimate leaves as candidates, a written table."""
    own = classes.select("vid", "n", "registers")

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n_a, n_b, a, b = (batch.column(i) for i in range(2, 6))
            registers = [np.frombuffer(b"".join(x.to_pylist()), "<u2").reshape(-1, REGISTERS) for x in (a, b)]
            near = joint_estimate(*registers, np.asarray(n_a, float), np.asarray(n_b, float)) >= threshold - MARGIN
            yield batch.select([0, 1]).filter(pa.array(near))

    wide = pairs.join(own.toDF("a", "n_a", "registers_a"), "a").join(own.toDF("b", "n_b", "registers_b"), "b").select(
        "a", "b", "n_a", "n_b", "registers_a", "registers_b"
    )
    return materialized(pairs.sparkSession, wide.mapInArrow(estimate, "a long, b long"), "near-estimated")


def texts_of(vids: DataFrame, docs: DataFrame, classes: DataFrame, size: int, key: str, text: str) -> DataFrame:
    """(vid, text): a text of each of these classes, a written table."""
    spark = vids.sparkSession
    needed = vids.select("vid").distinct().join(classes.select("vid", F.col("id").alias(key), "digest"), "vid")
    needed = bounded(materialized(spark, needed, "near-needed"))
    fetched = docs.select(key, F.col(text).alias("text")).join(needed, key).select("vid", "digest", "text")

    def with_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # an id may belong to several texts: only that of the class counts
            sets = shingle_sets(batch.column(2).to_pylist(), size)
            said = batch.column(1).to_pylist()
            right = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() == d for s, d in zip(sets, said, strict=True)]
            yield batch.select([0, 2]).filter(pa.array(right, pa.bool_()))

    return materialized(spark, fetched.mapInArrow(with_digest, "vid long, text string").dropDuplicates(["vid"]), "near-texts")


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, size: int, threshold: float, key: str, text: str) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold, a written table."""
    spark = pairs.sparkSession
    percent = round(threshold * 100)
    texts = texts_of(pairs.select(F.explode(F.array("a", "b")).alias("vid")), docs, classes, size, key, text)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lru_cache(maxsize=64)(lambda x: exact_sets(x, size))
        for batch in batches:
            near = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = known(x.as_py()), known(y.as_py())
                both = len(p & q)
                near.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select([0, 1]).filter(pa.array(near, pa.bool_()))

    wide = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b").select("a", "b", "text_a", "text_b")
    return materialized(spark, wide.mapInArrow(verify, "a long, b long"), "near-links")


def shared_shingles(texts: DataFrame, size: int) -> DataFrame:
    """(vid, shared): how many shingles of each text occur in any of the others, a written table."""
    spark = texts.sparkSession
    fields = ("keys", "counts", "places", "sizes", "vids")
    schema = pa.schema([("block", pa.int64()), *((f, pa.binary()) for f in fields)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, vids, sets, total = 0, [], [], 0

        def done() -> pa.RecordBatch:
            keys, place = np.unique(np.concatenate(sets), return_inverse=True)
            row = {
                "block": (TaskContext.get().partitionId() << 32) + made, "keys": pack_sorted(keys),
                "counts": pack(np.bincount(place, minlength=len(keys)).astype("<i8")), "places": pack(place.astype("<i4")),
                "sizes": pack(np.array([len(s) for s in sets], "<i4")), "vids": pack(np.array(vids, "<i8")),
            }
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for vid, own in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1).to_pylist(), size), strict=True):
                vids.append(vid)
                sets.append(own)
                total += len(own)
                if total >= BLOCK_TOKENS:
                    yield done()
                    made, vids, sets, total = made + 1, [], [], 0
        if vids:
            yield done()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                again = np.concatenate([unpack(t, "<i8") for t in row["totals"]]) > 1
                sizes = unpack(row["sizes"], "<i4")
                shared = np.add.reduceat(again[unpack(row["places"], "<i4")].astype(np.int64), np.cumsum(sizes) - sizes)
                yield pa.RecordBatch.from_arrays([pa.array(unpack(row["vids"], "<i8")), pa.array(shared)], names=["vid", "shared"])

    blocks = bucketed(texts.mapInArrow(read, "block long, " + ", ".join(f"{f} binary" for f in fields)), "near_blocks", "block")
    size_of = blocks.agg(F.sum(F.octet_length("keys"))).first()[0] or 0
    totals = answers(dealt(blocks, shard_count(spark, size_of // 6)))
    return materialized(spark, blocks.join(totals, "block").mapInArrow(count, "vid long, shared long"), "near-shared")


def packed_sets(size: int):
    """A function for mapInArrow over (vid, text): the shingles of each text and the smallest of them."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist(), size)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([pack_sorted(s) for s in sets], pa.binary()),
                    pa.array([int(s[0].astype(np.int64)) for s in sets], pa.int64()),
                ],
                names=["vid", "shingles", "least"],
            )

    return read


def near_duplicates(
    docs: DataFrame, *, size: int = 5, threshold: float = 0.8, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n_shingles, component_id, kept) per row.

    Documents are linked if their shingle sets have a Jaccard similarity of ``threshold`` (hundredths) or more;
    component_id is the smallest id that can be reached, and the document with that id is kept.
    """
    spark = docs.sparkSession
    percent = round(threshold * 100)
    own = sketch_table(docs, size, key, text)
    classes = materialized(
        spark,
        own.filter(F.col(key).isNotNull() & F.col("digest").isNotNull()).groupBy("digest").agg(
            F.min(key).alias("id"), F.first("n").alias("n"), F.first("registers").alias("registers")
        ).withColumn("vid", F.monotonically_increasing_id()),
        "near-classes",
    )
    band = F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.substring("registers", 2 * BAND * i + 1, F.lit(2 * BAND))),
    ))
    bucket = Window.partitionBy("bucket")
    members = classes.select("vid", "n", band.alias("bucket")).withColumn("first", F.min(F.struct("vid", "n")).over(bucket))
    members = members.withColumn("others", F.count("*").over(bucket) - 1).filter("others > 0")
    members = materialized(spark, members.select("bucket", "vid", "n", "first", "others"), "near-buckets")
    alike = lambda x, y: (100 * F.least(x, y) >= percent * F.greatest(x, y))

    def confirmed(pairs: DataFrame) -> DataFrame:
        return verified(estimated(pairs, classes, threshold), docs, classes, size, threshold, key, text)

    def still_apart(members: DataFrame, reached: DataFrame) -> DataFrame:
        """Members of buckets that are in several components, with their component."""
        placed = members.join(bounded(reached.select(F.col("id").alias("vid"), "root")), "vid", "left").withColumn(
            "root", F.coalesce("root", "vid")
        )
        split = placed.withColumn("low", F.min("root").over(bucket)).withColumn("high", F.max("root").over(bucket))
        return materialized(spark, split.filter("low != high").drop("low", "high"), "near-apart")

    star = members.filter(alike(F.col("n"), F.col("first.n"))).select(F.col("first.vid").alias("a"), F.col("vid").alias("b"))
    star = materialized(spark, star.filter("a < b").distinct(), "near-star")
    links = confirmed(star)
    reached = components(links)

    # Two members have been compared. Of larger buckets, those that are still in several components go on.
    apart = still_apart(members.filter("others > 1").drop("first", "others"), reached)
    texts = texts_of(apart, docs, classes, size, key, text)
    apart = materialized(spark, apart.join(shared_shingles(texts, size), "vid"), "near-apart")
    possible = lambda x, y: (
        alike(x("n"), y("n")) & (F.least(x("shared"), y("shared")) * (100 + percent) >= percent * (x("n") + y("n")))
    )
    hub = F.max(F.struct((F.col("shared") / F.col("n")).alias("share"), "vid", "n", "shared", "root")).over(bucket)
    centre = apart.withColumn("hub", hub).filter("hub.root != root").filter(possible(F.col, lambda c: F.col(f"hub.{c}")))
    centre = centre.select(F.least("vid", "hub.vid").alias("a"), F.greatest("vid", "hub.vid").alias("b")).distinct()
    tested = materialized(spark, centre.join(star, ["a", "b"], "left_anti"), "near-centre")
    links = links.unionByName(confirmed(tested))
    reached = components(links)

    apart = still_apart(apart.drop("root"), reached)
    asking = bounded(materialized(spark, apart.filter(100 * F.col("shared") >= percent * F.col("n")).select("vid").distinct(), "near-rest"))
    sets = texts.join(asking, "vid").mapInArrow(packed_sets(size), "vid long, shingles binary, least long")
    sets = materialized(spark, sets.join(classes.select("vid", "digest", "n"), "vid"), "near-sets")
    found = overlap.grouped(sets, percent).join(sets.select("vid", "digest"), "digest").select("vid", F.col("root").alias("found"))
    more = found.groupBy("found").agg(F.min("vid").alias("a")).join(found.withColumnRenamed("vid", "b"), "found")
    more = materialized(spark, more.filter("a != b").select("a", "b"), "near-links")
    if not more.isEmpty():
        reached = components(links.unionByName(more))
    reached = materialized(spark, reached, "near-reached")

    tree = classes.select("vid", "digest", F.col("id").alias("own_id")).join(
        reached.withColumnRenamed("id", "vid"), "vid", "left"
    ).withColumn("root", F.coalesce("root", "vid"))
    named = tree.groupBy("root").agg(F.min("own_id").alias("smallest"))
    smallest = materialized(spark, tree.join(named, "root").select("digest", "smallest"), "near-components")
    component = F.when(F.col(key).isNotNull(), F.coalesce("smallest", F.col(key)))
    return own.select(key, "n", "digest").join(smallest, "digest", "left").select(
        key, F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col(key) == component, F.lit(True)).alias("kept"),
    )
