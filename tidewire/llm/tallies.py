"""Totals over all blocks, answered block by block.

A block is a bounded run of rows with its sorted different 64-bit keys and their counts. Keys are dealt by hash to
shards; a shard adds up what all blocks have for its keys and answers each block in the order it asked. A key reaches
its shard at most once per block, so frequent keys make no hot shard, and the number of shards follows the data.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove, scratch_path

BLOCK_TOKENS = 1 << 20
SHARD_KEYS = 2 << 20
KEPT: list[Callable] = []  # functions whose lru_cache keeps a large table from task to task
LAST_TIDIED: list[int | None] = []  # the stage in which this worker was tidied last


def tidied() -> None:
    """Gives back what a Python worker holds from earlier stages: large tables of other operators, and free memory.

    Workers outlive their tasks. Called as a task begins, it acts once for each worker and stage.
    """
    context = TaskContext.get()
    stage = context.stageId() if context else None
    if LAST_TIDIED == [stage]:
        return
    LAST_TIDIED[:] = [stage]
    for table in KEPT:
        table.cache_clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim:
        trim(0)


def distinct(values: np.ndarray) -> np.ndarray:
    """The sorted different values; sorting numbers is quicker here than hashing them."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def pack(values: np.ndarray) -> bytes:
    """An array of numbers, compressed with bytes of equal weight side by side."""
    width = values.dtype.itemsize
    planes = np.ascontiguousarray(np.frombuffer(np.ascontiguousarray(values).tobytes(), np.uint8).reshape(-1, width).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes, kind: str) -> np.ndarray:
    dtype = np.dtype(kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(dtype.itemsize, -1)
    return np.frombuffer(np.ascontiguousarray(planes.T).tobytes(), dtype)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit keys, as differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, "<u8"), dtype=np.uint64)


def shard_count(spark: SparkSession, keys: int, per_shard: int = SHARD_KEYS) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-keys // per_shard))


def shard_edges(keys: np.ndarray, shards: int, bits: int = 64) -> np.ndarray:
    """Where each shard's part of sorted keys begins, and the end: shards are equal ranges of the keys of so many bits."""
    cuts = np.array([(i << bits) // shards for i in range(1, shards)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, cuts), [len(keys)]])


def bucketed(df: DataFrame, label: str, key: str) -> DataFrame:
    """The frame as a written table below the shared folder, bucketed so that joins on the key don't move it.

    Only for frames of few large rows: each row may become a file.
    """
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("path", scratch_path(spark, label)).bucketBy(n, key).saveAsTable(name)
    return spark.table(name)


def dropped(table: DataFrame) -> None:
    """Deletes a frame that ``bucketed`` made, once nothing reads it any more."""
    for file in {f.rsplit("/", 1)[0] for f in table.inputFiles()[:1]}:
        remove(table.sparkSession, file)


def dealt(blocks: DataFrame, shards: int) -> DataFrame:
    """(shard, block, keys, counts): the parts of each block's keys. ``blocks``: block, keys, counts (packed int64)."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, keys, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys, counts = unpack_sorted(keys), unpack(counts, "<i8")
                edges = shard_edges(keys, shards)
                full = [s for s in range(shards) if edges[s] < edges[s + 1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(full, pa.int32()), pa.array([block] * len(full), pa.int64()),
                        pa.array([pack_sorted(keys[edges[s] : edges[s + 1]]) for s in full], pa.binary()),
                        pa.array([pack(counts[edges[s] : edges[s + 1]]) for s in full], pa.binary()),
                    ],
                    names=["shard", "block", "keys", "counts"],
                )

    return blocks.select("block", "keys", "counts").mapInArrow(deal, "shard int, block long, keys binary, counts binary")


def summed(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """A shard's different keys, their totals, and each block's places among the keys, in the order of the rows."""
    parts = [unpack_sorted(k) for k in group["keys"]]
    keys, place = np.unique(np.concatenate(parts), return_inverse=True)
    totals = np.bincount(place, np.concatenate([unpack(c, "<i8") for c in group["counts"]]), len(keys)).astype(np.int64)
    return keys, totals, np.split(place, np.cumsum([len(p) for p in parts])[:-1])


def answers(parts: DataFrame) -> DataFrame:
    """(block, totals): for each block the totals of its keys over all blocks, as a list of packed parts by shard."""

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        _, totals, places = summed(group)
        return pd.DataFrame({
            "block": group["block"], "shard": group["shard"], "totals": [pack(totals[p]) for p in places]
        })

    told = parts.groupBy("shard").applyInPandas(answer, "block long, shard int, totals binary")
    return gathered(told, "totals")


def gathered(told: DataFrame, column: str) -> DataFrame:
    """One row per block with the parts of all shards in shard order; as large as the block."""
    return told.groupBy("block").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("shard", column))), lambda x: x[column]).alias(column)
    )
