"""Streams that remember: repeats dropped across batches, windows that close, and compaction of what batches leave.

State is kept in Spark's state store below the checkpoint, survives restarts, and expires by watermark, so that it follows
the rate of arrival and not all that ever arrived.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewire.session import child_names, remove
from tidewire.sources.tables import Manifest, new_load
from tidewire.streaming.incremental import BATCH, run_batches, windowed_counts, write_batch


@dataclass(frozen=True)
class StreamReport:
    """What one pass did: batches, rows read, rows that came after the watermark had passed them, keys or windows held."""

    batches: int
    rows: int
    too_late: int
    held: int


def report(query: StreamingQuery) -> StreamReport:
    query.awaitTermination()
    steps = [p for p in query.recentProgress if p.numInputRows or p.stateOperators]
    operators = [o for p in steps for o in p.stateOperators]
    last = steps[-1].stateOperators if steps else []
    return StreamReport(
        len(steps), sum(p.numInputRows for p in steps), sum(o.numRowsDroppedByWatermark for o in operators),
        sum(o.numRowsTotal for o in last),
    )


def unique_rows(stream: DataFrame, keys: list[str], arrived: str, keep: str) -> DataFrame:
    """The first row of each key; later ones are dropped, in whichever batch they come, for ``keep`` after the first.

    ``arrived`` is the time by which keys are forgotten: best the date under which a file landed, which grows as files
    come in. A key is forgotten when the newest ``arrived`` seen is ``keep`` past its own. Rows that arrive ``keep``
    after the newest are dropped and counted in the report; their load date needs a batch load.
    """
    return stream.withWatermark(arrived, keep).dropDuplicatesWithinWatermark(keys)


def count_unique_windows_once(
    stream: DataFrame, moment: str, by: list[str], keys: list[str], path: str, checkpoint: str, arrived: str,
    keep: str = "7 days", window: str = "1 hour",
) -> StreamReport:
    """Counts per window of rows whose key is new, added to those of earlier runs (``read_windows``).

    Windows go by ``moment``, which may lie as far back as it likes: each batch writes partial counts.
    """
    unique = unique_rows(stream, keys, arrived, keep)
    return report(run_batches(
        unique, lambda batch, number: write_batch(windowed_counts(batch, moment, by, window), number, path), checkpoint
    ))


def close_windows_once(
    stream: DataFrame, moment: str, by: list[str], path: str, checkpoint: str, delay: str = "1 day", window: str = "1 hour",
    keys: list[str] | None = None,
) -> StreamReport:
    """Counts of windows that are complete, each written once, when the newest ``moment`` is ``delay`` past its end.

    Open windows are held in the state store between runs. With ``keys`` repeats are dropped first. Rows more than
    ``delay`` behind the newest are counted in the report and in no window.
    """
    timed = stream.withWatermark(moment, delay)
    rows = timed.dropDuplicatesWithinWatermark(keys) if keys else timed
    counts = windowed_counts(rows, moment, by, window)
    return report(run_batches(counts, lambda batch, number: write_batch(batch, number, path), checkpoint))


def _parts(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in child_names(spark, path) if n.startswith(f"{BATCH}="))


def _base(spark: SparkSession, path: str) -> tuple[int, str | None, int]:
    """Number of the manifest, folder of the compacted counts, and the last batch in it."""
    number, said = Manifest(spark, path).read()
    base = said.get("base")
    return (number, f"{path}/_compacted/{base['folder']}", base["through"]) if base else (number, None, -1)


def compact_windows(spark: SparkSession, path: str, by: list[str]) -> int:
    """Add up the parts of all batches into one and delete them; returns how many went.

    The sum becomes the table when the manifest names it. From then on readers pass over older parts, so a pass that breaks
    off while deleting, or a batch that is run again, changes no count. Not while a stream writes there.
    """
    number, base, through = _base(spark, path)
    parts = [n for n in _parts(spark, path) if n > through]
    if parts:
        folder = new_load(f"{parts[-1]:09d}")
        read_windows(spark, path, by).write.parquet(f"{path}/_compacted/{folder}")
        Manifest(spark, path).publish(number, {"base": {"folder": folder, "through": parts[-1]}})
        if base:
            remove(spark, base)
        through = parts[-1]
    old = [n for n in _parts(spark, path) if n <= through]
    for n in old:
        remove(spark, f"{path}/{BATCH}={n}")
    return len(old)


def read_windows(spark: SparkSession, path: str, by: list[str]) -> DataFrame:
    """Counts per window over the compacted part and all batches since."""
    _, base, through = _base(spark, path)
    folders = [f"{path}/{BATCH}={n}" for n in _parts(spark, path) if n > through] + ([base] if base else [])
    if not folders:
        raise ValueError(f"no counts below {path}")
    parts = spark.read.option("recursiveFileLookup", True).parquet(*folders)
    return parts.groupBy("window_start", "window_end", *by).agg(F.sum("content_count").alias("content_count"))
