"""Incremental runs over append-only folders with Structured Streaming.

The same validation and enrichment as in the batch jobs, started when wanted and stopped when
all new files are read (``availableNow``). One stream covers all types, so that a type may appear later. Each batch is
written to a folder of its own number, which a repeated batch replaces: a restart neither loses nor repeats rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewire.fixed_values import CONTENT_TYPES, ENTITY_NAMES, TOPIC_KEYWORDS
from tidewire.functions.measures import record_hash
from tidewire.functions.text import TopicWords
from tidewire.operators.content import enrich, with_lineage, with_parsed_times
from tidewire.operators.validate import REASON, silver_reason, to_quarantine
from tidewire.schemas import CORRUPT, LINE, SILVER_COLUMNS
from tidewire.session import remove
from tidewire.sources.bronze import parsed_lines
from tidewire.sources.tables import CoreTable

BATCH = "batch_id"


def stream_content(
    spark: SparkSession, root: str, content_types: list[str] = CONTENT_TYPES, max_files: int = 1000
) -> DataFrame:
    """New records of all types as they land below ``{root}/{type}/ingest_date=...``.

    Type and date come from the file's path; folders need not be there yet.
    """
    lines = (
        spark.readStream.option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files)
        .text(f"{root}/{{{','.join(content_types)}}}")
    )
    place = r"/([^/]+)/ingest_date=([^/]+)/[^/]+$"
    path = F.col("_metadata.file_path")
    return parsed_lines(lines.select(
        "value",
        F.to_date(F.regexp_extract(path, place, 2)).alias("ingest_date"),
        F.regexp_extract(path, place, 1).alias("content_type"),
    ))


def checked(records: DataFrame) -> DataFrame:
    return records.withColumn(REASON, silver_reason(CORRUPT))


def enriched_rows(
    valid: DataFrame, run_id: str, topics: TopicWords = TOPIC_KEYWORDS, entities: TopicWords = ENTITY_NAMES
) -> DataFrame:
    """Valid bronze rows to gold rows. Duplicates are settled by the core merge that follows."""
    parsed = with_parsed_times(valid)
    silver = with_lineage(parsed).withColumn("record_hash", record_hash(parsed))
    silver = silver.withColumn("news_site_validated", F.lit(None).cast("boolean")).select(*SILVER_COLUMNS)
    return enrich(silver, run_id, topics=topics, entities=entities)


def write_batch(df: DataFrame, batch: int, path: str, partition_by: list[str] | None = None) -> None:
    """A batch's rows as the folder of its number."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("partitionOverwriteMode", "static").parquet(f"{path}/{BATCH}={batch}")


def run_batches(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Read everything that is new in batches, hand each to ``each``, stop."""
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def core_merge(core: CoreTable, gold: str, batch_of: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, list[str]], None]:
    """A history merge for ``ingest_once``: the load dates that a batch touched are loaded again from all their gold rows."""

    def merge(spark: SparkSession, dates: list[str]) -> None:
        def of(day: str) -> tuple[DataFrame, str]:
            rows = spark.read.parquet(gold).where(F.col("ingest_date") == F.lit(day).cast("date"))
            return batch_of(rows), f"{day} 00:00:00"

        for day in sorted(dates):
            batch, now = of(day)
            core.load(batch, day, now, latest_by="updated_at", replay=of)

    return merge


def ingest_once(
    spark: SparkSession, root: str, out: str, run_id: str, merge: Callable[[SparkSession, list[str]], None] | None = None,
    forget_after: str | None = None,
) -> None:
    """One incremental pass: valid rows to gold, the others to quarantine, both from one parsed and checked batch.

    ``merge`` is then given the load dates of the batch's valid rows. With ``forget_after`` (such as '7 days') a record
    that was landed before as it is, in whichever file and batch, is dropped; landed records are remembered for so long
    by load date, and files of load dates further back than that are no longer taken.
    """
    parts = ["content_type", "ingest_date"]

    def each(batch: DataFrame, number: int) -> None:
        # Written, not held in memory: the text of a large batch would fill the heap.
        place, judged = f"{out}/_checked/{number}", checked(batch)
        judged = judged.withColumn(LINE, F.when(F.col(REASON).isNotNull(), F.col(LINE)))  # only what is set aside keeps its line
        judged.write.mode("overwrite").option("compression", "zstd").parquet(place)
        found = batch.sparkSession.read.schema(judged.schema).parquet(place)
        try:
            valid = found.where(F.col(REASON).isNull()).drop(REASON, CORRUPT, LINE)
            write_batch(enriched_rows(valid, run_id), number, f"{out}/gold", parts)
            write_batch(to_quarantine(found.where(F.col(REASON).isNotNull())), number, f"{out}/quarantine", parts)
            if merge is not None:
                days = valid.select(F.col("ingest_date").cast("string")).distinct().collect()  # a row per load date
                merge(batch.sparkSession, [d[0] for d in days])
        finally:
            remove(batch.sparkSession, place)

    stream = stream_content(spark, root)
    if forget_after:
        stream = stream.withColumn("_landed", F.col("ingest_date").cast("timestamp"))
        stream = stream.withWatermark("_landed", forget_after).dropDuplicatesWithinWatermark(["content_type", LINE]).drop("_landed")
    run_batches(stream, each, f"{out}/_checkpoints/content").awaitTermination()


def windowed_counts(rows: DataFrame, moment: str, by: list[str], window: str = "1 hour") -> DataFrame:
    """Items per time window and group."""
    counted = rows.groupBy(F.window(moment, window), *by).agg(F.count(F.lit(1)).alias("content_count"))
    return counted.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, "content_count"
    )


def count_windows_once(stream: DataFrame, moment: str, by: list[str], path: str, checkpoint: str, window: str = "1 hour") -> None:
    """Counts per window of everything that is new, added to those of earlier runs.

    Each batch writes its own partial counts, however late its rows are; ``stateful.read_windows`` adds them up. So no row
    is dropped for its age, no window waits for a watermark, and no state is kept.
    """
    run_batches(
        stream, lambda batch, number: write_batch(windowed_counts(batch, moment, by, window), number, path), checkpoint
    ).awaitTermination()
