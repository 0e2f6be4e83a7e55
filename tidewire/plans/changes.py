"""Aggregates that follow the loads: signed changes per load date, added up on reading.

A load opens versions and closes others. What it changes in a count is the opened rows, plus one each, and the closed
rows, minus one each; both lie in the load's own folder. So a day's job reads the buckets that its load wrote and stores a
few rows per group that changed, and the sum over all load dates up to a day is the count as of that day, equal to a full
recount. Nothing is stored twice: the tables grow with what changes, not with days times groups.

Three tables follow the loads: the daily summary, the postings of keywords (word to document versions, parted by a hash
of the word and sorted by it), and keyword counts per topic, added up from a day's postings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.clock import AsOf, as_date, as_moment, month_label, month_start
from tidewire.functions.measures import named_topic
from tidewire.functions.text import split_list
from tidewire.sources.tables import CoreTable, Lake, read_partitions, write_with_stats
from tidewire.session import remove

SUMMARY_CHANGES, POSTINGS, KEYWORD_CHANGES = "agg_daily_summary_changes", "keyword_postings", "agg_keyword_changes"
SUMMARY_KEYS = ["date", "content_type", "news_site", "topic_name"]
POSTING_PARTS = 16
MIN_KEYWORD = 3


def version_changes(core: CoreTable, day: str) -> DataFrame:
    """Rows that the load of a day opened (sign 1) and closed (sign -1)."""
    opened, closed = core.opened(day).withColumn("sign", F.lit(1)), core.closed(day)
    return opened if closed is None else opened.unionByName(closed.withColumn("sign", F.lit(-1)), allowMissingColumns=True)


def _dated(df: DataFrame, day: str) -> DataFrame:
    return df.withColumn("ingest_date", F.lit(day).cast("date"))


def summary_changes(changes: DataFrame) -> DataFrame:
    """What a load changes in the daily summary; groups that it leaves as they are have no row."""
    groups = changes.groupBy(F.to_date("published_at").alias("date"), "content_type", "news_site", "topic_name").agg(
        F.sum("sign").alias("content_count"), F.sum(F.when(F.col("featured"), F.col("sign")).otherwise(0)).alias("featured_count")
    )
    return groups.where("content_count <> 0 OR featured_count <> 0")


def keyword_list(df: DataFrame) -> Column:
    """The keywords of a row as a list: the stored one, or the joined text split where a frame has no list."""
    if "keyword_list" in df.columns:
        return F.col("keyword_list")
    return split_list(F.col("keywords"))


def postings(changes: DataFrame) -> DataFrame:
    """(word_part, keyword, content_type, content_id, version, topic_name, uses, sign): each different word of a changed
    version, and how often its list names it."""
    listed = changes.select("content_type", "content_id", "version", "topic_name", "sign", F.array_sort(keyword_list(changes)).alias("words"))
    # Equal words of a sorted list stand together: where each run begins, and where the next does.
    starts = F.expr("filter(sequence(1, size(words)), i -> i = 1 OR words[i - 1] <> words[i - 2])")
    runs = listed.where(F.size("words") > 0).withColumn("starts", starts)
    one = F.expr(
        "transform(starts, (at, i) -> struct(words[at - 1] AS keyword, "
        "coalesce(get(starts, i + 1), size(words) + 1) - at AS uses))"
    )
    rows = runs.select("content_type", "content_id", "version", "topic_name", "sign", F.inline(one))
    rows = rows.where(F.length("keyword") >= MIN_KEYWORD)
    return rows.withColumn("word_part", F.pmod(F.hash("keyword"), F.lit(POSTING_PARTS)))


def keyword_changes(rows: DataFrame) -> DataFrame:
    """What postings change in the counts of a keyword and topic: document versions, and uses in them."""
    groups = rows.groupBy("keyword", "topic_name").agg(
        F.sum("sign").alias("documents"), F.sum(F.col("sign") * F.col("uses")).alias("uses")
    )
    return groups.where("documents <> 0 OR uses <> 0")


def _replace(df: DataFrame, path: str, day: str, **options) -> int:
    written = write_with_stats(_dated(df, day), path, **options)["records"]
    if not written:
        remove(df.sparkSession, f"{path}/ingest_date={day}")
    return written


def changes_job(spark: SparkSession, lake: Lake, days: list[str], buckets: int | None = 8) -> dict:
    """Write the changes of these load dates, replacing what the tables hold for them."""
    core = CoreTable(spark, lake.core(), buckets)
    counts = {SUMMARY_CHANGES: 0, POSTINGS: 0, KEYWORD_CHANGES: 0}
    for day in days:
        changes = version_changes(core, day)
        counts[SUMMARY_CHANGES] += _replace(summary_changes(changes), lake.core(SUMMARY_CHANGES), day, partition_by=["ingest_date"])
        remove(spark, f"{lake.core(POSTINGS)}/ingest_date={day}")  # a part that gets no words would stay
        counts[POSTINGS] += _replace(
            postings(changes), lake.core(POSTINGS), day, partition_by=["ingest_date", "word_part"],
            sort_within=["word_part", "keyword", "content_id"], rebalance=True,
        )
        rows = read_partitions(spark, lake.core(POSTINGS), [day]) if counts[POSTINGS] else None
        if rows is not None:
            counts[KEYWORD_CHANGES] += _replace(keyword_changes(rows), lake.core(KEYWORD_CHANGES), day, partition_by=["ingest_date"])
        else:
            remove(spark, f"{lake.core(KEYWORD_CHANGES)}/ingest_date={day}")
    return counts


def _until(changes: DataFrame, as_of: AsOf) -> DataFrame:
    return changes if as_of is None else changes.where(F.col("ingest_date") <= as_date(as_of))


def summary(changes: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The daily summary after the newest load, or after those up to a day."""
    groups = _until(changes, as_of).groupBy(*SUMMARY_KEYS).agg(
        F.sum("content_count").alias("content_count"), F.sum("featured_count").alias("featured_count")
    )
    return groups.where("content_count <> 0")


def monthly(changes: DataFrame, dimension: str, ingest_date: AsOf, now=None) -> DataFrame:
    """Items per month, ``topic_name`` or ``news_site``, and type, over the whole history as of a load date."""
    counts = _until(changes, ingest_date).groupBy(month_start("date"), dimension, "content_type").agg(
        F.sum("content_count").alias("content_count")
    )
    return counts.where("content_count <> 0").select(
        month_label(F.col("month_start")).alias("year_month"), dimension, "content_type", "content_count",
        as_date(ingest_date).alias("ingest_date"), as_moment(now).alias("calculated_at"),
    )


def top_keywords(changes: DataFrame, limit: int = 100, as_of: AsOf = None) -> DataFrame:
    """5.2 Keywords by current rows that use them, with the number of topics; from the keyword counts."""
    fine = _until(changes, as_of).groupBy("keyword", "topic_name").agg(F.sum("documents").alias("n")).where("n <> 0")
    return fine.groupBy("keyword").agg(
        F.sum("n").alias("frequency"), F.count("topic_name").alias("topics_used_in")
    ).orderBy(F.desc("frequency"), "keyword").limit(limit)


def keywords_by_topic(changes: DataFrame, min_count: int = 5, as_of: AsOf = None) -> DataFrame:
    """5.3 Uses of a keyword within a topic; from the keyword counts."""
    named = _until(changes, as_of).where(named_topic())
    groups = named.groupBy("topic_name", "keyword").agg(F.sum("uses").alias("frequency"))
    return groups.where(F.col("frequency") >= min_count).orderBy("topic_name", F.desc("frequency"), "keyword")


def documents_with(rows: DataFrame, words: list[str], as_of: AsOf = None) -> DataFrame:
    """(content_type, content_id, version, words, uses): current versions that use any of the words, from the postings.

    Reads the parts of these words only, and in them the row groups that can hold the words.
    """
    spark = rows.sparkSession
    parts = [r[0] for r in spark.createDataFrame([(w,) for w in words], "keyword string").select(
        F.pmod(F.hash("keyword"), F.lit(POSTING_PARTS))
    ).collect()]
    found = _until(rows, as_of).where(F.col("word_part").isin(parts) & F.col("keyword").isin(words))
    live = found.groupBy("content_type", "content_id", "version", "keyword").agg(F.sum("sign").alias("n"), F.max("uses").alias("uses"))
    return live.where("n > 0").groupBy("content_type", "content_id", "version").agg(
        F.array_sort(F.collect_list("keyword")).alias("words"), F.sum("uses").alias("uses")
    )
