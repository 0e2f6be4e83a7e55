"""Distinct counts that add up: a sketch per load date, publishing day and type, united by reports.

A distinct count over a longer span cannot be added up from shorter ones, but sketches of the values can be united. A day's
job reads the rows that its load opened and writes a few sketches; a report over a month, a year or all types unites
sketches and reads no row of content. Estimates are off by about 0.8 % (``LG_K`` = 14, 16 KB a sketch at most, far less for
few values). Exact counts stay the default of all reports.

A sketch cannot forget: a value counts if any version that was ever opened had it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.clock import AsOf, as_date, month_label, month_start
from tidewire.session import remove
from tidewire.sources.tables import CoreTable, Lake, write_with_stats

SKETCHES = "agg_daily_sketches"
LG_K = 14
COUNTED = {"items": "content_id", "sites": "news_site", "topics": "topic_name"}


def day_sketches(opened: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """(date, content_type, versions, items, sites, topics): rows opened per publishing day and type, and a sketch of the
    different values of each; NULL is no value, and a group without values has no sketch."""
    return opened.groupBy(F.to_date("published_at").alias("date"), "content_type").agg(
        F.count(F.lit(1)).alias("versions"),
        *[F.when(F.count(column) > 0, F.hll_sketch_agg(column, lg_k)).alias(name) for name, column in COUNTED.items()],
    )


def sketches_job(spark: SparkSession, lake: Lake, days: list[str], buckets: int | None = 8) -> int:
    """Write the sketches of these load dates, from the buckets that their loads wrote."""
    core, path, written = CoreTable(spark, lake.core(), buckets), lake.core(SKETCHES), 0
    for day in days:
        rows = day_sketches(core.opened(day)).withColumn("ingest_date", F.lit(day).cast("date"))
        records = write_with_stats(rows, path, partition_by=["ingest_date"])["records"]
        if not records:
            remove(spark, f"{path}/ingest_date={day}")
        written += records
    return written


def united(sketches: DataFrame, *by, as_of: AsOf = None) -> DataFrame:
    """Estimated distinct items, sites and topics per group of sketches."""
    rows = sketches if as_of is None else sketches.where(F.col("ingest_date") <= as_date(as_of))
    estimates = [F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).alias(f"{c}_estimate") for c in COUNTED]
    return rows.groupBy(*by).agg(F.sum("versions").alias("versions"), *estimates)


def monthly_distincts(sketches: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Estimated distinct items, active sites and topics per month and type (the counts of report 4.1)."""
    months = united(sketches, month_start("date"), "content_type", as_of=as_of)
    return months.select(month_label(F.col("month_start")).alias("year_month"), *[c for c in months.columns if c != "month_start"])
