"""The written tables under SQL names, for reports written as SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidewire.plans.changes import KEYWORD_CHANGES, POSTINGS, SUMMARY_CHANGES, SUMMARY_KEYS
from tidewire.session import path_exists
from tidewire.sources.tables import CoreDimension, CoreTable, Lake


CHANGE_TABLES = (SUMMARY_CHANGES, POSTINGS, KEYWORD_CHANGES)


def publish_views(spark: SparkSession, lake: Lake, database: str = "core") -> list[str]:
    """Create or refresh ``core.content_items`` and its companions; returns the names created.

    The views read the files of the newest complete snapshots, so filters and columns of a query
    reach the Parquet scans. Run it again after a load. The run and check views carry the table's
    own column names and those that the monitoring reports use.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    bodies: dict[str, str] = {}

    # One scan, however many loads there are; a filter on is_current leaves only the current buckets' folders.
    core = CoreTable(spark, lake.core())
    held, closed = core.parts()
    if held:
        quoted = lambda parts: ", ".join(f"'{p}'" for p in sorted(parts))
        load = lambda folder: folder.split("=", 1)[1]
        chosen = f"is_current = 'true' AND concat(load_id, '/', bucket) IN ({quoted(f'{load(f)}/{n}' for n, f in held.items())})"
        if closed:
            chosen += f" OR is_current = 'false' AND load_id IN ({quoted(load(f) for f in closed)})"
        bodies["content_items"] = (
            f"SELECT * EXCEPT (load_id, is_current, bucket), is_current = 'true' AS is_current FROM parquet.`{core.path}` WHERE {chosen}"
        )
    for table in ("ref_news_sites", "ref_topics"):
        folder = CoreDimension(spark, lake.core(table)).newest()
        if folder:
            bodies[table] = f"SELECT * FROM parquet.`{folder}`"
    for table in ("agg_topic_monthly_trends", "agg_news_site_monthly_activity", "meta_quality_issues", *CHANGE_TABLES):
        bodies[table] = f"SELECT * FROM parquet.`{lake.core(table)}`"
    if path_exists(spark, lake.core(SUMMARY_CHANGES)):
        # As of each load date: the sum of all changes up to it. A filter on ingest_date picks the date.
        keys, source = ", ".join(f"c.{k}" for k in SUMMARY_KEYS), f"parquet.`{lake.core(SUMMARY_CHANGES)}`"
        bodies["agg_daily_summary"] = (
            f"SELECT {keys}, sum(c.content_count) AS content_count, sum(c.featured_count) AS featured_count, d.ingest_date "
            f"FROM (SELECT DISTINCT ingest_date FROM {source}) d JOIN {source} c ON c.ingest_date <= d.ingest_date "
            f"GROUP BY d.ingest_date, {keys} HAVING sum(c.content_count) <> 0"
        )
    bodies["meta_pipeline_runs"] = (
        "SELECT *, ingest_date AS run_date, run_type AS pipeline_name, run_status AS status, "
        f"duration_seconds AS execution_time_seconds FROM parquet.`{lake.core('meta_pipeline_runs')}`"
    )
    bodies["meta_data_quality_checks"] = (
        "SELECT *, ingest_date AS check_date, CAST(check_value AS BIGINT) AS records_checked, "
        "error_message AS error_details, checked_at AS created_at "
        f"FROM parquet.`{lake.core('meta_data_quality_checks')}`"
    )
    created = []
    for table, body in bodies.items():
        if table in ("content_items", "ref_news_sites", "ref_topics", "agg_daily_summary") or path_exists(spark, lake.core(table)):
            spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} AS {body}")
            created.append(f"{database}.{table}")
    return created
