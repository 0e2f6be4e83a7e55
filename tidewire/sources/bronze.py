"""Reading and landing raw content records (JSON Lines)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.fixed_values import CONTENT_TYPES, ENDPOINTS
from tidewire.functions.clock import as_moment
from tidewire.schemas import BRONZE_CONTENT, BRONZE_INFO, CORRUPT, EXTRACTION_META, LINE
from tidewire.session import path_exists

Dates = list[dt.date | str] | None


def _with_partition(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("ingest_date", T.DateType())])


def on_dates(df: DataFrame, ingest_dates: Dates) -> DataFrame:
    """Partition filter; all dates when none are given."""
    if ingest_dates is None:
        return df
    return df.where(F.col("ingest_date").isin([F.lit(str(d)).cast("date") for d in ingest_dates]))


def parsed_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Raw JSON lines as records with the declared columns, beside the frame's other columns.

    Nested fields are JSON text with every key they have. ``_line`` keeps the whole record; a line that is no JSON, or
    does not fit the schema, has its text in ``_corrupt_record`` as well. Blank lines are left out.
    """
    schema = T.StructType([*BRONZE_CONTENT.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rest = [c for c in lines.columns if c != line]
    filled = lines.where(F.length(F.trim(line)) > 0)
    records = filled.select(F.from_json(line, schema, options).alias("_record"), F.col(line).alias(LINE), *rest)
    return records.select("_record.*", LINE, *rest)


def read_content(
    spark: SparkSession, root: str, ingest_dates: Dates = None, content_types: list[str] = CONTENT_TYPES
) -> DataFrame:
    """Records of all types below ``{root}/{type}/ingest_date=...`` as ``parsed_lines`` has them.

    A type without a folder contributes nothing.
    """
    frames = [
        read_lines(spark, root, kind, ingest_dates).withColumn("content_type", F.lit(kind))
        for kind in content_types
        if path_exists(spark, f"{root}/{kind}")
    ]
    if not frames:
        empty = "value string, ingest_date date, content_type string"
        return parsed_lines(spark.createDataFrame([], empty))
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame)
    return parsed_lines(combined)


def read_lines(spark: SparkSession, root: str, endpoint: str, ingest_dates: Dates = None) -> DataFrame:
    """Raw text lines of one endpoint, empty lines left out."""
    schema = _with_partition(T.StructType([T.StructField("value", T.StringType())]))
    lines = spark.read.schema(schema).text(f"{root}/{endpoint}")
    return on_dates(lines, ingest_dates).where(F.length(F.trim("value")) > 0)


def read_info(spark: SparkSession, root: str, ingest_dates: Dates = None) -> DataFrame:
    """Metadata records; no rows when the endpoint was never landed."""
    if not path_exists(spark, f"{root}/info"):
        return spark.createDataFrame([], _with_partition(BRONZE_INFO))
    return on_dates(spark.read.schema(_with_partition(BRONZE_INFO)).json(f"{root}/info"), ingest_dates)


def official_sites(info: DataFrame) -> DataFrame:
    """The official site names as rows (``news_site``)."""
    return info.select(F.explode("news_sites").alias("news_site")).distinct()


def api_metadata(info: DataFrame, now: dt.datetime | str | Column | None = None) -> DataFrame:
    """Silver metadata: version, number of sites, the list, load date, capture time."""
    return info.select(
        F.col("version").alias("api_version"),
        F.coalesce(F.size("news_sites"), F.lit(0)).cast("bigint").alias("news_sites_count"),
        F.col("news_sites").alias("news_sites_list"),
        "ingest_date",
        as_moment(now).alias("captured_at"),
    )


def land_lines(lines: DataFrame, root: str, endpoint: str, line: str = "value") -> None:
    """Write raw lines as they are to ``{root}/{endpoint}/ingest_date=...`` (one text column, one date column)."""
    lines.select(F.col(line).alias("value"), "ingest_date").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("ingest_date").text(f"{root}/{endpoint}")


def land_records(df: DataFrame, root: str, endpoint: str) -> None:
    """Write typed records as JSON Lines to ``{root}/{endpoint}/ingest_date=...``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ingest_date").json(
        f"{root}/{endpoint}"
    )


def extraction_metadata(
    checked: DataFrame, run_id: str, start_time: str, end_time: str, reason: str = "_error_reason", page_size: int = 100
) -> DataFrame:
    """One metadata row per endpoint and load date from checked records (``endpoint``, ``ingest_date``).

    The pagination block says how many pages of ``page_size`` the records fill; an extraction that has ended has no more.
    """
    counts = checked.groupBy("endpoint", F.col("ingest_date").cast("string").alias("ingest_date")).agg(
        F.count_if(F.col(reason).isNull()).alias("valid_count"),
        F.count_if(F.col(reason).isNotNull()).alias("invalid_count"),
    )
    return counts.select(
        "endpoint",
        F.concat(F.lit(run_id), F.lit("_"), "endpoint").alias("run_id"),
        F.lit(start_time).alias("start_time"),
        F.lit(end_time).alias("end_time"),
        F.col("valid_count").alias("records_downloaded"),
        "valid_count",
        "invalid_count",
        F.struct(
            "endpoint",
            F.ceil((F.col("valid_count") + F.col("invalid_count")) / page_size).cast("bigint").alias("total_pages"),
            (F.col("valid_count") + F.col("invalid_count")).alias("total_results"),
            F.lit(page_size).cast("bigint").alias("page_size"),
            F.lit(False).alias("has_more"),
        ).alias("pagination"),
        "ingest_date",
    )


def write_extraction_metadata(metadata: DataFrame, root: str) -> None:
    """Metadata as one JSON file per load date and endpoint below ``{root}/_meta``.

    The folder columns are copies, so that the record keeps its own date and endpoint.
    """
    copies = metadata.withColumns({"_day": F.col("ingest_date"), "_endpoint": F.col("endpoint")})
    copies.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_day", "_endpoint").json(
        f"{root}/_meta"
    )


def list_extractions(spark: SparkSession, root: str, limit: int = 20) -> DataFrame:
    """Latest metadata files (one record each, over one or more lines), newest first."""
    reader = spark.read.schema(EXTRACTION_META).option("recursiveFileLookup", True).option("multiLine", True)
    files = reader.json(f"{root}/_meta")
    return (
        files.select(
            F.col("_metadata.file_modification_time").alias("modified"),
            F.coalesce("endpoint", F.lit("unknown")).alias("endpoint"),
            F.coalesce("records_downloaded", F.lit(0)).alias("records"),
            F.col("_metadata.file_path").alias("path"),
        )
        .orderBy(F.desc("modified"), "endpoint", "path").limit(limit)
    )


def check_extraction(
    spark: SparkSession, root: str, ingest_date: dt.date | str, endpoints: list[str] = ENDPOINTS
) -> DataFrame:
    """Records (non-blank lines over all files), files and KB per endpoint for one load date."""
    landed = [e for e in endpoints if path_exists(spark, f"{root}/{e}/ingest_date={ingest_date}")]
    wanted = spark.createDataFrame([(e,) for e in endpoints], "endpoint string")
    if not landed:
        return wanted.select(
            "endpoint", F.lit(0).cast("bigint").alias("records"), F.lit(0).cast("bigint").alias("file_count"),
            F.lit(0.0).alias("size_kb"), F.lit("No files found").alias("status"),
        )
    paths = [f"{root}/{e}/ingest_date={ingest_date}" for e in landed]
    lines = spark.read.text(paths).select(
        F.regexp_extract("_metadata.file_path", r"/([^/]+)/ingest_date=[^/]+/[^/]+$", 1).alias("endpoint"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
        (F.length(F.trim("value")) > 0).alias("filled"),
    )
    per_file = lines.groupBy("endpoint", "path").agg(F.max("size").alias("size"), F.count_if("filled").alias("records"))
    found = per_file.groupBy("endpoint").agg(
        F.sum("records").alias("records"),
        F.count(F.lit(1)).alias("file_count"),
        F.round(F.sum("size") / 1024, 1).alias("size_kb"),
    )
    return wanted.join(found, "endpoint", "left").select(
        "endpoint",
        F.coalesce("records", F.lit(0)).alias("records"),
        F.coalesce("file_count", F.lit(0)).alias("file_count"),
        F.coalesce("size_kb", F.lit(0.0)).alias("size_kb"),
        F.when(F.col("file_count").isNull(), "No files found").otherwise("OK").alias("status"),
    )


def incremental(
    df: DataFrame, since: dt.date | str | None = None, updated_after: dt.date | str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Records published since, or updated after, a date; at most ``limit`` of them, newest first."""
    if since is not None:
        df = df.where(F.col("published_at") >= F.lit(str(since)).cast("timestamp"))
    if updated_after is not None:
        df = df.where(F.col("updated_at") >= F.lit(str(updated_after)).cast("timestamp"))
    if limit is not None:
        df = df.orderBy(F.desc("published_at"), "id").limit(limit)
    return df
