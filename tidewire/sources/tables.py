"""Layer tables: partitioned Parquet, staging CSV, and the versioned core table."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.fixed_values import CONTENT_TYPES, STAGING_COLUMNS
from tidewire.operators.dedup import deduplicate_by_key, deduplicate_stored
from tidewire.operators.scd2 import KEYS, first_versions, merge_current
from tidewire.session import child_names, create_text, path_exists, read_text, remove, scratch_path
from tidewire.sources.bronze import Dates, on_dates


@dataclass(frozen=True)
class Lake:
    """Where the layers live; the landed files may be elsewhere."""

    root: str
    landed: str | None = None

    @property
    def bronze(self) -> str:
        return self.landed or f"{self.root}/bronze"

    def silver(self, table: str = "content") -> str:
        return f"{self.root}/silver/{table}"

    def gold(self, table: str = "content_enriched") -> str:
        return f"{self.root}/gold/{table}"

    def core(self, table: str = "content_items") -> str:
        return f"{self.root}/core/{table}"

    @property
    def insights(self) -> str:
        return f"{self.root}/insights/daily"


def read_partitions(
    spark: SparkSession, path: str, ingest_dates: Dates = None, schema: T.StructType | None = None
) -> DataFrame:
    """Table root with a partition filter. With a schema, a missing table reads as empty."""
    if schema is not None and not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return on_dates(reader.parquet(path), ingest_dates)


def write_with_stats(
    df: DataFrame, path: str, mode: str = "overwrite", format: str = "parquet",
    partition_by: list[str] | None = None, sort_within: list[str] | None = None, metrics: dict | None = None,
    rebalance: bool = False,
) -> dict:
    """Write and return the row count (and further metrics) observed during that same write.

    Overwriting a partitioned table replaces only the partitions that the frame contains.
    ``sort_within`` orders rows inside each task so that Parquet row groups can be skipped.
    ``rebalance`` first gathers each folder's rows into few tasks, splitting a folder that is
    too large for one; worth its shuffle when rows of many folders lie mixed in every task.
    """
    seen = Observation()
    measured = {"records": F.count(F.lit(1)), **(metrics or {})}
    observed = df.observe(seen, *[column.alias(name) for name, column in measured.items()])
    if rebalance and partition_by:
        observed = observed.hint("rebalance", *partition_by)
    if sort_within:
        observed = observed.sortWithinPartitions(*sort_within)
    writer = observed.write.mode(mode).format(format)
    if format == "parquet":
        writer = writer.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.save(path)
    try:
        found = seen.get
    except Py4JJavaError:  # the plan turned out to be empty before any task ran, so nothing was observed
        found = {"records": 0, **dict.fromkeys(metrics or {})}
    return {**found, "columns": len(df.columns)}


def write_dates(
    df: DataFrame, path: str, ingest_dates: list[str], content_types: list[str] = CONTENT_TYPES, **options
) -> dict:
    """Make a (type, date) partitioned table hold exactly the frame's rows for these load dates.

    Dynamic overwrite leaves a folder alone that gets no rows; one that held rows from an earlier
    run of the date is removed here. Which folders got rows is observed during the write.
    """
    label = F.concat_ws("/", "content_type", F.col("ingest_date").cast("string"))
    metrics = {**options.pop("metrics", {}), "folders": F.collect_set(label)}
    written = write_with_stats(df, path, partition_by=["content_type", "ingest_date"], metrics=metrics, **options)
    filled = set(written.pop("folders") or [])
    for kind in content_types:
        for day in ingest_dates:
            if f"{kind}/{day}" not in filled:
                remove(df.sparkSession, f"{path}/content_type={kind}/ingest_date={day}")
    return written


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None, single_file: bool = False) -> None:
    """CSV with header, quote and escape '"'. One file only on request, as that is one task."""
    frame = df.coalesce(1) if single_file else df
    writer = frame.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.csv(path)


CSV_OPTIONS = {"quote": '"', "escape": '"', "nullValue": "\\N", "mode": "PERMISSIVE"}


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, first, record): each record of the CSV files, line breaks inside quotes kept; ``first`` marks a file's header.

    Files are read in splits of lines, many to a file. A line break ends a record if the quotes before it are even in
    number. Quotes are counted per line; sums per split, one row each, tell with how many each split of a file begins; the
    same sum within a split then tells for each line. A record on one line is complete. Only lines of longer records are
    gathered, by the split and place at which their record began, also across splits.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"), F.make_valid_utf8("value").alias("value"),
    ).withColumn("quotes", (F.length("value") - F.length(F.replace("value", F.lit('"')))) % 2)
    inside = Window.partitionBy("file", "split").orderBy("line")
    before = F.coalesce(F.sum("quotes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    lines = lines.withColumn("odd", before)

    # What a split passes on: its quotes, and how many lines begin a record if none or one is open at its start.
    splits = lines.groupBy("file", "split").agg(
        (F.sum("quotes") % 2).alias("quotes"), F.count_if(F.col("odd") == 0).alias("even"), F.count_if(F.col("odd") == 1).alias("uneven")
    )
    ahead = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("open", F.coalesce(F.sum("quotes").over(ahead), F.lit(0)) % 2)
    begun = F.when(F.when(F.col("open") == 0, F.col("even")).otherwise(F.col("uneven")) > 0, F.col("split"))
    splits = splits.select("file", "split", "open", F.last(begun, ignorenulls=True).over(ahead).alias("earlier"))

    placed = lines.join(splits, ["file", "split"]).withColumn("starts", F.col("odd") == F.col("open"))
    count = F.count_if("starts")
    placed = placed.withColumns({
        "number": count.over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "whole": F.col("starts") & (F.col("quotes") == 0),
    })
    # Lines before the first record of a split belong to the last one of the split that has one.
    started = F.when(F.col("number") > 0, F.col("split")).otherwise(F.col("earlier"))
    last = F.when(F.col("number") > 0, F.col("number"))
    single = placed.where("whole").select("file", ((F.col("split") == 0) & (F.col("number") == 1)).alias("first"), F.col("value").alias("record"))
    parts = placed.where("NOT whole").select("file", started.alias("begun"), last.alias("number"), "split", "line", "value")
    # The open record of a split is its highest number; only it can go on in later splits.
    highest = parts.where("number IS NOT NULL").groupBy("file", "begun").agg(F.max("number").alias("highest"))
    parts = parts.join(highest, ["file", "begun"]).withColumn("number", F.coalesce("number", "highest"))
    longer = parts.groupBy("file", "begun", "number").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "line", "value"))), lambda x: x["value"]), "\n").alias("record")
    ).select("file", ((F.col("begun") == 0) & (F.col("number") == 1)).alias("first"), "record")
    return single.unionByName(longer)


def read_staging_csv(
    spark: SparkSession, path: str, columns: Iterable[str] = STAGING_COLUMNS
) -> DataFrame:
    """CSV into all-text staging columns, texts whole, large files in many tasks.

    Columns go by the names in the header, whatever their order; columns the files lack and
    missing trailing fields are NULL, and unreadable bytes become replacement characters. A bare
    empty field is NULL and a quoted one is ''; with the default null marker both would be NULL.
    """
    header = spark.read.option("header", True).options(**CSV_OPTIONS).csv(path).columns
    records = csv_records(spark, path).where(~F.col("first")).select(F.regexp_replace("record", "\r$", "").alias("record"))
    schema = ", ".join(f"`{name.replace('`', '``')}` STRING" for name in header)
    raw = records.where(F.col("record") != "").select(F.from_csv("record", schema, CSV_OPTIONS).alias("fields"))
    present = set(header)
    return raw.select(*[F.col(f"fields.`{c}`") if c in present else F.lit(None).cast("string").alias(c) for c in columns])


class Manifest:
    """Which folder holds which load: small numbered JSON files, of which the newest counts.

    A load becomes visible when the next number is written, all its folders at once; a file that is
    already there means that somebody else has published meanwhile, and the load fails. One listing
    and one small read tell the state of the table, however many loads it has.
    """

    KEPT = 5

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path}/_manifest"

    def read(self) -> tuple[int, dict[str, dict]]:
        """Number of the newest manifest and its loads by date, oldest first."""
        numbers = sorted(int(n.split(".")[0]) for n in child_names(self.spark, self.path) if n.endswith(".json"))
        if not numbers:
            return 0, {}
        loads = json.loads(read_text(self.spark, f"{self.path}/{numbers[-1]:09d}.json"))
        return numbers[-1], dict(sorted(loads.items()))

    def publish(self, number: int, loads: dict[str, dict]) -> None:
        """Make these loads the table, if ``number`` is still the newest."""
        create_text(self.spark, f"{self.path}/{number + 1:09d}.json", json.dumps(loads, sort_keys=True))
        if number >= self.KEPT:
            remove(self.spark, f"{self.path}/{number + 1 - self.KEPT:09d}.json")


def new_load(snapshot: str) -> str:
    return f"load_id={snapshot}-{uuid.uuid4().hex[:12]}"


class CoreDimension:
    """A small dimension, whole in one folder per load date."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.manifest = spark, path, Manifest(spark, path)

    def newest(self, before: str | None = None) -> str | None:
        """Folder of the newest state (before a date)."""
        _, loads = self.manifest.read()
        known = [load["folder"] for day, load in loads.items() if before is None or day < before]
        return f"{self.path}/{known[-1]}" if known else None

    def latest(self, before: str | None = None) -> DataFrame | None:
        folder = self.newest(before)
        return self.spark.read.parquet(folder) if folder else None

    def publish(self, df: DataFrame, snapshot: str) -> None:
        number, loads = self.manifest.read()
        folder = new_load(snapshot)
        df.write.parquet(f"{self.path}/{folder}")
        old = loads.get(snapshot)
        self.manifest.publish(number, {**loads, snapshot: {"folder": folder}})
        if old:
            remove(self.spark, f"{self.path}/{old['folder']}")


BUCKET_BYTES = 64 << 20


def row_bytes(schema: T.StructType) -> Column:
    """About how long a row is: its texts and lists of texts, and eight bytes for any other value."""

    def length(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.octet_length(field.name)
        if field.dataType == T.ArrayType(T.StringType()):
            return F.octet_length(F.array_join(field.name, " "))
        return F.lit(8)

    sizes = [F.coalesce(length(field), F.lit(0)).cast("bigint") for field in schema]
    return sum(sizes[1:], sizes[0])


LISTED = "_listed"  # whether a row's keyword list is its joined keywords, split


def without_lists(rows: DataFrame) -> DataFrame:
    """Rows to be moved and sorted: a keyword list that is the split of the joined text beside it is left out."""
    if not {"keywords", "keyword_list"} <= set(rows.columns):
        return rows
    listed = F.coalesce(F.col("keyword_list") == F.split("keywords", ","), F.lit(False))
    return rows.withColumn(LISTED, listed).withColumn("keyword_list", F.when(~F.col(LISTED), F.col("keyword_list")))


def with_lists(rows: DataFrame) -> DataFrame:
    """The same rows with all lists again."""
    if LISTED not in rows.columns:
        return rows
    whole = F.when(F.col(LISTED), F.split("keywords", ",")).otherwise(F.col("keyword_list"))
    return rows.withColumn("keyword_list", whole).drop(LISTED)


class CoreTable:
    """Versioned content on plain Parquet, published one load at a time; a load writes what its batch changes.

    Keys are hashed to ``buckets``, and the current rows of each bucket lie in a folder of their own. A load of date S
    compares the batch with keys and hashes of the current rows, rewrites the buckets in which something is new or
    changed (``is_current=true/bucket=N`` below one new folder) and adds the versions that it closes
    (``is_current=false``). All other buckets stay where they are: a manifest says for each load date which folder holds
    which bucket. History is written once per version and never rewritten or re-read by a later load. A load that dies
    half-way changes nothing, and a repeated load replaces its date at the moment it is published. Dates are ISO dates,
    which sort as text.

    A load of a date before the newest one needs the later dates' batches: they are merged again on
    top of it, and all become visible together. Without them it is refused.

    Files are also bucketed and sorted by key for Spark: the next load joins the buckets where they lie, and only the
    batch is shuffled. One task handles one bucket, and sorts it: a first load doubles ``buckets`` until they hold
    ``BUCKET_BYTES`` each at most, and the manifest keeps the number, which later loads follow. For a table that begins
    small and grows far beyond its first load, choose a number that suits what it becomes; many buckets also let a small
    batch rewrite less. None stores one bucket of plain files, for tables that change hands more often than they grow.

    No batch is held in memory. One that is ``stored`` is read anew where it is needed; others are written first.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = 8):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.manifest = Manifest(spark, path)

    def bucket(self, buckets: int | None = None) -> Column:
        """Number of the bucket that a row's key falls in, the same that Spark's bucketed files carry."""
        buckets = buckets or self.buckets
        return F.pmod(F.hash(*KEYS), F.lit(buckets)) if buckets else F.lit(0)

    def _number(self, load: dict | None) -> int | None:
        """Into how many buckets a load dealt its rows; loads that do not say so have the table's own number."""
        return (load or {}).get("buckets", self.buckets)

    def _part(self, folder: str, current: bool, bucket: str | None = None) -> str:
        part = f"{self.path}/{folder}/is_current={str(current).lower()}"
        return part if bucket is None else f"{part}/bucket={bucket}"

    def _table_name(self, label: str) -> str:
        return "core_" + hashlib.md5(f"{self.path}|{label}".encode()).hexdigest()

    def snapshots(self, before: str | None = None) -> list[str]:
        """Dates loaded (before a date), oldest first."""
        return [day for day in self.manifest.read()[1] if before is None or day < before]

    def _slice(self, held: dict[str, str], buckets: int | None) -> DataFrame:
        """Current rows of these buckets, given the folder of each, with their ``bucket``."""
        places = {number: self._part(folder, True, number) for number, folder in held.items()}
        if not buckets:
            return self.spark.read.schema(self._schema()).parquet(*places.values()).withColumn("bucket", F.lit(0))
        # Parquet files do not say how they are bucketed; an external table definition does.
        name, keys = self._table_name(json.dumps([buckets, held], sort_keys=True)), ", ".join(KEYS)
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._schema())
            parts = " ".join(f"PARTITION (bucket = {number}) LOCATION '{place}'" for number, place in places.items())
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}, bucket INT) USING parquet PARTITIONED BY (bucket) "
                f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{self.path}/_tables/{name}'"
            )
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
        return self.spark.table(name)

    def _schema(self) -> T.StructType:
        """Columns of the stored rows, written down by the first load: no file has to be opened to learn them."""
        return T.StructType.fromJson(json.loads(read_text(self.spark, f"{self.path}/_schema.json")))

    def _remember_schema(self, rows: DataFrame) -> None:
        place = f"{self.path}/_schema.json"
        remove(self.spark, place)
        create_text(self.spark, place, rows.drop("is_current").schema.json())

    def current(self, before: str | None = None) -> DataFrame | None:
        """Current rows after the newest load (before a date)."""
        known = [load for day, load in self.manifest.read()[1].items() if before is None or day < before]
        if not known:
            return None
        held = self._held(known[-1])
        rows = self._slice(held, self._number(known[-1])).drop("bucket") if known[-1]["current"] else self.spark.read.parquet(self._part(held["0"], True, "0"))
        return rows.withColumn("is_current", F.lit(True))

    @staticmethod
    def _held(load: dict) -> dict[str, str]:
        if load["slice"] is None:
            raise ValueError(f"the current rows after load {load['folder']} have expired")
        return load["slice"]

    def parts(self) -> tuple[dict[str, str], list[str]]:
        """What makes up the table: the folder of each bucket's current rows, and the folders with closed versions."""
        loads = list(self.manifest.read()[1].values())
        return (self._held(loads[-1]), [x["folder"] for x in loads if x["closed"]]) if loads else ({}, [])

    def state(self) -> DataFrame:
        """All versions: a scan of the current buckets and one of everything closed up to now."""
        held, closed = self.parts()
        if not held:
            raise ValueError(f"no load below {self.path}")
        reader = self.spark.read.schema(self._schema())
        slice_ = reader.parquet(*[self._part(f, True, n) for n, f in held.items()]).withColumn("is_current", F.lit(True))
        if not closed:
            return slice_
        rows = reader.option("recursiveFileLookup", True).parquet(*[self._part(f, False) for f in closed])
        return slice_.unionByName(rows.withColumn("is_current", F.lit(False)))

    def _load(self, day: str) -> tuple[dict, dict[str, dict]]:
        loads = self.manifest.read()[1]
        if day not in loads:
            raise ValueError(f"{day} is not loaded")
        return loads[day], loads

    def opened(self, day: str) -> DataFrame:
        """Rows that the load of a day made current. Reads the buckets that it wrote; loads must differ in their time."""
        load, loads = self._load(day)
        if [x["at"] for x in loads.values()].count(load["at"]) > 1:
            raise ValueError(f"{day} was loaded at the same time as another date")
        held = {n: f for n, f in self._held(load).items() if f == load["folder"]}
        places = [self._part(f, True, n) for n, f in (held or load["slice"]).items()]
        rows = self.spark.read.schema(self._schema()).parquet(*places)
        mine = (F.col("valid_from") == F.lit(load["at"]).cast("timestamp")) if held else F.lit(False)
        return rows.where(mine).withColumn("is_current", F.lit(True))

    def closed(self, day: str) -> DataFrame | None:
        """Versions that the load of a day closed, if any."""
        load, _ = self._load(day)
        if not load["closed"]:
            return None
        reader = self.spark.read.schema(self._schema()).option("recursiveFileLookup", True)
        rows = reader.parquet(self._part(load["folder"], False))
        return rows.withColumn("is_current", F.lit(False))

    def expire_slices(self, keep: int = 2) -> list[str]:
        """Forget current rows as of all loads but the newest ``keep``; the history stays. Returns the dates concerned.

        Buckets that a kept load still refers to stay. Dates up to those can no longer be loaded anew.
        """
        number, loads = self.manifest.read()
        old = [day for day in list(loads)[:-keep] if loads[day]["slice"] is not None]
        if old:
            self.manifest.publish(number, {d: {**x, "slice": None if d in old else x["slice"]} for d, x in loads.items()})
            needed = {part for d, x in loads.items() if d not in old for part in (x["slice"] or {}).items()}
            for part in {part for d in old for part in loads[d]["slice"].items()} - needed:
                remove(self.spark, self._part(part[1], True, part[0]))
        return old

    def next_versions(self, batch: DataFrame, snapshot: str, now: str, latest_by: str | None = None) -> DataFrame:
        """All rows after a load of ``snapshot``: the merged current ones and the versions it closes."""
        return self._versions(self.current(before=snapshot), self._unique(batch, latest_by), now)

    @staticmethod
    def _unique(batch: DataFrame, latest_by: str | None, stored: bool = False) -> DataFrame:
        one = deduplicate_stored if stored else deduplicate_by_key
        return batch if latest_by is None else one(batch, KEYS, latest_by, tie_breaks=["record_hash"])

    @staticmethod
    def _versions(before: DataFrame | None, batch: DataFrame, now: str) -> DataFrame:
        if before is None:
            return first_versions(batch, now)
        return with_lists(merge_current(without_lists(before), without_lists(batch), now)).select(*before.columns)

    def changes(self, held: dict[str, str], batch: DataFrame, buckets: int | None) -> dict[str, tuple[int, int]]:
        """Keys that a batch opens and changes, by bucket; buckets with neither are left out.

        Reads the keys and hashes of the current rows only; one row per bucket comes back.
        """
        old = self._slice(held, buckets).select(*KEYS, F.col("record_hash").alias("old_hash"), F.lit(True).alias("known"))
        paired = batch.select(*KEYS, "record_hash").join(old, KEYS, "left")
        differs = F.col("known") & ~F.col("record_hash").eqNullSafe(F.col("old_hash"))
        counted = paired.groupBy(self.bucket(buckets).alias("bucket")).agg(
            F.count_if(F.col("known").isNull()).alias("opened"), F.count_if(differs).alias("changed")
        )
        return {str(r["bucket"]): (r["opened"], r["changed"]) for r in counted.where("opened + changed > 0").collect()}

    def _write(
        self, earlier: dict | None, batch: DataFrame, snapshot: str, now: str, latest_by: str | None, stored: bool = False
    ) -> tuple[dict, dict]:
        """Writes a new folder with the buckets that the batch touches; its manifest entry and the rows current, opened
        and closed."""
        batch, made = self._unique(batch, latest_by, stored), None
        if not stored:
            made = scratch_path(self.spark, "batch")
            batch.write.option("compression", "zstd").parquet(made)
            batch = self.spark.read.schema(batch.schema).parquet(made)
        try:
            held, buckets = (self._held(earlier), self._number(earlier)) if earlier else ({}, self.buckets)
            folder = new_load(snapshot)
            if earlier:
                touched = self.changes(held, batch, buckets)
                opened, closed = (sum(x[k] for x in touched.values()) for k in (0, 1))
                entry = {"folder": folder, "slice": {**held, **dict.fromkeys(touched, folder)}, "closed": closed > 0}
                if touched:
                    numbers = [int(n) for n in touched]
                    before = self._slice(held, buckets).where(F.col("bucket").isin(numbers)).drop("bucket").withColumn("is_current", F.lit(True))
                    # A condition on all buckets would only be carried along.
                    part = batch if len(numbers) == buckets else batch.where(self.bucket(buckets).isin(numbers))
                    self._put(self._versions(before, part, now), folder, buckets, spread=False)
                counts = {"current": earlier["current"] + opened, "opened": opened + closed, "closed": closed}
            else:
                rows = first_versions(batch, now)
                if buckets:
                    size = batch.agg(F.sum(row_bytes(batch.schema))).first()[0] or 0
                    while buckets * BUCKET_BYTES < size:
                        buckets *= 2
                found = {r["bucket"]: r["count"] for r in batch.groupBy(self.bucket(buckets).alias("bucket")).count().collect()}
                self._remember_schema(rows)
                if found:
                    self._put(rows, folder, buckets, spread=True)
                else:  # no row, no folder: readers still need the columns
                    rows.drop("is_current").write.parquet(self._part(folder, True, "0"))
                numbers, current = sorted(found) or [0], sum(found.values())
                entry = {"folder": folder, "slice": {str(n): folder for n in numbers}, "closed": False}
                counts = {"current": current, "opened": current, "closed": 0}
            return {**entry, "current": counts["current"], "at": str(now), "buckets": buckets}, counts
        finally:
            if made:
                remove(self.spark, made)

    def _put(self, rows: DataFrame, folder: str, buckets: int | None, spread: bool) -> None:
        place = f"{self.path}/{folder}"
        rows = rows.withColumn("bucket", self.bucket(buckets))
        if not buckets:
            rows.sortWithinPartitions("is_current", "content_type", "published_at").write.partitionBy("is_current", "bucket").parquet(place)
            return
        # A join with bucketed rows leaves one bucket per task; a first load has no such join.
        if spread:
            rows = with_lists(without_lists(rows).repartition(buckets, *KEYS))
        name = self._table_name(f"{folder}|write")
        (
            rows.write.partitionBy("is_current", "bucket").bucketBy(buckets, *KEYS).sortBy(*KEYS)
            .option("path", place).option("compression", "zstd").option("partitionOverwriteMode", "static").saveAsTable(name)
        )
        self.spark.sql(f"DROP TABLE {name}")

    def load(
        self, batch: DataFrame, snapshot: str, now: str, latest_by: str | None = None,
        replay: Callable[[str], tuple[DataFrame, str]] | None = None, stored: bool = False,
    ) -> dict:
        """Merge one batch, keyed by load date. Returns its rows current, opened and closed.

        ``stored``: batches come straight from Parquet files, only filtered and projected since.

        If later dates are loaded already, ``replay`` must give each one's batch and time; they are merged again
        after this one, and the new folders of all become visible at once.
        """
        number, loads = self.manifest.read()
        later = [day for day in loads if day > snapshot]
        if later and replay is None:
            raise ValueError(f"{snapshot} lies before {later[0]}, which is loaded: its batch is needed to load it again")
        earlier = [load for day, load in loads.items() if day < snapshot]
        before = earlier[-1] if earlier and earlier[-1]["current"] else None
        made, result = {}, None
        for day in [snapshot, *later]:
            own_batch, own_now = (batch, now) if day == snapshot else replay(day)
            made[day], counts = self._write(before, own_batch, day, own_now, latest_by, stored)
            before = made[day] if made[day]["current"] else None
            result = result or counts
        self.manifest.publish(number, {**loads, **made})
        for day in made:
            if day in loads:  # later loads, which alone refer to it, have been merged anew
                remove(self.spark, f"{self.path}/{loads[day]['folder']}")
        return result


def replace_dates(df: DataFrame, path: str, ingest_dates: list[str] | None = None) -> dict:
    """Idempotent load of an aggregate: the given load dates hold exactly the frame's rows afterwards.

    Without dates only those in the frame are replaced; a given date without rows is emptied.
    """
    day = F.col("ingest_date").cast("string")
    written = write_with_stats(df, path, partition_by=["ingest_date"], metrics={"days": F.collect_set(day)})
    filled = set(written.pop("days") or [])
    for empty in set(ingest_dates or []) - filled:
        remove(df.sparkSession, f"{path}/ingest_date={empty}")
    return written
