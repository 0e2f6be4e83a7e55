"""Version history (SCD type 2) as a pure function from state and batch to the next state."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.fixed_values import OPEN_END
from tidewire.functions.clock import as_moment
from tidewire.operators.dedup import deduplicate_by_key

KEYS = ["content_id", "content_type"]
VERSIONING = ["version", "valid_from", "valid_to", "is_current", "created_at", "updated_db_at"]


def surrogate_key() -> Column:
    """Stable under retry and rerun: key and version, no counter."""
    return F.concat_ws("|", "content_id", "content_type", "version")


def first_versions(batch: DataFrame, now: dt.datetime | str | Column) -> DataFrame:
    """A batch as the first state: every row is version 1 and current."""
    moment = as_moment(now)
    return batch.withColumns(
        {
            "version": F.lit(1),
            "valid_from": moment,
            "valid_to": F.lit(OPEN_END).cast("timestamp"),
            "is_current": F.lit(True),
            "created_at": moment,
            "updated_db_at": moment,
        }
    ).withColumn("content_pk", surrogate_key())


def merge_current(
    current: DataFrame, batch: DataFrame, now: dt.datetime | str | Column, latest_by: str | None = None
) -> DataFrame:
    """Next current rows plus the rows this batch closes, from the current slice alone.

    A key always has exactly one current row and it holds the highest version (deletes are not
    detected, so a key never loses its current row). The closed history is therefore never
    read: the cost follows the current slice, not all versions ever kept.

    One full outer join on the key pairs old and new; each pair yields one row (unchanged, not
    in the batch, or new) or two (old version closed, new version opened). Hashes compare
    null-safely. ``latest_by`` first keeps the batch's latest row per key; without it the batch
    must already be unique by key.
    """
    if latest_by is not None:
        batch = deduplicate_by_key(batch, KEYS, latest_by, tie_breaks=["record_hash"])
    payload = [c for c in current.columns if c not in [*KEYS, *VERSIONING, "content_pk"]]
    moment = as_moment(now)
    old = current.select(*KEYS, F.struct(*payload, *VERSIONING).alias("old"))
    new = batch.select(*KEYS, F.struct(*[F.col(c) for c in payload]).alias("new"))
    paired = old.join(new, KEYS, "full_outer")

    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    changed = has_old & has_new & ~F.col("old.record_hash").eqNullSafe(F.col("new.record_hash"))

    kept = F.when(
        has_old,
        F.struct(
            *[F.col(f"old.{c}").alias(c) for c in [*payload, "version", "valid_from"]],
            F.when(changed, moment).otherwise(F.col("old.valid_to")).alias("valid_to"),
            F.when(changed, F.lit(False)).otherwise(F.col("old.is_current")).alias("is_current"),
            F.col("old.created_at").alias("created_at"),
            F.when(changed, moment).otherwise(F.col("old.updated_db_at")).alias("updated_db_at"),
        ),
    )
    opened = F.when(
        has_new & (~has_old | changed),
        F.struct(
            *[F.col(f"new.{c}").alias(c) for c in payload],
            (F.coalesce(F.col("old.version"), F.lit(0)) + 1).alias("version"),
            moment.alias("valid_from"),
            F.lit(OPEN_END).cast("timestamp").alias("valid_to"),
            F.lit(True).alias("is_current"),
            moment.alias("created_at"),
            moment.alias("updated_db_at"),
        ),
    )
    rows = paired.select(*KEYS, F.explode(F.array(kept, opened)).alias("row")).where(F.col("row").isNotNull())
    merged = rows.select(*KEYS, *[F.col(f"row.{c}").alias(c) for c in [*payload, *VERSIONING]])
    return merged.withColumn("content_pk", surrogate_key()).select(*current.columns)


def scd2_merge(
    state: DataFrame, batch: DataFrame, now: dt.datetime | str | Column, latest_by: str | None = None
) -> DataFrame:
    """Whole next state: untouched history and the merged current slice.

    The state is read for both parts, so write it between loads (the stored table does) when
    several loads follow one another; chained in one plan the work would double with each load.
    """
    history = state.where(~F.col("is_current"))
    return history.unionByName(merge_current(state.where("is_current"), batch, now, latest_by))


def version_report(state: DataFrame) -> DataFrame:
    """All, current and historical rows per type."""
    return state.groupBy("content_type").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("is_current")).alias("current_records"),
        F.count_if(~F.col("is_current")).alias("historical_records"),
    )


def broken_versions(state: DataFrame) -> DataFrame:
    """Keys that break a rule: one current row, versions 1..n without gaps, the current one highest."""
    per_key = state.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("versions"),
        F.count_if(F.col("is_current")).alias("current_versions"),
        F.min("version").alias("lowest"),
        F.max("version").alias("highest"),
        F.max(F.when(F.col("is_current"), F.col("version"))).alias("current_version"),
    )
    sound = (
        (F.col("current_versions") == 1) & (F.col("lowest") == 1) & (F.col("highest") == F.col("versions"))
        & F.col("current_version").eqNullSafe(F.col("highest"))
    )
    return per_key.where(~sound)
