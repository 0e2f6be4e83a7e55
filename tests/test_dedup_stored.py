"""Election by place keeps the same rows as the sort of whole rows."""

import pytest
from pyspark.sql import functions as F

from tidewire.operators.dedup import deduplicate_by_key, deduplicate_stored
from tidewire.session import scratch_path


def stored(spark, n=5000):
    """Rows with ties, NULLs in key and order, whole repeats, and a key that holds a third of all rows."""
    path = scratch_path(spark, "rows")
    k = F.col("id")
    rows = spark.range(n).select(
        F.when(k % 3 == 0, F.lit("hot")).when(k % 41 == 0, None).otherwise((k % 900).cast("string")).alias("key"),
        F.when(k % 7 != 0, F.timestamp_seconds(1_700_000_000 + (k % 50))).alias("t"),
        F.when(k % 5 != 0, (k % 4)).alias("tie"), F.md5((k % 60).cast("string")).alias("wide"), F.lit("x" * 50).alias("more"),
    )
    rows.unionByName(rows.limit(300)).repartition(7).write.parquet(path)
    return spark.read.parquet(path)


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("ascending", [False, True])
@pytest.mark.parametrize("ties", [[], ["tie"]])
def test_same_rows(spark, ascending, ties):
    df = stored(spark).where("more IS NOT NULL").withColumn("twice", F.concat("wide", "wide"))
    expected = deduplicate_by_key(df, ["key"], "t", ascending, ties)
    found = deduplicate_stored(df, ["key"], "t", ascending, ties)
    assert found.columns == df.columns and rows(found) == rows(expected)


def test_wide_rows_are_not_moved(spark):
    found = deduplicate_stored(stored(spark), ["key"], "t", tie_breaks=["tie"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Sort" not in plan


def test_no_repeats_and_no_rows(spark):
    path = scratch_path(spark, "rows")
    spark.sql("SELECT 1 AS key, 2 AS t UNION ALL SELECT 2, 2").write.parquet(path)
    df = spark.read.parquet(path)
    assert rows(deduplicate_stored(df, ["key"], "t")) == rows(df)
    assert deduplicate_stored(df.where("key > 5"), ["key"], "t").count() == 0
