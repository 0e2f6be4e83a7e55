"""Reports 10: relations between topics, and source profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.clock import AsOf, as_date, days_between, months_before
from tidewire.functions.measures import named_topic, reliability_score, rounded_ratio, with_share
from tidewire.plans.volume import current_rows, rows, since_days


def pairable(counted: DataFrame, min_count: int) -> DataFrame:
    """Counts (day, news_site, topic_name, n) of topics that can be in a pair of ``min_count``.

    A topic's pairs with all its partners together are the sum of n times the other rows of the same day and site. A
    topic that stays below the limit with all of them cannot reach it with one.
    """
    cell = Window.partitionBy("day", "news_site")
    others = counted.withColumn("others", F.sum("n").over(cell) - F.col("n")).where("others > 0")
    able = others.groupBy("topic_name").agg(F.sum(F.col("n") * F.col("others")).alias("all_pairs"))
    return others.drop("others").join(able.where(F.col("all_pairs") >= min_count).select("topic_name"), "topic_name", "left_semi")


def topic_pairs(content: DataFrame, min_count: int = 10, limit: int = 50) -> DataFrame:
    """10.1 Topics published on the same day by the same site.

    A row-by-row self-join would emit n1 * n2 rows for each pair of topics of a day and site.
    Here the rows are first counted per (day, site, topic); the join then meets at most one row
    per topic and side, and the pair count is the sum of n1 * n2. A site with a third of all
    rows is folded by the partial aggregation before anything is shuffled. Topics too rare for any pair of ``min_count``
    leave before the join.
    """
    counted = (
        current_rows(content).where(named_topic() & F.col("news_site").isNotNull())
        .groupBy(F.to_date("published_at").alias("day"), "news_site", "topic_name").agg(rows().alias("n"))
        .where(F.col("day").isNotNull())
    )
    counted = pairable(counted, min_count)
    left = counted.select("day", "news_site", F.col("topic_name").alias("topic1"), F.col("n").alias("n1"))
    right = counted.select("day", "news_site", F.col("topic_name").alias("topic2"), F.col("n").alias("n2"))
    met = left.join(right, ["day", "news_site"]).where(F.col("topic1") < F.col("topic2"))
    pairs = met.groupBy("topic1", "topic2").agg(F.sum(F.col("n1") * F.col("n2")).alias("co_occurrence_count"))
    top = pairs.where(F.col("co_occurrence_count") >= min_count).orderBy(
        F.desc("co_occurrence_count"), "topic1", "topic2"
    ).limit(limit)
    # Whatever outranks a shown pair is shown too, so the rank needs the shown pairs only.
    rank = F.rank().over(Window.orderBy(F.desc("co_occurrence_count"))).cast("bigint")
    return top.withColumn("rank", rank).orderBy(F.desc("co_occurrence_count"), "topic1", "topic2")


def site_velocity(
    content: DataFrame, as_of: AsOf = None, days: int = 90, min_days: int = 30, limit: int = 20
) -> DataFrame:
    """10.2 Mean, range and deviation of a site's daily output."""
    recent = since_days(current_rows(content), as_of, days).where(F.col("news_site").isNotNull())
    daily = recent.groupBy(F.to_date("published_at").alias("date"), "news_site").agg(rows().alias("n"))
    groups = daily.groupBy("news_site").agg(
        F.avg("n").alias("avg_articles_per_day"),
        F.min("n").alias("min_daily"),
        F.max("n").alias("max_daily"),
        F.stddev_samp("n").alias("stddev_articles"),
        rows().alias("active_days"),
    )
    return groups.where(F.col("active_days") >= min_days).orderBy(
        F.desc("avg_articles_per_day"), "news_site"
    ).limit(limit)


def topic_seasonality(content: DataFrame, as_of: AsOf = None, months: int = 24) -> DataFrame:
    """10.3 Items per topic and calendar month with the share within the topic."""
    recent = current_rows(content).where(named_topic() & (F.col("published_at") >= months_before(as_of, months)))
    groups = recent.groupBy("topic_name", F.month("published_at").cast("bigint").alias("month")).agg(
        F.date_format(F.min("published_at"), "MMMM").alias("month_name"), rows().alias("article_count")
    )
    return with_share(groups, "article_count", "pct_of_topic_total", ["topic_name"]).orderBy("topic_name", "month")


def ingest_lag(content: DataFrame, max_days: int = 365) -> DataFrame:
    """10.4 Items by days from publication to load."""
    lag = days_between(F.col("published_at"), F.col("ingest_date")).alias("days_to_ingest")
    counted = current_rows(content).groupBy("content_type", lag).agg(rows().alias("content_count"))
    return counted.where(F.col("days_to_ingest").between(0, max_days)).orderBy("content_type", "days_to_ingest")


def source_reliability(
    content: DataFrame, as_of: AsOf = None, days: int = 180, min_count: int = 10, limit: int = 30
) -> DataFrame:
    """10.5 Sites scored by consistency, topic coverage and freshness.

    Active days and topics are distinct counts over (site, day, topic) rows, not over raw rows.
    """
    recent = since_days(current_rows(content), as_of, days).where(F.col("news_site").isNotNull())
    fine = recent.groupBy("news_site", F.to_date("published_at").alias("day"), "topic_name").agg(rows().alias("n"))
    groups = fine.groupBy("news_site").agg(
        F.sum("n").alias("total_articles"),
        F.count_distinct("day").alias("active_days"),
        F.count_distinct("topic_name").alias("topics_covered"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
    ).where(F.col("total_articles") >= min_count)
    span = days_between(F.col("first_day"), F.col("last_day")) + 1
    measured = groups.withColumns(
        {
            "consistency_pct": rounded_ratio(F.col("active_days"), span, 2, scale=100),
            "days_since_last": days_between(F.col("last_day"), as_date(as_of)),
        }
    )
    score = reliability_score(F.col("consistency_pct"), F.col("topics_covered"), F.col("days_since_last"))
    return measured.select(
        "news_site", "total_articles", "active_days", "topics_covered", "consistency_pct", "days_since_last",
        score.alias("reliability_score"),
    ).orderBy(F.desc("reliability_score"), "news_site").limit(limit)
