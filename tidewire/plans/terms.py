"""Reports 5: entities and keywords.

Lists are read whole. Items are made
distinct inside their row, so "distinct rows per item" is a plain count and no row keys are
shuffled. Partial aggregation folds a word that sits in every document into one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions.measures import named_topic
from tidewire.functions.text import split_list
from tidewire.operators.content import exploded_items
from tidewire.plans.volume import current_rows, rows


def top_entities(content: DataFrame, limit: int = 50) -> DataFrame:
    """5.1 Entities by rows that mention them, with types and topics."""
    items = exploded_items(current_rows(content), "entities", "entity", ["content_type", "topic_name"])
    fine = items.groupBy("entity", "content_type", "topic_name").agg(rows().alias("n"))
    return fine.groupBy("entity").agg(
        F.sum("n").alias("mention_count"),
        F.count_distinct("content_type").alias("content_types_count"),
        F.count_distinct("topic_name").alias("topics_count"),
    ).orderBy(F.desc("mention_count"), "entity").limit(limit)


def top_keywords(content: DataFrame, limit: int = 100) -> DataFrame:
    """5.2 Keywords by rows that use them, with the number of topics."""
    items = exploded_items(current_rows(content), "keywords", "keyword", ["topic_name"])
    fine = items.groupBy("keyword", "topic_name").agg(rows().alias("n"))
    return fine.groupBy("keyword").agg(
        F.sum("n").alias("frequency"), F.count("topic_name").alias("topics_used_in")
    ).orderBy(F.desc("frequency"), "keyword").limit(limit)


def keywords_by_topic(content: DataFrame, min_count: int = 5) -> DataFrame:
    """5.3 Uses of a keyword within a topic; repeated uses in one row all count."""
    named = current_rows(content).where(named_topic())
    items = exploded_items(named, "keywords", "keyword", ["topic_name"], distinct=False)
    groups = items.groupBy("topic_name", "keyword").agg(rows().alias("frequency"))
    return groups.where(F.col("frequency") >= min_count).orderBy("topic_name", F.desc("frequency"), "keyword")


def entity_pairs(
    content: DataFrame, min_count: int = 5, limit: int = 100, canonical: bool = False,
    min_length: int = 3,
) -> DataFrame:
    """5.4 Entities named together in a row.

    Pairs are built inside the row from its entity list, which the dictionary bounds (24 names
    by default). With ``canonical`` each pair is put in name order.
    """
    long_enough = F.filter(split_list(F.col("entities")), lambda name: F.length(name) >= min_length)
    listed = current_rows(content).where(F.col("entities").isNotNull()).select(
        F.array_distinct(long_enough).alias("names")
    )
    if canonical:
        listed = listed.select(F.array_sort("names").alias("names"))
    firsts = listed.select("names", F.posexplode("names").alias("at", "entity1"))
    partners = firsts.select("entity1", F.explode(F.slice("names", F.col("at") + 2, F.size("names"))).alias("entity2"))
    groups = partners.groupBy("entity1", "entity2").agg(rows().alias("co_occurrences"))
    return groups.where(F.col("co_occurrences") >= min_count).orderBy(
        F.desc("co_occurrences"), "entity1", "entity2"
    ).limit(limit)
