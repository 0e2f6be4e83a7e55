"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it and rereads it as the next one's documents.
All but the last return the columns of documents.

1. quality rules: documents that the base rules or a learnt cutoff rejects go;
2. line dedup: later lines that match an earlier one go, and documents that lose all their words that way;
3. MinHash near-dedup: of documents whose five-word shingles are alike by 0.8 or more, one stays;
4. mixing: sources are brought to target weights, by leaving out or repeating documents;
5. BPE: each document's ids, their number, and the hash of the text they decode to.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import bpe, lines, mixing, quality, setsketch
from tidewire.llm.queries import VOCABULARY, small_batches, table
from tidewire.llm.words import bounded, word_count
from tidewire.session import materialized


def carried(docs: DataFrame, *needed: str) -> DataFrame:
    """The needed columns, and all others in one column, so that no name among them meets one that an operator uses."""
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in needed]
    return docs.select(*needed, F.struct(F.lit(True).alias("row"), *others).alias("carried"))


def unpacked(frame: DataFrame, docs: DataFrame, *needed: str) -> DataFrame:
    """The columns of ``docs`` again, the needed ones as they are now."""
    return frame.select(*[F.col(c) if c in needed else F.col("carried")[f"c{i}"].alias(c) for i, c in enumerate(docs.columns)])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that neither the base rules nor a learnt cutoff rejects, as they are.

    Null and empty texts have no words and go; a null language is a stratum of its own; each of repeated rows is judged
    alike. Cutoffs are learnt from the labels of these documents.
    """
    needed = ("doc_id", "text", "lang")
    measured = quality.with_measures(carried(docs, *needed))
    cutoffs = quality.learn_cutoffs(measured, table(spark, sf_dir, "labels"))
    judged = quality.judge(measured, cutoffs, kept="quality_kept")
    return unpacked(judged.filter("quality_kept"), docs, *needed)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """n_chars follows the text. Documents whose text had words and has none left are dropped."""
    small_batches(spark)
    needed = ("doc_id", "text", "n_chars") if "n_chars" in docs.columns else ("doc_id", "text")
    left = lines.dedup_lines(carried(docs, *needed))
    changed = F.col("removed_lines").isNotNull()
    left = left.filter(~changed | (word_count(F.col("text")) > 0))
    if "n_chars" in needed:
        kind = docs.schema["n_chars"].dataType
        left = left.withColumn("n_chars", F.when(changed, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return unpacked(left, docs, *needed)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are known by id and text, so each text is judged by itself; the smallest id stays, null ids come last.

    Of repeated rows (same id or none, same text) with words one stays, by a hash of the other columns.
    """
    small_batches(spark)
    needed = ("doc_id", "text")
    number = F.lpad(F.hex(F.col("doc_id").cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")  # sorts as the ids do
    text = F.coalesce(F.md5(F.col("text").cast("binary")), F.lit(""))
    keyed = carried(docs, *needed).withColumn("near_key", F.concat(F.coalesce(number, F.lit("~")), text))
    marks = setsketch.near_duplicates(keyed, size=5, threshold=0.8, key="near_key")
    marks = marks.filter("n_shingles > 0").groupBy("near_key").agg(F.max("kept").alias("kept"), F.count("*").alias("rows"))
    special = materialized(spark, marks.filter("NOT kept OR rows > 1").select("near_key", "kept"), "near-special")
    once = keyed.join(bounded(special.select("near_key")), "near_key", "left_anti").select(*needed, "carried")
    again = keyed.join(bounded(special.filter("kept").select("near_key")), "near_key", "left_semi")
    one = F.min_by(F.struct(*needed, "carried"), F.xxhash64("carried"))
    return unpacked(once.unionByName(again.groupBy("near_key").agg(one.alias("row")).select("row.*")), docs, *needed)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document that the mix takes twice is there twice.

    A null source is a source; documents without words add nothing to a source and follow their place in it.
    """
    others = tuple(c for c in docs.columns if c not in ("doc_id", "source"))
    renamed = docs.select("doc_id", "source", *[F.col(c).alias(f"mixed_{c}") for c in others])
    mixed = mixing.mix(renamed, word_count(F.col("mixed_text")), keep=tuple(f"mixed_{c}" for c in others))
    repeated = mixed.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(*[F.col(f"mixed_{c}").alias(c) if c in others else F.col(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, and the hash of the text that they decode to.

    Null and empty texts have no ids and decode to the empty string; each of repeated rows is encoded.
    """
    small_batches(spark)
    file = public_tokenizers.path(VOCABULARY)
    ids = bpe.encode_documents(docs.select("doc_id", "source", "text"), file)
    decoded = bpe.decode_documents(ids, file)
    return decoded.select(
        "doc_id", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", keep_good),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialized(spark, stage(spark, docs, sf_dir), f"pipeline-{name.split()[0].lower()}")
    return docs


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
