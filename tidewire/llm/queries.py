"""One query per operator, over its whole table, and SQL for the same rows where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, fingerprints, lines, mixing, ngrams, overlap, pii, quality, setsketch, spelling, urls, warc
from .words import word_count

VOCABULARY = "word_bpe_49k.json"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Python workers get few rows at a time, as texts may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), word_count(F.col("text")))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken")
    )


def op2_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    return ngrams.katz_scores(documents, ~held_out, order=3).withColumn("held_out", ~F.col("train")).drop("train")


def op3_filter_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label of a page is that of the document whose number its path carries: bad if of low quality or toxic."""
    pages, labels = table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels")
    bad = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    number = F.expr("try_cast(regexp_extract(url, '://[^/?#]*/[a-z]+/([0-9]+)', 1) AS BIGINT)")
    labelled = pages.select("url", number.alias("doc_id")).filter("doc_id IS NOT NULL").join(bad, "doc_id")
    return urls.filter_urls(pages, labelled, URL_RULES)


def op4_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return bpe.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    back = warc.archive_round_trip(table(spark, sf_dir, "pages"), payload=F.col("html"))
    return back.withColumnRenamed("record_id", "page_id")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return pii.span_report(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    measured = quality.with_measures(documents).drop("text")
    cutoffs = quality.learn_cutoffs(measured, table(spark, sf_dir, "labels"))
    m = F.col(quality.MEASURES)
    return quality.judge(measured, cutoffs).select(
        "doc_id", m["n_words"].alias("n_words"), m["word_chars"].alias("word_chars"), m["n_symbols"].alias("n_symbols"),
        m["lines"]["again"].alias("n_dup_lines"), m["n_repeat_words"].alias("n_repeat_words"),
        quality.base_failed(m).alias("base_failed"), "kept",
    )


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), size=2, threshold=0.8)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, the numbers of those removed, and the hash of the text that is left."""
    small_batches(spark)
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines")
    left = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text", n_lines))
    gone = F.coalesce("removed_lines", F.array().cast("array<int>"))
    return left.select(
        "doc_id", "n_lines",
        F.size(gone).cast("long").alias("n_removed"), F.array_join(gone.cast("array<string>"), ",").alias("removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("left_sha256"),
    )


def op11_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return alignment.align(
        table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES)
    )


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return overlap.similarity_classes(table(spark, sf_dir, "documents"), size=5, threshold=0.8)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One in 31 runs of letters, by hash, loses a code point."""
    return spelling.spelling_groups(spelling.word_counts(table(spark, sf_dir, "documents"), one_in=31))


QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_katz_scores, op3_filter_urls, op4_encode, op5_warc_round_trip, op6_fingerprints,
        op7_personal_data, op8_quality_rules, op9_near_duplicates, op10_line_dedup, op11_align_tokens, op12_ngram_join, op13_spelling_variants,
    )
}

SQL: dict[str, str] = {
    "op1_mix_sources": r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS position
    FROM documents
),
ranked AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE
               ELSE 2.0::DOUBLE END AS weight
    FROM sized GROUP BY source
),
levels AS (  -- from the source that a cap meets first
    SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS budget,
           coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0) AS capped, sum(weight) OVER from_here AS weights
    FROM ranked
    WINDOW before AS (ORDER BY source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           from_here AS (ORDER BY source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
),
marked AS (
    SELECT *, (budget - capped) * weight / weights > 2.0::DOUBLE * source_size AS at_cap FROM levels
),
aimed AS (
    SELECT source, source_size,
           CASE WHEN at_cap THEN 2.0::DOUBLE * source_size
                ELSE (budget - coalesce(sum(2.0::DOUBLE * source_size) FILTER (WHERE at_cap) OVER (), 0)) * weight
                    / sum(weight) FILTER (WHERE NOT at_cap) OVER () END AS target
    FROM marked
),
line AS (
    SELECT source, position, sum(size) AS words,
           sum(sum(size)) OVER (PARTITION BY source ORDER BY position) AS upto
    FROM sized GROUP BY source, position
)
SELECT d.doc_id, d.size, a.source_size, a.target,
       (d.size * list_sum(list_transform([0, 1], lambda j:
           CASE WHEN a.target - j * a.source_size <= 0 THEN 0
                WHEN l.upto <= a.target - j * a.source_size THEN 1
                WHEN l.upto - l.words <= a.target - j * a.source_size
                     AND (a.target - j * a.source_size - (l.upto - l.words)) * 2 >= l.words THEN 1
                ELSE 0 END)))::BIGINT AS taken
FROM sized d
JOIN aimed a ON d.source IS NOT DISTINCT FROM a.source
JOIN line l ON d.source IS NOT DISTINCT FROM l.source AND d.position = l.position
""",
}
