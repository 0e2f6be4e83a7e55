"""One-permutation MinHash fingerprints, native throughout.

Each shingle of five words is hashed once, to 64 bits; the top bits name one of 128 bins and each bin keeps its smallest
hash. An empty bin takes the value of the full bin that comes first in a random order of its own (optimal
densification), so equal sets fill empty bins equally. The low 8 bits of each bin are packed, as two hex digits a bin.
Two fingerprints that agree in a share p of bins are alike by (p - 1/256) / (1 - 1/256): chance agreement of low bits is
taken off.

Texts of one to four words are a single shingle. Null, empty and blank texts have the empty fingerprint, which is wholly
like another empty one and unlike all others. Words are compared as they are written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .words import bound, word_array

SHINGLE = 5
BIN_BITS, LOW_BITS = 7, 8
BINS = 1 << BIN_BITS
SHIFT = 64 - BIN_BITS
LARGEST = (1 << SHIFT) - 1
BUCKETS_PER_TASK = 4


def shingle_hashes(words: Column) -> Column:
    return (
        F.when(F.size(words) >= SHINGLE, F.transform(
            F.sequence(F.lit(0), F.size(words) - SHINGLE),
            lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]),
        ))
        .when(F.size(words) > 0, F.array(F.xxhash64(words)))
        .otherwise(F.array().cast("array<bigint>"))
    )


def _bins(hashes: Column) -> Column:
    """The smallest hash of each bin, in bin order; the bin's largest possible value where it has none.

    That value is added once for each bin; after sorting, the first of each bin is its smallest.
    """
    fillers = F.array(*[F.lit((((b + 1) << SHIFT) - 1)) for b in range(-BINS // 2, BINS // 2)])
    return bound(F.sort_array(F.concat(hashes, fillers)), lambda s: F.filter(
        s, lambda x, i: (i == 0) | (F.shiftright(x, SHIFT) != F.shiftright(F.get(s, i - 1), SHIFT))
    ))


def _full(x: Column) -> Column:
    return x.bitwiseAND(F.lit(LARGEST)) != LARGEST


def fingerprint(text: Column) -> Column:
    """The packed fingerprint of a text, 256 hex digits, or the empty string."""

    def packed(bins: Column) -> Column:
        full = F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda j: _full(F.get(bins, j)))

        def donor(full: Column, b: Column) -> Column:
            order = F.transform(full, lambda j: F.xxhash64(b, j).bitwiseAND(F.lit(-BINS)).bitwiseOR(j.cast("long")))
            return F.get(bins, F.array_min(order).bitwiseAND(F.lit(BINS - 1)).cast("int"))

        low = bound(full, lambda f: F.transform(bins, lambda x, b: F.lpad(
            F.hex(F.when(_full(x), x).otherwise(donor(f, b)).bitwiseAND(F.lit((1 << LOW_BITS) - 1))), 2, "0"
        )))
        return F.array_join(low, "")

    return bound(word_array(text), lambda w: F.when(F.size(w) == 0, F.lit("")).otherwise(
        bound(_bins(shingle_hashes(w)), packed)
    ))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints, 0 to 1."""
    agree = F.size(F.filter(
        F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.substr(a, 2 * i + 1, F.lit(2)) == F.substr(b, 2 * i + 1, F.lit(2))
    ))
    chance = 2.0**-LOW_BITS
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(
        F.greatest(F.lit(0.0), (agree / BINS - chance) / (1 - chance))
    )


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def beside_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(bucket, copy, key, tie, text, next_text): each text with the one after it in key order, the last with the first.

    Keys are cut into ranges of about as many rows. Each range also gets a copy of the first row of the next one, so a
    row finds its successor inside its range. Rows with equal keys are ordered by a hash of their text; null keys come
    last. Rows where ``copy`` is true only serve their range and are to be dropped in the end.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = tasks(spark) * BUCKETS_PER_TASK
    cuts = docs.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 100 * n)).first()[0] or []
    cut_array = F.array(*[F.lit(int(c)) for c in sorted(set(cuts))]).cast("array<bigint>")
    bucket = F.when(F.col(key).isNull(), len(cuts) + 1).otherwise(
        F.size(F.filter(cut_array, lambda c: c <= F.col(key)))
    )
    firsts = sorted(docs.select(F.col(key)).groupBy(bucket.alias("bucket")).agg(F.min(key)).collect())  # a row per range
    size = len(cuts) + 2
    first, before = [None] * size, [0] * size
    for i, (b, smallest) in enumerate(firsts):
        first[b], before[b] = smallest, firsts[i - 1][0]
    opens = F.get(F.array(*[F.lit(x) for x in first]).cast("array<bigint>"), F.col("home")).eqNullSafe(F.col(key))
    own = F.struct(F.col("home").alias("bucket"), F.lit(False).alias("copy"))
    lent = F.struct(F.get(F.array(*[F.lit(x) for x in before]), F.col("home")).alias("bucket"), F.lit(True).alias("copy"))
    dealt = rows.withColumn("home", bucket).select(
        key, "text", F.xxhash64("text").alias("tie"), F.explode(F.when(opens, F.array(own, lent)).otherwise(F.array(own))).alias("to")
    ).select("to.*", key, "tie", "text")
    return dealt.repartition(tasks(spark), "bucket").withColumn("next_text", F.lead("text").over(key_order(key)))


def key_order(key: str):
    return Window.partitionBy("bucket").orderBy("copy", F.col(key).asc_nulls_last(), "tie")


def compare_edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness; one shuffle of the texts.

    The edited form has the last half replaced by the beginning of the next document, as many code points or all.
    """
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(
        F.substr("text", F.lit(1), F.char_length("text") - half), F.substr(F.coalesce("next_text", F.lit("")), F.lit(1), half)
    )
    marked = beside_next(docs, key, text).select(
        "bucket", "copy", key, "tie", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(edited.cast("binary"), 256).alias("edited_sha256"), fingerprint(F.col("text")).alias("fingerprint"),
        F.when(~F.col("copy"), fingerprint(edited)).alias("edited_fingerprint"),
    )
    return marked.withColumn("next_fingerprint", F.lead("fingerprint").over(key_order(key))).filter("NOT copy").select(
        key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
