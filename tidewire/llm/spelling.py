"""Spelling variants of words, by permuterm rotations.

Each word ends in a terminator, and all rotations of the marked word are listed: for every cut of a word into a and b the
rotation b$a. Words that differ in one code point share a prefix of their rotations. If a replacement turns a-x-b into
a-y-b, the rotations b$a-x and b$a-y differ in their last code point only; if a deletion turns a-x-b into a-b, the
rotation b$a is b$a-x without its last code point. So a rotation is filed under the prefix that skips its last code point,
and whole (with nothing skipped) under itself. The list is dealt by ranges of the prefix and sorted; entries of one
prefix then stand together, and each is told its neighbours in that group.

A group has one whole rotation at most and one entry for each letter of the alphabet, however frequent its words are, so
no group grows with the data. A word inside a run of equal letters may lose any of them: only the first counts, so that a
pair of words meets once.

A word has as many rotations as code points, each as long as the word, however long it is.

Null texts have no words. A null id counts as '' in the hash. Repeated rows count as often as they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialized
from .words import bound, bounded

LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
END = "$"


def without_letter(run: Column, key: Column, one_in: int) -> Column:
    """The run, or, where its hash with the key is divisible by ``one_in``, the run without one code point."""

    def changed(h: Column) -> Column:
        at = (h % F.length(run)).cast("int")
        cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
        return F.when(h % one_in == 0, cut).otherwise(run)

    return bound(F.crc32(F.concat(key, F.lit(":"), run).cast("binary")), changed)


def word_counts(
    docs: DataFrame, *, min_length: int = 7, min_count: int = 2, one_in: int | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(word, n): lower-cased runs of letters of at least ``min_length`` code points and ``min_count`` occurrences.

    With ``one_in`` that share of the runs loses a code point first.
    """
    lowered = F.translate(F.col(text), UPPER, LOWER)
    runs = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"),
        F.explode(F.regexp_extract_all(lowered, F.lit(f"{LETTERS}{{{min_length},}}"), 0)).alias("run"),
    )
    word = without_letter(F.col("run"), F.col("key"), one_in) if one_in else F.col("run")
    counted = runs.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter((F.col("n") >= min_count) & (F.length("word") >= min_length))


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, edited, n): every rotation without its last code point, which is ``edited``, and whole, with '' edited.

    The rotation that ends in the terminator has no form without it.
    """
    word, at = F.col("word"), F.col("at")
    length = F.length(word)
    cuts = words.select("word", "n", F.explode(F.sequence(F.lit(0), length)).alias("at"))
    head, tail = F.substring(word, F.lit(1), at), F.substring(word, at + 1, length)
    whole = F.struct(F.concat(tail, F.lit(END), head).alias("prefix"), F.lit("").alias("edited"))
    short = F.substring(word, F.lit(1), at - 1)
    skipped = F.struct(F.concat(tail, F.lit(END), short).alias("prefix"), F.substring(word, at, F.lit(1)).alias("edited"))
    return cuts.select("n", F.inline(F.when(at > 0, F.array(whole, skipped)).otherwise(F.array(whole))))


def neighbours(words: DataFrame, partitions: int | None = None) -> DataFrame:
    """(word, n_near, best): how many words differ from each by one code point, and the most frequent of them.

    ``best`` is (minus its count, word): the smallest one. Words without neighbours are left out.
    """
    n = partitions or int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    listed = rotations(words).repartitionByRange(n, "prefix").sortWithinPartitions("prefix", "edited")
    head, tail = F.substring_index("prefix", END, -1), F.substring_index("prefix", END, 1)
    whole = F.col("edited") == ""
    again = F.col("edited") == F.substring(head, -1, 1)  # not the first of a run of equal letters
    listed = listed.select(
        "prefix", "edited", F.concat(head, "edited", tail).alias("word"), whole.alias("whole"), (~whole & again).alias("again"),
        F.struct((-F.col("n")).alias("minus"), F.concat(head, "edited", tail).alias("word")).alias("own"),
    )
    group = Window.partitionBy("prefix").orderBy("edited")
    before, after = group.rowsBetween(Window.unboundedPreceding, -1), group.rowsBetween(1, Window.unboundedFollowing)
    letter = F.when(~F.col("whole"), F.col("own"))
    first = F.when(~F.col("whole") & ~F.col("again"), F.col("own"))
    base = F.when(F.col("whole"), F.col("own"))
    told = listed.select(
        "word",
        F.when(F.col("whole"), F.count(first).over(after))
        .otherwise(F.count(letter).over(before) + F.count(letter).over(after) + F.when(F.col("again"), 0).otherwise(F.count(base).over(before)))
        .alias("near"),
        F.when(F.col("whole"), F.min(first).over(after))
        .when(F.col("again"), F.least(F.min(letter).over(before), F.min(letter).over(after)))
        .otherwise(F.least(F.min("own").over(before), F.min(letter).over(after)))
        .alias("best"),
    )
    return told.filter("near > 0").groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: forms are followed until there is none.

    Each round doubles the steps taken. A form is more frequent than its word by ``ratio`` at least, so there are no
    circles, and rounds follow the logarithm of the logarithm of the largest count.
    """
    spark = forms.sparkSession
    roots = materialized(spark, forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = bounded(roots.toDF("root", "later"))
        further = roots.join(ahead, "root", "left")
        if further.filter("later IS NOT NULL").isEmpty():
            return roots
        roots = materialized(spark, further.select("word", F.coalesce("later", "root").alias("root")), "spelling-roots")


def spelling_groups(words: DataFrame, *, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per row of ``words`` (word, n), which are different and hold letters only.

    The form is the most frequent word that differs by one inserted, deleted or replaced code point, the first in
    code-point order of equally frequent ones, if it occurs at least ``ratio`` times as often; else null.
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word")
    spark = words.sparkSession
    words = materialized(spark, words.select("word", "n"), "spelling-words")
    found = words.join(neighbours(words), "word", "left")
    better = -F.col("best.minus") >= ratio * F.col("n")
    found = found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(better, F.col("best.word")).alias("form"), F.when(better, -F.col("best.minus")).alias("form_n"),
    )
    found = materialized(spark, found, "spelling-forms")
    roots = last_forms(found.filter("form IS NOT NULL"))
    return found.join(bounded(roots), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
