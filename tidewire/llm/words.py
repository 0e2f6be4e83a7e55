"""Words, lines and small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
MAX_BROADCAST_ROWS = 200_000


def word_array(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def word_count(text: Column) -> Column:
    return F.size(word_array(text)).cast("long")


def bound(value: Column, body) -> Column:
    """``body(x)`` with x evaluated once per row, however often the body mentions it."""
    return F.transform(F.array(value), body)[0]


def bounded(df: DataFrame, rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """The frame with a broadcast hint if it has few rows, else as it is, to be joined by a shuffle.

    The frame must be cheap to count (a written table).
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
