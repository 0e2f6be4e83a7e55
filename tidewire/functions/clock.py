"""Time: reference dates, calendar differences and timestamp parsing policies."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = dt.date | str | Column | None

TIMESTAMP_SHAPES = {
    # ISO date, or date and time with optional seconds, fraction and zone.
    "lenient": r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$",
    # Four accepted forms only; a fraction needs the Z.
    "strict": r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}:\d{2}(\.\d{1,6})?Z|T\d{2}:\d{2}:\d{2}|\s\d{2}:\d{2}:\d{2})$",
}


def as_date(as_of: AsOf) -> Column:
    """The report's 'today': a date, an ISO string, a column, or the session's current date."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(str(as_of)).cast("date")


def as_moment(now: dt.datetime | str | Column | None) -> Column:
    if now is None:
        return F.current_timestamp()
    if isinstance(now, Column):
        return now.cast("timestamp")
    return F.lit(str(now)).cast("timestamp")


def days_before(as_of: AsOf, days: int) -> Column:
    return F.date_sub(as_date(as_of), days)


def months_before(as_of: AsOf, months: int) -> Column:
    return F.add_months(as_date(as_of), -months)


def month_label(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM")


def month_start(moment: str) -> Column:
    """First day of the month: the cheap grouping key; format it as a label once rows are aggregated."""
    return F.trunc(moment, "month").alias("month_start")


def on_day(moment: Column, day: Column) -> Column:
    """Is the time on that day? A range on the bare column, which reaches the Parquet scan."""
    return (moment >= day.cast("timestamp")) & (moment < F.date_add(day, 1).cast("timestamp"))


def days_between(start: Column, end: Column) -> Column:
    """Calendar days crossed from start to end (23:00 to 01:00 is one day)."""
    return F.datediff(F.to_date(end), F.to_date(start)).cast("bigint")


def hours_between(start: Column, end: Column) -> Column:
    """Clock hours crossed from start to end."""
    seconds = F.unix_timestamp(F.date_trunc("hour", end)) - F.unix_timestamp(F.date_trunc("hour", start))
    return (seconds / 3600).cast("bigint")


def parse_timestamp(text: Column, policy: str = "lenient") -> Column:
    """Timestamp, or NULL where the text breaks the policy or names an impossible date.

    The shape test comes first because the engine's own cast also takes '2024' or '12:30'.
    """
    shape = TIMESTAMP_SHAPES[policy]
    return F.when(text.rlike(shape), F.try_to_timestamp(text))
