"""Column -> Column helpers. All are native expressions and stay inside whole-stage codegen.

Event times are ``timestamp_ntz``: the logs carry wall-clock UTC without a zone, and NTZ
arithmetic does not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Action labels counted by the reports.
ACTION_VIEW = "view"
ACTION_LIKE = "like"
ACTION_MESSAGE = "mess"

# Slot length and day length in seconds.
SLOT_SECONDS = 900
DAY_SECONDS = 86_400

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of(time: Column | str) -> Column:
    """Calendar day of a timestamp."""
    return F.to_date(as_column(time))


def slot_seconds_of(time: Column | str) -> Column:
    """Offset of the 15-minute bucket from midnight, in seconds (0, 900, ..., 85500)."""
    time = as_column(time)
    seconds = F.hour(time) * 3600 + F.minute(time) * 60
    return (seconds - seconds % SLOT_SECONDS).cast("long")


def slot_start(day: Column | str, slot: Column | str) -> Column:
    """Start of the 15-minute bucket from its day and its offset."""
    midnight = as_column(day).cast("timestamp_ntz")
    return F.timestamp_add("SECOND", as_column(slot), midnight)


def elapsed_seconds(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from ``start`` to ``end``; both are cut to the second first, so that
    sub-second parts neither hide nor create a second."""
    return timestamp_to_epoch(end) - timestamp_to_epoch(start)


def timestamp_to_epoch(time: Column | str) -> Column:
    """Seconds since 1970, rounded down. Built from the calendar fields, for the timestamp
    difference of Spark goes through the session time zone."""
    time = as_column(time)
    of_day = F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)
    return F.unix_date(F.to_date(time)).cast("long") * DAY_SECONDS + of_day


def epoch_to_timestamp(seconds: Column | str) -> Column:
    """Epoch seconds to a zone-free timestamp."""
    return F.timestamp_add("SECOND", as_column(seconds), F.expr(EPOCH))


def whole_days_from_seconds(seconds: Column | str) -> Column:
    """Complete days in a signed number of seconds, rounded towards minus infinity:
    one second before the start is day -1, not day 0."""
    return F.floor(as_column(seconds) / DAY_SECONDS)


def whole_days(start: Column | str, end: Column | str) -> Column:
    """Complete days from ``start`` to ``end`` (both timestamps), rounded down."""
    return whole_days_from_seconds(elapsed_seconds(start, end))


def month_of(time: Column | str) -> Column:
    """First day of the month."""
    return F.trunc(F.to_date(as_column(time)), "MM")


def year_month_text(time: Column | str, separator: str = "-") -> Column:
    """Cohort label such as ``2020-01``."""
    text = F.substring(F.to_date(as_column(time)).cast("string"), 1, 7)
    return text if separator == "-" else F.replace(text, F.lit("-"), F.lit(separator))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that yields NULL for a zero denominator. The one place where jobs divide by data."""
    return F.try_divide(as_column(numerator).cast("double"), as_column(denominator).cast("double"))


def floor2(c: Column | str) -> Column:
    """Cut to two decimals, downwards, as a double."""
    return F.floor(as_column(c) * 100).cast("double") / F.lit(100.0)


def round2_even(c: Column | str) -> Column:
    """Round to two decimals, ties to even after scaling."""
    return F.rint(as_column(c) * 100) / F.lit(100.0)


def percent_text(c: Column | str) -> Column:
    """``0.1234`` -> ``12.34%``."""
    return F.format_string("%.2f%%", as_column(c) * 100)
