"""Retention by day since registration: overall, by monthly cohort, and for a registration range.

Inputs are epoch seconds: registrations ``(uid, reg_ts)`` and sessions ``(uid, auth_ts)``.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import (
    DAY_SECONDS,
    epoch_to_timestamp,
    month_of,
    ratio,
    round2_even,
    whole_days_from_seconds,
    year_month_text,
)


def epoch_of(day: date) -> int:
    return int(datetime(day.year, day.month, day.day, tzinfo=timezone.utc).timestamp())


def _session_days(sessions: DataFrame) -> DataFrame:
    """First and last session of each user on each calendar day.

    Enough to know the day numbers of that calendar day for any registration time: within 24
    hours the day number takes at most two values, one at each end. So raw sessions are combined
    on the map side and never meet the join, however many of them one user has.
    """
    return (
        sessions.filter(F.col("uid").isNotNull() & F.col("auth_ts").isNotNull())
        .groupBy("uid", F.floor(F.col("auth_ts") / DAY_SECONDS).alias("calendar_day"))
        .agg(F.min("auth_ts").alias("first_auth"), F.max("auth_ts").alias("last_auth"))
    )


def user_day_numbers(registrations: DataFrame, sessions: DataFrame, horizon: int | None = None) -> DataFrame:
    """``(uid, reg_ts, day_number)`` with ``0 <= day_number <= horizon``; a row may occur twice.

    Sessions without a registration have no day number and are left out.
    """
    registered = registrations.filter(F.col("reg_ts").isNotNull()).select("uid", "reg_ts").distinct()
    day_of_first = whole_days_from_seconds(F.col("first_auth") - F.col("reg_ts"))
    day_of_last = whole_days_from_seconds(F.col("last_auth") - F.col("reg_ts"))
    numbered = (
        _session_days(sessions)
        .join(registered, "uid")
        .select("uid", "reg_ts", F.explode(F.array_distinct(F.array(day_of_first, day_of_last))).alias("day_number"))
        .filter(F.col("day_number") >= 0)
    )
    if horizon is not None:
        numbered = numbered.filter(F.col("day_number") <= horizon)
    return numbered


def _distinct_users(numbered: DataFrame, *keys: str) -> DataFrame:
    """Users per key: one distinct on user and key, then a plain count."""
    return numbered.select("uid", *keys).distinct().groupBy(*keys).agg(F.count("uid").alias("unique_id"))


def retention_overall(registrations: DataFrame, sessions: DataFrame, rows: int = 30) -> DataFrame:
    """The first ``rows`` day numbers that occur: users and their share of the day-0 users, in
    percent."""
    per_day = _distinct_users(user_day_numbers(registrations, sessions), "day_number")
    head = per_day.orderBy("day_number").limit(rows)
    # At most ``rows`` rows are left, so a window over all of them is small.
    everything = Window.partitionBy(F.lit(0))
    base = F.max(F.when(F.col("day_number") == 0, F.col("unique_id"))).over(everything)
    return head.select(
        "day_number", "unique_id", round2_even(ratio(F.col("unique_id"), base) * 100).alias("retention")
    )


def _shares(numbered: DataFrame, cohort: Column) -> DataFrame:
    per_cohort = _distinct_users(numbered.withColumn("cohort", cohort), "cohort", "day_number")
    # One row per day number and cohort: small however many users a cohort has.
    base = F.max(F.when(F.col("day_number") == 0, F.col("unique_id"))).over(Window.partitionBy("cohort"))
    return per_cohort.select(
        "cohort", "day_number", "unique_id", ratio(F.col("unique_id"), base).alias("share")
    )


def retention_cohorts(
    registrations: DataFrame, sessions: DataFrame, horizon: int = 14, first_cohort: date | None = None
) -> DataFrame:
    """``(cohort, day_number, unique_id, share)`` by month of registration, shares of day 0.

    ``first_cohort`` keeps cohorts from that month on.
    """
    if first_cohort is not None:
        registrations = registrations.filter(F.col("reg_ts") >= epoch_of(first_cohort.replace(day=1)))
    numbered = user_day_numbers(registrations, sessions, horizon)
    return _shares(numbered, month_of(epoch_to_timestamp("reg_ts")))


def retention_range(
    registrations: DataFrame,
    sessions: DataFrame,
    horizon: int,
    registered_from: date,
    registered_to: date,
    inclusive_instant: bool = False,
    label_separator: str = "-",
) -> DataFrame:
    """Cohort retention for users registered in a range, with ``yyyy-MM`` labels.

    By default ``registered_to`` is the first day after the range. With ``inclusive_instant`` a
    registration in the very second ``registered_to 00:00:00`` still counts.

    Only sessions that can fall inside the horizon are read from storage.
    """
    low, high = epoch_of(registered_from), epoch_of(registered_to)
    reg_ts, auth_ts = F.col("reg_ts"), F.col("auth_ts")
    in_range = (reg_ts >= low) & (reg_ts <= high if inclusive_instant else reg_ts < high)
    reachable = (auth_ts >= low) & (auth_ts <= high + (horizon + 1) * DAY_SECONDS)
    numbered = user_day_numbers(registrations.filter(in_range), sessions.filter(reachable), horizon)
    return _shares(numbered, year_month_text(epoch_to_timestamp("reg_ts"), label_separator))


def retention_matrix(long: DataFrame, horizon: int = 14) -> DataFrame:
    """Cohort rows by day columns ``day_0 .. day_<horizon>``. The columns are known, so the pivot
    starts no job of its own."""
    days = list(range(horizon + 1))
    wide = long.groupBy("cohort").pivot("day_number", days).agg(F.first("share"))
    return wide.select("cohort", *[F.col(str(d)).alias(f"day_{d}") for d in days])
