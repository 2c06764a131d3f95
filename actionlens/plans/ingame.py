"""Metrics of a time-limited in-game event.

``exposed_users`` gives one row per user who saw the event; the metrics relate the user's later
actions to the first exposure. All of them take an optional ``segment`` column on that table and
then report each segment on its own.

Times are cut to the second, so that what one user does within a second counts once and the rows
of one user and day are bounded.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import (
    DAY_SECONDS,
    day_of,
    ratio,
    timestamp_to_epoch,
    whole_days_from_seconds,
)
from ..operators.passages import day_passages, step_counts
from ..operators.ranks import MAX_BROADCAST_ROWS
from ..session import cut_lineage
from .daily import in_days
from .retention import user_day_numbers

# Checked days after exposure, revenue horizons, and the pause that ends a session.
ACTIVITY_DAYS = (0, 1, 7, 14)
RETENTION_DAYS = (1, 7, 14)
REVENUE_HORIZONS = (30,)
SESSION_GAP_SECONDS = 1_800


def exposed_users(actions: DataFrame, exposure: Column, first_step: Column | None = None) -> DataFrame:
    """``(user_id, exposed_at, segment)``: the second of the first row that meets ``exposure``.

    With ``first_step``, ``segment`` is ``participant`` for users who took that step at or after
    the exposure and ``spectator`` for the others; without, it is ``all``. One aggregate per user.
    """
    at = timestamp_to_epoch("time")
    step = first_step if first_step is not None else F.lit(False)
    per_user = (
        actions.filter(F.col("user_id").isNotNull() & (exposure | step))
        .groupBy("user_id")
        .agg(F.min(F.when(exposure, at)).alias("exposed_at"), F.max(F.when(step, at)).alias("last_step"))
        .filter(F.col("exposed_at").isNotNull())
    )
    took_part = F.coalesce(F.col("last_step") >= F.col("exposed_at"), F.lit(False))
    segment = F.lit("all") if first_step is None else F.when(took_part, "participant").otherwise("spectator")
    return per_user.select("user_id", "exposed_at", segment.alias("segment"))


def reachable(
    actions: DataFrame,
    first_exposure: date,
    last_exposure: date,
    horizon: int,
    session_gap: int = SESSION_GAP_SECONDS,
) -> DataFrame:
    """Actions that matter within ``horizon`` days of an exposure between the two days: those on
    the days themselves, and those that end a pause begun there. The range reaches the scan, so a
    metric of a short event does not read the whole log."""
    last = last_exposure + timedelta(days=horizon + 1) + timedelta(days=-(-session_gap // DAY_SECONDS))
    return actions.filter(in_days("time", first_exposure, last))


def _per_segment_and_day(exposed: DataFrame, days: tuple[int, ...]) -> DataFrame:
    """Size of each segment, once per wanted day number, so that idle days are reported too."""
    return (
        exposed.groupBy("segment")
        .agg(F.count("user_id").alias("exposed"))
        .withColumn("day_number", F.explode(F.array(*[F.lit(d).cast("long") for d in days])))
    )


def exposed_seconds(actions: DataFrame, exposed: DataFrame) -> DataFrame:
    """``(user_id, second, exposed_at, segment)``: the seconds in which exposed users were active.

    Users who were not exposed go before anything is gathered. A few exposed users are sent to the actions;
    many are met by their distinct seconds, so that the rows of a user are bounded by time.
    """
    known = actions.filter(F.col("user_id").isNotNull() & F.col("time").isNotNull()).select("user_id", timestamp_to_epoch("time").alias("second"))
    exposed = cut_lineage(exposed.select("user_id", "exposed_at", "segment"))
    if exposed.count() <= MAX_BROADCAST_ROWS:
        return known.join(F.broadcast(exposed), "user_id").distinct()
    return known.distinct().join(exposed, "user_id")


def user_sessions(seconds: DataFrame, keys: list[str], second: Column, session_gap: int = SESSION_GAP_SECONDS) -> DataFrame:
    """``(*keys, session, first_second, last_second)``: stretches of seconds no more than ``session_gap`` apart, by a
    session window, on a table or on a stream. ``seconds`` are whole ones; on a stream ``second`` is the column with
    the watermark."""
    window = F.session_window(second, f"{session_gap * 1000 + 500} milliseconds")
    return seconds.groupBy(*keys, window.alias("session")).agg(F.min("second").alias("first_second"), F.max("second").alias("last_second"))


def event_activity_by_day(
    actions: DataFrame,
    exposed: DataFrame,
    days: tuple[int, ...] = ACTIVITY_DAYS,
    session_gap: int = SESSION_GAP_SECONDS,
) -> DataFrame:
    """Mean activity time per exposed user on the given days after exposure.

    Activity time is the sum of pauses of at most ``session_gap`` between a user's actions, booked
    on the day in which the pause starts. The denominator is everyone exposed.

    Sessions within a day since exposure hold its pauses; the pause that goes on into a later day is
    added to the day's last session.
    """
    day_number = whole_days_from_seconds(F.col("second") - F.col("exposed_at"))
    # The days asked for, and those in which a pause that begins there can end.
    last = max(days) + 1 + session_gap // DAY_SECONDS
    seconds = exposed_seconds(actions, exposed).withColumn("day_number", day_number).filter(F.col("day_number").between(min(days), last))
    keys = ["user_id", "segment", "day_number"]
    sessions = user_sessions(seconds.withColumn("instant", F.timestamp_seconds("second")), keys, F.col("instant"), session_gap)
    per_user = sessions.groupBy(*keys).agg(
        F.sum(F.col("last_second") - F.col("first_second")).alias("inside"),
        F.min("first_second").alias("first_second"),
        F.max("last_second").alias("last_second"),
    )
    # A row for each day of a user.
    pause = F.lead("first_second").over(Window.partitionBy("user_id", "segment").orderBy("day_number")) - F.col("last_second")
    per_day = (
        per_user.withColumn("over", F.when(pause <= session_gap, pause).otherwise(0))
        .filter(F.col("day_number").isin(*days))
        .groupBy("segment", "day_number")
        .agg(F.sum(F.col("inside") + F.col("over")).alias("seconds"))
    )
    return (
        _per_segment_and_day(exposed, days)
        .join(per_day, ["segment", "day_number"], "left")
        .withColumn("seconds", F.coalesce("seconds", F.lit(0)).cast("long"))
        .select("segment", "day_number", "exposed", "seconds", ratio("seconds", "exposed").alias("mean_seconds"))
    )


def event_retention(
    actions: DataFrame, exposed: DataFrame, days: tuple[int, ...] = RETENTION_DAYS
) -> DataFrame:
    """Share of exposed users who were active on the given days after exposure."""
    registrations = exposed.select(F.col("user_id").alias("uid"), F.col("exposed_at").alias("reg_ts"))
    sessions = actions.select(F.col("user_id").alias("uid"), timestamp_to_epoch("time").alias("auth_ts"))
    returned = (
        user_day_numbers(registrations, sessions, max(days))
        .filter(F.col("day_number").isin(*days))
        .select(F.col("uid").alias("user_id"), "day_number")
        .distinct()
        .join(exposed, "user_id")
        .groupBy("segment", "day_number")
        .agg(F.count("user_id").alias("returned"))
    )
    return (
        _per_segment_and_day(exposed, days)
        .join(returned, ["segment", "day_number"], "left")
        .withColumn("returned", F.coalesce("returned", F.lit(0)).cast("long"))
        .select("segment", "day_number", "exposed", "returned", ratio("returned", "exposed").alias("retention"))
    )


def event_revenue(
    payments: DataFrame, exposed: DataFrame, horizons: tuple[int, ...] = REVENUE_HORIZONS
) -> DataFrame:
    """Revenue per exposed user within ``horizons`` days from the exposure.

    Payments ``(user_id, time, amount)`` are summed per user and second before the join, so the
    rows of one user are bounded by time, not by the number of payments. Users who paid nothing
    stay in the join and make up the denominator.
    """
    paid = (
        payments.filter(F.col("user_id").isNotNull())
        .groupBy("user_id", timestamp_to_epoch("time").alias("second"))
        .agg(F.sum("amount").alias("amount"))
    )
    since = F.col("second") - F.col("exposed_at")
    within = [(since >= 0) & (since < d * DAY_SECONDS) for d in horizons]
    per_user = (
        exposed.join(paid, "user_id", "left")
        .groupBy("segment", "user_id")
        .agg(*[F.sum(F.when(w, F.col("amount"))).alias(f"revenue_{d}") for d, w in zip(horizons, within)])
    )
    totals = per_user.groupBy("segment").agg(
        F.count("user_id").alias("exposed"),
        *[F.sum(f"revenue_{d}").alias(f"revenue_{d}") for d in horizons],
        *[F.count(f"revenue_{d}").alias(f"payers_{d}") for d in horizons],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(d).cast("long").alias("horizon"),
                F.col(f"payers_{d}").alias("payers"),
                F.coalesce(F.col(f"revenue_{d}").cast("double"), F.lit(0.0)).alias("revenue"),
            )
            for d in horizons
        ]
    )
    return totals.select("segment", "exposed", F.inline(rows)).withColumn("ltv", ratio("revenue", "exposed"))


def reactivated_users(actions: DataFrame, gap_days: int) -> DataFrame:
    """``(date, reactivated)``: users who came back on a day after at least ``gap_days`` without an
    action. Works on one row per user and active day."""
    at = timestamp_to_epoch("time")
    per_day = (
        actions.filter(F.col("user_id").isNotNull())
        .groupBy("user_id", day_of("time").alias("date"))
        .agg(F.min(at).alias("first_action"), F.max(at).alias("last_action"))
    )
    before = F.lag("last_action").over(Window.partitionBy("user_id").orderBy("date"))
    return (
        per_day.withColumn("away", F.col("first_action") - before)
        .filter(F.col("away") >= gap_days * DAY_SECONDS)
        .groupBy("date")
        .agg(F.count("user_id").alias("reactivated"))
    )


def event_participation(exposed: DataFrame) -> DataFrame:
    """One row: exposed users, those who took the first step, and their share. ``exposed`` must be
    built with a first step."""
    return exposed.agg(
        F.count("user_id").alias("exposed"),
        F.count_if(F.col("segment") == "participant").alias("participants"),
    ).withColumn("share", ratio("participants", "exposed"))


def funnel_days(actions: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """``(user, day, passage)``: what each day of a user does to the funnel, to be stored and put together for any
    window of days."""
    return day_passages(actions, "user_id", day_of("time"), timestamp_to_epoch("time"), [condition for _, condition in steps])


def funnel_of_days(passages: DataFrame, steps: list[str]) -> DataFrame:
    """``(step_number, step, users, share_of_first, drop_off)`` of the days in ``passages``."""
    counted = step_counts(passages, len(steps))
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).cast("long").alias("step_number"),
                F.lit(name).alias("step"),
                F.col(f"n{i}").alias("users"),
                ratio(f"n{i}", "n0").alias("share_of_first"),
                (F.col(f"n{max(i - 1, 0)}") - F.col(f"n{i}")).alias("drop_off"),
            )
            for i, name in enumerate(steps)
        ]
    )
    return counted.select(F.inline(rows))


def event_funnel(actions: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """``(step_number, step, users, share_of_first, drop_off)`` for ordered steps.

    A user passes step k with the first row of that step at or after the second in which the user passed
    step k-1; what else happened in between does not matter. A user's seconds meet by day; then a row for each
    day of the user is enough, however many actions the user has.
    """
    return funnel_of_days(funnel_days(actions, steps), [name for name, _ in steps])


def choice_share(choices: DataFrame, column: str) -> DataFrame:
    """``(choice, n, share)`` of a chosen prize."""
    counts = (
        choices.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("choice"))
        .agg(F.count("*").alias("n"))
    )
    # The total comes from the same counts: one scan feeds both.
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("choice", "n", ratio(F.col("n"), total).alias("share"))


def event_churn(
    actions: DataFrame,
    participation: Column,
    earlier: tuple[date, date],
    current: tuple[date, date],
    following: tuple[date, date],
) -> DataFrame:
    """Participants of the ``current`` event who were not seen in the ``following`` period, those who
    took part in the ``earlier`` event (``veteran``) and the others (``newcomer``) apart.

    Taking part is a row that meets ``participation`` within the event's days; being seen is any row.
    Periods are first and last day, inclusive. One aggregate per user; nothing is joined.
    """
    took_part = F.coalesce(participation, F.lit(False))
    flags = {
        "earlier": in_days("time", *earlier) & took_part,
        "current": in_days("time", *current) & took_part,
        "following": in_days("time", *following),
    }
    needed = in_days("time", *earlier) | in_days("time", *current) | in_days("time", *following)
    per_user = (
        actions.filter(needed & F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(*[F.bool_or(condition).alias(name) for name, condition in flags.items()])
        .filter("current")
    )
    return (
        per_user.groupBy(F.when(F.col("earlier"), "veteran").otherwise("newcomer").alias("segment"))
        .agg(F.count("*").alias("users"), F.count_if(~F.col("following")).alias("churned"))
        .withColumn("churn", ratio("churned", "users"))
    )
