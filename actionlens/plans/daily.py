"""Daily KPI reports: the whole app, and the feed alone.

The one-day report and the trailing series are the same plan over a different span of days.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    ACTION_LIKE,
    ACTION_MESSAGE,
    ACTION_VIEW,
    day_of,
    elapsed_seconds,
    floor2,
    ratio,
)
from ..operators.first_seen import first_seen, with_first_seen


def midnight(day: date) -> Column:
    """Start of a day as a constant that no time zone touches."""
    return F.lit(day).cast("timestamp_ntz")


def in_days(column: str, first: date, last: date) -> Column:
    """``first <= day(column) <= last`` as a range on the raw timestamp, which reaches the Parquet
    scan; a condition on the derived day would not."""
    return (F.col(column) >= midnight(first)) & (F.col(column) < midnight(last + timedelta(days=1)))


def report_span(as_of: date, days: int) -> tuple[date, date]:
    """The ``days`` complete days before ``as_of``; yesterday is the last one."""
    return as_of - timedelta(days=days), as_of - timedelta(days=1)


def _per_user_day(actions: DataFrame) -> DataFrame:
    """One row per user and day. With it, daily users are a plain count: no distinct, no expand."""
    is_action = F.col("action")
    return actions.groupBy("user_id", day_of("time").alias("date")).agg(
        F.count("action").alias("n"),
        F.count_if(is_action == ACTION_VIEW).alias("views"),
        F.count_if(is_action == ACTION_LIKE).alias("likes"),
        F.count_if(is_action == ACTION_MESSAGE).alias("messages"),
    )


def app_series(
    actions: DataFrame,
    as_of: date,
    days: int = 7,
    known_first_seen: DataFrame | None = None,
) -> DataFrame:
    """App KPIs for the ``days`` days before ``as_of``.

    ``actions`` is the union of feed and messages over all history: a user is new on the day of
    the first action ever, not of the first one in the span. Pass the maintained first-seen table
    to read only the report days.

    New users are counted from first-seen alone and joined by day, so users are never joined.
    """
    first, last = report_span(as_of, days)
    in_span = actions.filter(in_days("time", first, last))
    users = known_first_seen if known_first_seen is not None else first_seen(actions)
    new_users = (
        users.filter(in_days("first_time", first, last))
        .groupBy(day_of("first_time").alias("date"))
        .agg(F.count("user_id").alias("new_users"))
    )
    per_day = (
        _per_user_day(in_span)
        .groupBy("date")
        .agg(
            F.count("user_id").alias("dau"),
            F.sum("n").alias("actions"),
            F.sum("views").alias("views"),
            F.sum("likes").alias("likes"),
            F.sum("messages").alias("messages"),
        )
    )
    return per_day.join(new_users, "date", "left").select(
        "date",
        "dau",
        F.coalesce("new_users", F.lit(0)).cast("long").alias("new_users"),
        "actions",
        floor2(ratio("actions", "dau")).alias("mean_user_actions"),
        floor2(ratio("views", "dau")).alias("mean_user_views"),
        floor2(ratio("likes", "dau")).alias("mean_user_likes"),
        floor2(ratio("messages", "dau")).alias("mean_user_messages"),
    )


def app_report(actions: DataFrame, as_of: date, known_first_seen: DataFrame | None = None) -> DataFrame:
    """App KPIs for yesterday; no row when yesterday has no action."""
    return app_series(actions, as_of, 1, known_first_seen)


def label_new(actions: DataFrame) -> DataFrame:
    """Every action with ``new`` (made in the user's first second) or ``old``.

    Row-level form of the new-user rule, for drill-down and as the definition that ``app_series``
    is tested against.
    """
    return (
        with_first_seen(actions)
        .withColumn("distance", elapsed_seconds("first_time", "time"))
        .withColumn("category", F.when(F.col("distance") == 0, "new").otherwise("old"))
        .select("user_id", "time", "action", "distance", "category")
    )


def feed_series(feed: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Feed KPIs for the ``days`` days before ``as_of``. The rate is in percent, cut to two
    decimals after scaling; it is NULL on a day without views."""
    first, last = report_span(as_of, days)
    per_day = (
        _per_user_day(feed.filter(in_days("time", first, last)))
        .groupBy("date")
        .agg(
            F.count("user_id").alias("dau"),
            F.sum("views").alias("view"),
            F.sum("likes").alias("like"),
            F.sum(F.when(F.col("user_id").isNotNull(), F.col("views"))).alias("known_views"),
            F.sum(F.when(F.col("user_id").isNotNull(), F.col("likes"))).alias("known_likes"),
        )
    )
    return per_day.select(
        "date", "dau", "view", "like", floor2(ratio("known_likes", "known_views") * 100).alias("ctr")
    )


def feed_report(feed: DataFrame, as_of: date) -> DataFrame:
    """Feed KPIs for yesterday."""
    return feed_series(feed, as_of, 1)


def app_report_text(report: DataFrame) -> DataFrame:
    """``(date, message)``: the app report as the text that is sent to its readers."""
    message = F.format_string(
        "App report for %s\nDaily audience: %d\nNew users: %d\nAll actions: %d\n"
        "Actions per user: %.2f\nViews per user: %.2f\nLikes per user: %.2f\nMessages per user: %.2f",
        F.col("date").cast("string"),
        "dau",
        "new_users",
        "actions",
        "mean_user_actions",
        "mean_user_views",
        "mean_user_likes",
        "mean_user_messages",
    )
    return report.select("date", message.alias("message"))


def feed_report_text(report: DataFrame) -> DataFrame:
    """``(date, message)``: the feed report as text."""
    message = F.format_string(
        "Feed report for %s\ndau - %d\nview - %d\nlike - %d\nctr - %.2f%%",
        F.col("date").cast("string"),
        "dau",
        "view",
        "like",
        "ctr",
    )
    return report.select("date", message.alias("message"))
