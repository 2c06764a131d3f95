"""Same-slot-of-day series of feed metrics in 15-minute buckets, and the anomaly verdict on it."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import (
    ACTION_LIKE,
    ACTION_VIEW,
    SLOT_SECONDS,
    day_of,
    percent_text,
    ratio,
    slot_seconds_of,
    slot_start,
)
from .daily import midnight

# Metrics that get a verdict, look-back, rolling window and band width.
CHECKED_METRICS = ("activ_users", "views", "likes", "ctr")
LOOKBACK_DAYS = 14
ROLLING_ROWS = 3
Z = 2.576


def bucket_metrics(feed: DataFrame) -> DataFrame:
    """All buckets of ``feed``: ``(time, day, slot, activ_users, actions, views, likes, ctr)``.

    Distinct users come from a first aggregate per bucket and user, which combines on the map
    side; a bucket or a user with very many rows is no hot spot.
    """
    known = F.col("user_id").isNotNull()
    per_user = feed.groupBy(
        day_of("time").alias("day"), slot_seconds_of("time").alias("slot"), "user_id"
    ).agg(
        F.count("action").alias("n"),
        F.count_if(known & (F.col("action") == ACTION_VIEW)).alias("views"),
        F.count_if(known & (F.col("action") == ACTION_LIKE)).alias("likes"),
    )
    per_bucket = per_user.groupBy("day", "slot").agg(
        F.count("user_id").alias("activ_users"),
        F.sum("n").alias("actions"),
        F.sum("views").alias("views"),
        F.sum("likes").alias("likes"),
    )
    return per_bucket.select(
        slot_start("day", "slot").alias("time"),
        "day",
        "slot",
        "activ_users",
        "actions",
        "views",
        "likes",
        ratio("likes", "views").alias("ctr"),
    )


def _anchor_time(feed: DataFrame):
    """Start of the bucket before the newest one, as a scalar subquery. The newest bucket is still
    filling."""
    newest = feed.agg(F.max("time").alias("t"))
    start = slot_start(day_of("t"), slot_seconds_of("t"))
    return newest.select(F.timestamp_add("SECOND", F.lit(-SLOT_SECONDS), start).alias("anchor"))


def slot_series(feed: DataFrame, as_of: date | None = None, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """The anchor's slot of day on each of the last ``lookback_days`` days up to ``as_of``.

    ``as_of`` defaults to the day of the anchor. Only buckets with actions appear. When the anchor
    bucket has none, there is no slot to follow and the result is empty.

    The anchor and its day arrive as scalar subqueries, so they prune the scan like literals; rows
    of the other 95 slots are dropped before the shuffle.
    """
    if as_of is not None:
        # Everything below, the search for the newest bucket included, needs these days only.
        start = midnight(as_of - timedelta(days=lookback_days - 1))
        feed = feed.filter((F.col("time") >= start) & (F.col("time") < midnight(as_of + timedelta(days=1))))
    anchor = _anchor_time(feed)
    if as_of is None:
        day = day_of("anchor")
        start = anchor.select(
            F.date_sub(day, lookback_days - 1).cast("timestamp_ntz").alias("start")
        ).scalar()
    # max() over the anchor bucket's rows: NULL, hence no match, when it holds none.
    anchor_end = anchor.select(F.timestamp_add("SECOND", F.lit(SLOT_SECONDS), "anchor")).scalar()
    anchor_slot = (
        feed.filter((F.col("time") >= anchor.scalar()) & (F.col("time") < anchor_end))
        .agg(F.max(slot_seconds_of("time")).alias("slot"))
        .scalar()
    )
    in_slot = feed.filter((F.col("time") >= start) & (slot_seconds_of("time") == anchor_slot))
    return bucket_metrics(in_slot).drop("day", "slot")


def long_form(series: DataFrame, keys: list[str], metrics: tuple[str, ...]) -> DataFrame:
    as_double = [F.col(m).cast("double").alias(m) for m in metrics]
    return series.select(*keys, *as_double).unpivot(keys, list(metrics), "metric", "value")


def add_bands(long: DataFrame, series_keys: list[str], z: float = Z, rows: int = ROLLING_ROWS) -> DataFrame:
    """Rolling mean, band and series mean for ``(*series_keys, time, value)``.

    One series is one metric at one slot of day: a row per day, so the windows are small whatever
    the volume of actions. The rolling mean includes the current row and needs ``rows`` values; of
    equal values it is that value, so that rounding does not move a flat series off its own band.
    """
    series = Window.partitionBy(*series_keys)
    rolling = series.orderBy("time").rowsBetween(1 - rows, 0)
    flat = F.min("value").over(rolling) == F.max("value").over(rolling)
    mean = F.when(flat, F.col("value")).otherwise(F.avg("value").over(rolling))
    return (
        long.withColumn("rolling_mean", F.when(F.count("value").over(rolling) == rows, mean))
        .withColumn("residual", F.col("rolling_mean") - F.col("value"))
        .withColumn("sigma", F.stddev_pop("residual").over(series))
        .withColumn("mean", F.avg("value").over(series))
        .withColumn("upper", F.col("rolling_mean") + F.col("sigma") * z)
        .withColumn("lower", F.col("rolling_mean") - F.col("sigma") * z)
    )


def add_verdict(banded: DataFrame) -> DataFrame:
    """``status`` (high, low, none) and the relative ``deviation``.

    Above the band the deviation is relative to the series mean; below, to the value itself.
    A NULL value or bound is no anomaly.
    """
    value, mean = F.col("value"), F.col("mean")
    status = (
        F.when(value > F.col("upper"), "high").when(value < F.col("lower"), "low").otherwise("none")
    )
    deviation = F.when(F.col("status") == "high", ratio(value - mean, mean)).when(
        F.col("status") == "low", ratio(mean - value, value)
    )
    return banded.withColumn("status", status).withColumn("deviation", deviation)


def slot_bands(
    feed: DataFrame, as_of: date | None = None, lookback_days: int = LOOKBACK_DAYS, z: float = Z
) -> DataFrame:
    """Bands and verdicts for every day of the slot series, all metrics in one job."""
    series = slot_series(feed, as_of, lookback_days)
    banded = add_bands(long_form(series, ["time"], CHECKED_METRICS), ["metric"], z)
    return add_verdict(banded)


def latest_per_series(verdicts: DataFrame, series_keys: list[str]) -> DataFrame:
    """The row at the newest time of each series."""
    newest = F.max("time").over(Window.partitionBy(*series_keys))
    return verdicts.withColumn("newest", newest).filter(F.col("time") == F.col("newest")).drop("newest")


def slot_anomalies(
    feed: DataFrame, as_of: date | None = None, lookback_days: int = LOOKBACK_DAYS, z: float = Z
) -> DataFrame:
    """One verdict per metric at the newest time of the slot series."""
    return latest_per_series(slot_bands(feed, as_of, lookback_days, z), ["metric"])


def all_slot_bands(feed: DataFrame, z: float = Z) -> DataFrame:
    """Bands and verdicts for all 96 slots of the day at once, over all days in ``feed``."""
    long = long_form(bucket_metrics(feed), ["slot", "time"], CHECKED_METRICS)
    return add_verdict(add_bands(long, ["metric", "slot"], z))


def alert_records(verdicts: DataFrame, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """``(metric, time, status, value, mean, deviation, message)`` for each checked metric."""
    found = F.format_string(
        "Anomaly found\nMetric: %s at %s\n%s the mean of the last "
        + str(lookback_days)
        + " days by: %s\nvalue now: %.2f\nmean: %.2f",
        "metric",
        F.col("time").cast("string"),
        F.when(F.col("status") == "high", "above").otherwise("below"),
        F.when(F.col("deviation").isNull(), "n/a").otherwise(percent_text("deviation")),
        "value",
        "mean",
    )
    quiet = F.format_string("metric %s: no anomaly", "metric")
    message = F.when(F.col("status") == "none", quiet).otherwise(found)
    return verdicts.select(
        "metric", "time", "status", "value", "mean", "deviation", message.alias("message")
    )
