"""The scheduled jobs: compute once, then store the series and the text made from it.

Each result is a handful of rows. It is stored before its two uses, so the log is read once.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.first_seen import first_seen, merge_first_seen, merge_into_buckets
from ..session import cut_lineage
from ..sources import sinks
from ..sources.bucketed import open_bucketed, write_bucketed
from ..sources.schemas import FIRST_SEEN
from ..sources.versions import commit_version, read_version
from . import daily, slots

# Buckets of the first-seen table; some 100 MB each for a billion users.
BUCKETS = 256


def publish_first_seen(actions: DataFrame, as_of: date, folder: str, previous: date | None = None) -> DataFrame:
    """Store first-seen of all users before ``as_of`` as the version ``as_of`` of ``folder`` and return it.

    With ``previous``, the day of an earlier version, only the actions since then are read and merged into
    that version; without, the whole history. Earlier days stay as they are, and a rerun takes the place of
    the day's rows in one step, once it is complete.
    """
    before = actions.filter(F.col("time") < daily.midnight(as_of))
    if previous is None:
        users = first_seen(before)
    else:
        known = read_first_seen(actions.sparkSession, folder, previous)
        users = merge_first_seen(known, before.filter(F.col("time") >= daily.midnight(previous)))
    commit_version(users, f"{folder}/as_of={as_of.isoformat()}")
    return read_first_seen(actions.sparkSession, folder, as_of)


def read_first_seen(spark: SparkSession, folder: str, as_of: date) -> DataFrame:
    """The first-seen table as ``publish_first_seen`` has stored it for a day."""
    return read_version(spark, f"{folder}/as_of={as_of.isoformat()}")


def publish_first_seen_buckets(
    actions: DataFrame, as_of: date, folder: str, table: str, previous: date | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """``publish_first_seen`` with versions in buckets by user, as the tables ``<table>_<yyyymmdd>`` of the catalog.

    Bringing a version up to date sends the users of the days since then to the buckets and moves nothing else.
    All versions have the same number of buckets. A version is written once; a rerun for the same day needs a
    folder and name of its own.
    """
    spark = actions.sparkSession
    before = actions.filter(F.col("time") < daily.midnight(as_of))
    if previous is None:
        users = first_seen(before)
    else:
        known = open_bucketed(spark, f"{folder}/as_of={previous.isoformat()}", f"{table}_{previous:%Y%m%d}", FIRST_SEEN, "user_id", buckets)
        users = merge_into_buckets(known, before.filter(F.col("time") >= daily.midnight(previous)))
    return write_bucketed(users, f"{folder}/as_of={as_of.isoformat()}", f"{table}_{as_of:%Y%m%d}", "user_id", buckets)


def publish_app_report(
    actions: DataFrame,
    as_of: date,
    folder: str,
    known_first_seen: DataFrame | None = None,
    previous: date | None = None,
    table: str | None = None,
) -> None:
    """App KPIs of the last seven days to ``<folder>/app_series``, yesterday's text to
    ``<folder>/app_text``.

    New users come from the table that ``publish_first_seen`` keeps in ``<folder>/first_seen``, brought up to
    ``as_of`` from its version ``previous``, unless ``known_first_seen`` is given. With ``table``, the name of its
    versions in the catalog, it is kept in buckets.
    """
    if known_first_seen is None and table is not None:
        known_first_seen = publish_first_seen_buckets(actions, as_of, f"{folder}/first_seen", table, previous)
    elif known_first_seen is None:
        known_first_seen = publish_first_seen(actions, as_of, f"{folder}/first_seen", previous)
    series = cut_lineage(daily.app_series(actions, as_of, known_first_seen=known_first_seen))
    yesterday = series.filter(F.col("date") == F.lit(as_of - timedelta(days=1)))
    sinks.write_report(series, f"{folder}/app_series", as_of)
    sinks.write_report(daily.app_report_text(yesterday), f"{folder}/app_text", as_of)


def publish_feed_report(feed: DataFrame, as_of: date, folder: str) -> None:
    """Feed KPIs of the last seven days to ``<folder>/feed_series``, yesterday's text to
    ``<folder>/feed_text``."""
    series = cut_lineage(daily.feed_series(feed, as_of))
    yesterday = series.filter(F.col("date") == F.lit(as_of - timedelta(days=1)))
    sinks.write_report(series, f"{folder}/feed_series", as_of)
    sinks.write_report(daily.feed_report_text(yesterday), f"{folder}/feed_text", as_of)


def publish_alerts(feed: DataFrame, path: str, as_of: date) -> DataFrame:
    """Verdicts for the slot that was completed last on ``as_of``, stored by day and slot start; returns
    the stored records. The day bounds what is read, which is two weeks of the log."""
    alerts = cut_lineage(slots.alert_records(slots.slot_anomalies(feed, as_of)))
    sinks.write_alerts(alerts, path)
    return alerts
