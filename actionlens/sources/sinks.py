"""Writers for reports, alerts and maintained tables.

Every write replaces exactly the partitions it carries, so a job that is run again for the same
day (or the same micro-batch) leaves the same table behind.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import slot_seconds_of
from ..session import cut_lineage
from .versions import commit_version, current_version, folders, read_version


def write_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Replace the partitions of ``path`` that occur in ``df``; others stay."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_report(report: DataFrame, path: str, as_of: date) -> None:
    """Reports and their text by the day they were made for, read with ``read_report``. A rerun replaces that day's rows,
    also when there are none any more.

    A report has a few rows a day. All days make a new version of the table, which readers see as a whole once it
    is complete.
    """
    spark = report.sparkSession
    of_day = report.withColumn("as_of", F.lit(as_of))
    if current_version(spark, path) is not None:
        others = read_version(spark, path).filter(F.col("as_of") != F.lit(as_of))
        of_day = others.unionByName(of_day, allowMissingColumns=True)
    commit_version(of_day.coalesce(1), path)


def read_report(spark: SparkSession, path: str, as_of: date | None = None) -> DataFrame:
    """The stored reports, with ``as_of``, of all days or of one."""
    stored = read_version(spark, path)
    return stored if as_of is None else stored.filter(F.col("as_of") == F.lit(as_of))


def write_alerts(alerts: DataFrame, path: str, run: datetime | None = None) -> None:
    """Alert records by day and slot, so that the runs of one day do not replace each other; read with
    ``read_alerts``.

    With ``run``, the start of the slot the alerts are about, that slot's records are replaced, also when
    there are no alerts any more. Each day that is touched gets a new version, which readers see as a whole.
    """
    spark = alerts.sparkSession
    keyed = cut_lineage(alerts.withColumns({"day": F.to_date("time"), "slot": slot_seconds_of("time")}))
    if run is None:
        # A row for each slot that the alerts are about.
        touched = [(r["day"], r["slot"]) for r in keyed.select("day", "slot").distinct().collect()]
    else:
        touched = [(run.date(), run.hour * 3600 + run.minute // 15 * 900)]
    for day in sorted({day for day, _ in touched}):
        slots = [slot for other, slot in touched if other == day]
        folder = f"{path}/day={day.isoformat()}"
        rows = keyed.filter((F.col("day") == F.lit(day)) & F.col("slot").isin(slots))
        if current_version(spark, folder) is not None:
            rows = read_version(spark, folder).filter(~F.col("slot").isin(slots)).unionByName(rows)
        commit_version(rows.coalesce(1), folder)


def read_alerts(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """Stored alerts with ``day`` and ``slot``, of all days or of those from ``first`` to ``last``."""
    days = [name.removeprefix("day=") for name in folders(spark, path) if name.startswith("day=")]
    wanted = [d for d in sorted(days) if (first is None or d >= first.isoformat()) and (last is None or d <= last.isoformat())]
    if not wanted:
        raise FileNotFoundError(f"{path} has no alerts of these days")
    return spark.read.parquet(*(f"{path}/day={d}/{current_version(spark, f'{path}/day={d}')}" for d in wanted))


def write_actions(df: DataFrame, path: str) -> None:
    """Action tables are laid out by day, which the reports prune on.

    Rows are brought together by day, so that a backfill of many days does not leave a file per task
    and day; adaptive execution splits a day that is larger than its target size.
    """
    by_day = df.withColumn("day", F.to_date("time")).hint("rebalance", F.col("day"))
    write_partitions(by_day, path, "day")
