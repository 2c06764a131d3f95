"""The slot detector with its own state: every metric at every slot of day remembers its last days.

A closed bucket gets its verdict from the state alone; no stored bucket is read again. A timer for the
next day tells when a bucket that should have come has not: a slot without any action raises an
alarm, where the batch job, which sees rows only, says nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.columns import SLOT_SECONDS, slot_seconds_of
from ..plans.slots import CHECKED_METRICS, LOOKBACK_DAYS, ROLLING_ROWS, Z, alert_records
from ..session import scratch_folder
from .slot_monitor import LATENESS, feed_stream, live_buckets, merge_rows, start_stream

_DAY = 86_400
_STATE = "days array<long>, values array<double>, checked long"
VERDICT = "metric string, slot long, time timestamp_ntz, value double, rolling_mean double, mean double, sigma double, upper double, lower double, status string, deviation double, silent boolean"


def _mean(values: list[float]) -> float:
    return math.fsum(values) / len(values)


def verdict(values: list[float | None], z: float = Z, rows: int = ROLLING_ROWS) -> tuple:
    """``(rolling_mean, mean, sigma, upper, lower, status, deviation)`` for the last of ``values``, a series of
    one slot by day. The rules are those of ``slots.add_bands`` and ``slots.add_verdict``."""
    rolling: list[float | None] = []
    for i in range(len(values)):
        last = values[max(0, i + 1 - rows) : i + 1]
        if len(last) < rows or None in last:
            rolling.append(None)
        else:
            rolling.append(last[-1] if min(last) == max(last) else _mean(last))
    residuals = [r - v for r, v in zip(rolling, values) if r is not None]
    known = [v for v in values if v is not None]
    mean = _mean(known) if known else None
    sigma = None
    if residuals:
        center = _mean(residuals)
        sigma = math.sqrt(_mean([(x - center) ** 2 for x in residuals]))
    value, middle = values[-1], rolling[-1]
    upper, lower = (None, None) if middle is None or sigma is None else (middle + sigma * z, middle - sigma * z)
    status, deviation = "none", None
    if value is not None and upper is not None:
        if value > upper:
            status, deviation = "high", (value - mean) / mean if mean else None
        elif value < lower:
            status, deviation = "low", (mean - value) / value if value else None
    return middle, mean, sigma, upper, lower, status, deviation


class SlotDetector(StatefulProcessor):
    """State of one metric at one slot: the days of the look-back that had actions, their values, and the last
    day that was judged, with actions or without."""

    def __init__(self, lookback_days: int = LOOKBACK_DAYS, z: float = Z, rows: int = ROLLING_ROWS):
        self.lookback_days, self.z, self.rows = lookback_days, z, rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getValueState("ring", _STATE)

    def _load(self) -> tuple[list[int], list[float | None], int | None]:
        if not self.ring.exists():
            return [], [], None
        days, values, checked = self.ring.get()
        return list(days), [None if v is None or math.isnan(v) else float(v) for v in values], int(checked)

    def _shortened(self, days: list[int], values: list, day: int) -> tuple[list[int], list]:
        """The part of the ring within the look-back of ``day``."""
        kept = [i for i, d in enumerate(days) if day - self.lookback_days < d]
        return [days[i] for i in kept], [values[i] for i in kept]

    def _silences(self, key: tuple, days: list[int], values: list, first: int, last: int) -> Iterator[tuple]:
        """An alarm for each of the days ``first`` to ``last`` that had no action, where enough days before had."""
        for day in range(first, last + 1):
            recent, known = self._shortened(days, values, day)
            if not recent:
                return
            if len(recent) >= self.rows:
                present = [v for v in known if v is not None]
                mean = _mean(present) if present else None
                yield (*key, _time(day, key[1]), 0.0, None, mean, None, None, None, "low", None, True)

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        names = [part.split()[0] for part in VERDICT.split(", ")]
        return pd.DataFrame(rows, columns=names)

    def _due(self, day: int, slot: int) -> int:
        """When the bucket of the day after ``day`` must have come, in milliseconds."""
        return ((day + 1) * _DAY + slot + 2 * SLOT_SECONDS) * 1000

    def _put(self, key: tuple, days: list[int], values: list, checked: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        days, values = self._shortened(days, values, checked + 1)
        if days:
            self.ring.update((days, values, checked))
            self.handle.registerTimer(self._due(checked, key[1]))
        else:
            self.ring.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        days, values, checked = self._load()
        out = []
        arrived = pd.concat(list(rows)).sort_values("day")
        for day, value in zip(arrived["day"].tolist(), arrived["value"].tolist()):
            if checked is not None:
                out += self._silences(key, days, values, checked + 1, day - 1)
            days, values = self._shortened(days, values, day)
            value = None if value is None or math.isnan(value) else float(value)
            days, values, checked = [*days, day], [*values, value], day
            out.append((*key, _time(day, key[1]), value, *verdict(values, self.z, self.rows), False))
        self._put(key, days, values, checked)
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        days, values, checked = self._load()
        if checked is not None:
            # All days whose buckets are overdue by now, not only the one that the timer was set for.
            last = checked
            while self._due(last, key[1]) <= timerValues.getCurrentWatermarkInMs():
                last += 1
            out = list(self._silences(key, days, values, checked + 1, last))
            self._put(key, days, values, last)
            if out:
                yield self._frame(out)

    def close(self) -> None:
        pass


def _time(day: int, slot: int) -> datetime:
    return datetime.fromtimestamp(day * _DAY + slot, timezone.utc).replace(tzinfo=None)


def with_heartbeat(feed: DataFrame, clock: DataFrame) -> DataFrame:
    """``feed`` and a row for each of ``clock(time)``, which moves the watermark on even if the feed is silent
    altogether. In production the clock is a ``rate`` stream."""
    beats = clock.select(F.lit(None).cast("long").alias("user_id"), "time", F.lit(None).cast("string").alias("action"), F.lit(True).alias("beat"))
    return feed.select("user_id", "time", "action", F.lit(False).alias("beat")).unionByName(beats)


def live_verdicts(feed: DataFrame, lookback_days: int = LOOKBACK_DAYS, z: float = Z, lateness: str = LATENESS) -> DataFrame:
    """Streaming verdicts for each metric of each closed bucket, and alarms for silent ones (``silent``).

    ``feed`` is a stream of ``(user_id, time, action)``, as it is or ``with_heartbeat``. The state has a row for each metric
    and slot of day with at most ``lookback_days`` numbers in it.
    """
    closed = live_buckets(feed, lateness, keep_event_time=True)
    values = F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in CHECKED_METRICS))
    long = closed.select(slot_seconds_of("time").alias("slot"), F.unix_date(F.to_date("time")).cast("long").alias("day"), "closed", F.inline(values))
    return long.groupBy("metric", "slot").transformWithStateInPandas(
        statefulProcessor=SlotDetector(lookback_days, z), outputStructType=VERDICT, outputMode="append", timeMode="EventTime"
    )


def silence_records(verdicts: DataFrame) -> DataFrame:
    """``(metric, time, status, value, mean, deviation, message)`` of verdicts, silent slots in words of their own."""
    records = alert_records(verdicts.filter(~F.col("silent")))
    silent = verdicts.filter("silent")
    mean = F.when(F.col("mean").isNull(), "n/a").otherwise(F.format_string("%.2f", "mean"))
    message = F.format_string("No action at all\nMetric: %s at %s\nmean of the days before: %s", "metric", F.col("time").cast("string"), mean)
    return records.unionByName(silent.select("metric", "time", "status", "value", "mean", "deviation", message.alias("message")))


def run_detector(
    feed: DataFrame, alerts_path: str, checkpoint: str, lookback_days: int = LOOKBACK_DAYS, z: float = Z, state_partitions: int | None = None, **trigger
) -> StreamingQuery:
    """Start the detector; alerts are stored by day, with metric and time as their key, so a repeated batch
    replaces its own alerts."""

    def store(verdicts: DataFrame, batch_id: int) -> None:
        records = silence_records(verdicts).persist()
        try:
            first, last = records.agg(F.min("time"), F.max("time")).first()
            if first is not None:
                merge_rows(records, alerts_path, ["metric", "time"], first.date(), last.date())
        finally:
            records.unpersist()

    return start_stream(live_verdicts(feed, lookback_days, z), store, checkpoint, state_partitions, trigger)


def replay_detector(spark: SparkSession, sf_dir: str, lookback_days: int = LOOKBACK_DAYS, z: float = Z) -> DataFrame:
    """Run the detector over everything in the test tables; its alerts."""
    folder = scratch_folder(spark)
    stream = run_detector(
        feed_stream(spark, sf_dir), f"{folder}/alerts", f"{folder}/stream", lookback_days, z, spark.sparkContext.defaultParallelism, availableNow=True
    )
    stream.awaitTermination()
    return spark.read.parquet(f"{folder}/alerts").drop("day")
