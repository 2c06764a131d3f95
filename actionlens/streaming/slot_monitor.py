"""The 15-minute slot monitor as a stream.

The batch job runs every 15 minutes and skips the newest bucket because it is still filling. On a
stream the watermark says when a bucket is complete; each closed bucket is stored once and the
detector reads the stored buckets of its slot.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import (
    ACTION_LIKE,
    ACTION_VIEW,
    day_of,
    epoch_to_timestamp,
    ratio,
    timestamp_to_epoch,
)
from ..plans.daily import in_days
from ..plans.slots import (
    CHECKED_METRICS,
    LOOKBACK_DAYS,
    Z,
    add_bands,
    add_verdict,
    alert_records,
    bucket_metrics,
    long_form,
)
from ..session import cut_lineage, scratch_folder
from ..sources import fixtures
from ..sources.sinks import write_partitions

BUCKET = "15 minutes"
LATENESS = "15 minutes"
STATE_PARTITIONS = "spark.sql.shuffle.partitions"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
# Keeps the users of open buckets off the heap.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def live_buckets(feed: DataFrame, lateness: str = LATENESS, keep_event_time: bool = False) -> DataFrame:
    """Streaming counterpart of ``bucket_metrics``: one row per closed bucket, with the instant ``closed`` that
    the watermark follows if ``keep_event_time`` is set.

    ``feed`` is a stream of ``(user_id, time, action)``. Exact distinct users take two chained
    aggregates: the first keeps a row per open bucket and user, the second a row per open bucket,
    so the state holds the users active within about two buckets. The watermark needs an instant,
    so times pass through it as seconds since 1970; buckets begin and end on whole seconds.

    Rows of a column ``beat``, if there is one, only tell the time: they move the watermark on and make no bucket.
    """
    known = F.col("user_id").isNotNull()
    beats = "beat" in feed.columns
    real = [F.count_if(~F.col("beat")).alias("rows")] if beats else []
    per_user = (
        feed.withColumn("time", F.timestamp_seconds(timestamp_to_epoch("time")))
        .withWatermark("time", lateness)
        .groupBy(F.window("time", BUCKET).alias("bucket"), "user_id")
        .agg(
            F.count("action").alias("n"),
            F.count_if(known & (F.col("action") == ACTION_VIEW)).alias("views"),
            F.count_if(known & (F.col("action") == ACTION_LIKE)).alias("likes"),
            *real,
        )
    )
    per_bucket = (
        per_user.withColumn("at", F.window_time("bucket"))
        .groupBy(F.window("at", BUCKET).alias("bucket"))
        .agg(
            F.count("user_id").alias("activ_users"),
            F.sum("n").alias("actions"),
            F.sum("views").alias("views"),
            F.sum("likes").alias("likes"),
            *([F.sum("rows").alias("rows")] if beats else []),
        )
    )
    if beats:
        per_bucket = per_bucket.filter("rows > 0")
    return per_bucket.select(
        epoch_to_timestamp(F.unix_seconds("bucket.start")).alias("time"),
        "activ_users",
        "actions",
        "views",
        "likes",
        ratio("likes", "views").alias("ctr"),
        *([F.window_time("bucket").alias("closed")] if keep_event_time else []),
    )


def verdicts_for(buckets: DataFrame, closed: DataFrame, lookback_days: int = LOOKBACK_DAYS, z: float = Z) -> DataFrame:
    """Verdict for every bucket in ``closed`` from the stored ``buckets``: for each, the same slot
    on the last ``lookback_days`` days up to its own.

    Each closed bucket names the starts it looks back to, so the join is on equal times.
    """
    back = F.explode(F.sequence(F.lit(0), F.lit(lookback_days - 1)))
    wanted = closed.select(F.col("time").alias("closed_at"), back.alias("back")).select(
        "closed_at", F.timestamp_add("DAY", -F.col("back"), "closed_at").alias("time")
    )
    series = buckets.join(wanted, "time")
    long = long_form(series, ["closed_at", "time"], CHECKED_METRICS)
    banded = add_bands(long, ["closed_at", "metric"], z)
    return add_verdict(banded).filter(F.col("time") == F.col("closed_at")).drop("closed_at")


def merge_rows(rows: DataFrame, path: str, keys: list[str], first: date, last: date) -> DataFrame:
    """Put ``rows`` of the days ``first`` to ``last`` in place of stored rows with the same ``keys``; returns
    the stored table. Only these days, at most 96 buckets each, are read and written again."""
    keyed = rows.withColumn("day", day_of("time"))
    keyed.limit(0).write.mode("append").partitionBy("day").parquet(path)  # makes the table if there is none
    stored = rows.sparkSession.read.schema(keyed.schema).parquet(path)
    others = stored.filter(F.col("day").between(first, last)).join(keyed.select(*keys), keys, "left_anti")
    write_partitions(cut_lineage(others.unionByName(keyed)).coalesce(1), path, "day")
    return rows.sparkSession.read.schema(keyed.schema).parquet(path)


def store_buckets(
    closed: DataFrame, buckets_path: str, alerts_path: str, lookback_days: int = LOOKBACK_DAYS, z: float = Z
) -> None:
    """Store closed buckets and the alerts on them.

    The start of a bucket is its key, in tables laid out by day: a bucket that is stored again, by a
    repeated batch, after a new start of the stream or by ``repair_days``, replaces itself and nothing
    else. A bucket looks back by time only, at the same slot of earlier days.
    """
    closed = closed.persist()
    try:
        first, last = closed.agg(F.min("time"), F.max("time")).first()
        if first is None:
            return
        days = first.date(), last.date()
        stored = merge_rows(closed, buckets_path, ["time"], *days)
        oldest = days[0] - timedelta(days=lookback_days)
        recent = stored.filter(F.col("day").between(oldest, days[1])).drop("day")
        alerts = alert_records(verdicts_for(recent, closed, lookback_days, z), lookback_days)
        merge_rows(alerts, alerts_path, ["metric", "time"], *days)
    finally:
        closed.unpersist()


def repair_days(
    feed: DataFrame,
    first: date,
    last: date,
    buckets_path: str,
    alerts_path: str,
    lookback_days: int = LOOKBACK_DAYS,
    z: float = Z,
) -> None:
    """The daily repair: count the buckets of the days ``first`` to ``last`` again from the whole
    ``feed``, rows that came too late for the stream included, and store them and their alerts."""
    whole = bucket_metrics(feed.filter(in_days("time", first, last))).drop("day", "slot")
    store_buckets(whole, buckets_path, alerts_path, lookback_days, z)


def run_monitor(
    feed: DataFrame,
    buckets_path: str,
    alerts_path: str,
    checkpoint: str,
    lookback_days: int = LOOKBACK_DAYS,
    z: float = Z,
    state_partitions: int | None = None,
    **trigger,
) -> StreamingQuery:
    """Start the monitor; ``trigger`` as for ``DataStreamWriter.trigger``, every 15 minutes by
    default.

    The number of state partitions is fixed with the first start on a checkpoint. By default it is
    the session's number of shuffle partitions; ``state_partitions`` sets it for this stream alone.
    """

    def store(closed: DataFrame, batch_id: int) -> None:
        store_buckets(closed, buckets_path, alerts_path, lookback_days, z)

    return start_stream(live_buckets(feed), store, checkpoint, state_partitions, trigger)


def start_stream(rows: DataFrame, store, checkpoint: str, state_partitions: int | None, trigger: dict) -> StreamingQuery:
    """Start a stateful stream with its state in RocksDB, whose batches ``store`` takes."""
    writer = (
        rows.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
        .trigger(**(trigger or {"processingTime": BUCKET}))
    )
    settings = rows.sparkSession.conf
    wanted = {STATE_PARTITIONS: state_partitions or settings.get(STATE_PARTITIONS), STATE_STORE: ROCKSDB}
    of_session = {name: settings.get(name) for name in wanted}
    try:
        # A stream copies the settings of its session when it starts.
        for name, value in wanted.items():
            settings.set(name, str(value))
        return writer.start()
    finally:
        for name, value in of_session.items():
            settings.set(name, value)


def feed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed of the test tables as a file stream. The pattern lets the table be one file or a
    folder of files."""
    stream = spark.readStream.schema(fixtures.EVENTS).parquet(f"{sf_dir}/events*.parquet")
    action = F.when(F.col("event_type") == "click", "like").otherwise(F.col("event_type"))
    return stream.filter(F.col("event_type") != "purchase").select(
        "user_id", F.col("ts").alias("time"), action.alias("action")
    )


def replay(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Run the monitor over everything in the test tables; paths of its buckets and alerts."""
    folder = scratch_folder(spark)
    buckets, alerts = f"{folder}/buckets", f"{folder}/alerts"
    stream = run_monitor(
        feed_stream(spark, sf_dir),
        buckets,
        alerts,
        f"{folder}/stream",
        state_partitions=spark.sparkContext.defaultParallelism,
        availableNow=True,
    )
    stream.awaitTermination()
    return buckets, alerts
