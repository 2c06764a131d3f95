from datetime import datetime, timedelta

from pyspark.sql import functions as F

from actionlens.plans import slots
from actionlens.sources import fixtures
from actionlens.streaming import slot_monitor

from .conftest import at, rows_of

SF = "/root/testdata/sf0.01"


def test_closed_buckets_and_alerts_equal_batch(spark):
    buckets_path, alerts_path = slot_monitor.replay(spark, SF)
    feed = fixtures.feed(spark, SF)
    live = spark.read.parquet(buckets_path).drop("day")
    batch = slots.bucket_metrics(feed).drop("day", "slot")
    newest = feed.agg(F.max("time")).first()[0]
    closed = batch.filter(F.col("time") + F.expr("interval 30 minutes") <= F.lit(newest).cast("timestamp_ntz"))
    assert rows_of(live) == rows_of(closed) and live.count() < batch.count()
    # At the end of the log the batch detector sees the same slot and gives the same verdict.
    last = closed.agg(F.max("time")).first()[0]
    cut = feed.filter(F.col("time") < F.lit(last + timedelta(minutes=30)).cast("timestamp_ntz"))
    columns = ["metric", "time", "status", "value", "mean"]
    batch_alerts = slots.alert_records(slots.slot_anomalies(cut)).select(columns)
    live_alerts = spark.read.parquet(alerts_path).filter(F.col("time") == F.lit(last).cast("timestamp_ntz")).select(columns)
    assert rows_of(live_alerts) == rows_of(batch_alerts)


def bucket_rows(spark, first, n, value=5):
    rows = [(datetime.fromisoformat(first) + timedelta(days=d), value, value, value, 1, 0.2) for d in range(n)]
    return spark.createDataFrame(
        rows, "time timestamp_ntz, activ_users long, actions long, views long, likes long, ctr double"
    )


def test_repeated_batch_changes_nothing(spark, tmp_path):
    buckets, alerts = f"{tmp_path}/buckets", f"{tmp_path}/alerts"
    slot_monitor.store_buckets(bucket_rows(spark, "2024-01-01 12:00:00", 0), buckets, alerts)  # nothing closed
    slot_monitor.store_buckets(bucket_rows(spark, "2024-01-01 12:00:00", 13), buckets, alerts)
    spike = bucket_rows(spark, "2024-01-14 12:00:00", 1, 90)
    slot_monitor.store_buckets(spike, buckets, alerts)
    before = rows_of(spark.read.parquet(alerts)), rows_of(spark.read.parquet(buckets))
    slot_monitor.store_buckets(spike, buckets, alerts)
    # Another slot of a stored day leaves the day's buckets alone.
    assert (rows_of(spark.read.parquet(alerts)), rows_of(spark.read.parquet(buckets))) == before
    slot_monitor.store_buckets(bucket_rows(spark, "2024-01-14 13:00:00", 1), buckets, alerts)
    assert spark.read.parquet(buckets).count() == 15
    last = spark.read.parquet(alerts).filter("time = timestamp_ntz'2024-01-14 12:00:00'")
    assert {r["metric"]: r["status"] for r in last.collect()} == {"activ_users": "high", "views": "high", "likes": "none", "ctr": "none"}


def test_a_new_checkpoint_keeps_stored_buckets(spark, tmp_path):
    """Batch numbers start again with a new checkpoint; 13 stored days stay in sight."""
    buckets = f"{tmp_path}/buckets"
    slot_monitor.store_buckets(bucket_rows(spark, "2023-12-19 12:00:00", 13), buckets, f"{tmp_path}/alerts")
    add_file(spark, f"{tmp_path}/in", *[(u, "12:01:00") for u in range(90)], (1, "12:40:00"))
    stored = run_to_end(spark, tmp_path)
    assert len(stored) == 14 and stored[-1] == (at("2024-01-01 12:00:00"), 90, 90)
    alert = spark.read.parquet(f"{tmp_path}/alerts").filter("metric = 'activ_users' AND time >= timestamp_ntz'2024-01-01 00:00:00'")
    assert [(r["status"], round(r["mean"], 2)) for r in alert.collect()] == [("high", 11.07)]


def test_repair_counts_late_rows(spark, tmp_path):
    folder = f"{tmp_path}/in"
    add_file(spark, folder, (1, "12:01:00"), (3, "12:31:00"))
    run_to_end(spark, tmp_path)
    add_file(spark, folder, (9, "12:03:00"), (5, "13:00:00"))  # behind the watermark
    stored = run_to_end(spark, tmp_path)
    assert stored[0] == (at("2024-01-01 12:00:00"), 1, 1)
    feed = spark.read.schema("user_id long, time timestamp_ntz, action string").parquet(folder)
    day = at("2024-01-01 00:00:00").date()
    slot_monitor.repair_days(feed, day, day, f"{tmp_path}/buckets", f"{tmp_path}/alerts")
    repaired = spark.read.parquet(f"{tmp_path}/buckets").orderBy("time").collect()
    assert [(r["time"], r["activ_users"]) for r in repaired][:2] == [(at("2024-01-01 12:00:00"), 2), (at("2024-01-01 12:30:00"), 1)]


def test_lookback_leaves_older_days_out(spark, tmp_path):
    old = bucket_rows(spark, "2023-12-01 12:00:00", 31, 1000).unionByName(bucket_rows(spark, "2024-01-01 12:00:00", 14))
    closed = old.filter("time = timestamp_ntz'2024-01-14 12:00:00'")
    got = slot_monitor.verdicts_for(old, closed).filter("metric = 'views'").first()
    assert (got["mean"], got["sigma"]) == (5.0, 0.0)


def feed_files(spark, folder):
    """A file stream over ``folder``, one file per batch."""
    return (
        spark.readStream.schema("user_id long, time timestamp_ntz, action string")
        .option("maxFilesPerTrigger", 1)
        .parquet(folder)
    )


def add_file(spark, folder, *rows):
    data = [(u, at(f"2024-01-01 {t}"), "view") for u, t in rows]
    spark.createDataFrame(data, "user_id long, time timestamp_ntz, action string").coalesce(1).write.mode(
        "append"
    ).parquet(folder)


def run_to_end(spark, tmp_path):
    stream = slot_monitor.run_monitor(
        feed_files(spark, f"{tmp_path}/in"),
        f"{tmp_path}/buckets",
        f"{tmp_path}/alerts",
        f"{tmp_path}/state",
        state_partitions=2,
        availableNow=True,
    )
    stream.awaitTermination()
    stored = spark.read.parquet(f"{tmp_path}/buckets")
    return [(r["time"], r["activ_users"], r["actions"]) for r in stored.orderBy("time").collect()]


def test_restart_and_late_rows(spark, tmp_path):
    folder = f"{tmp_path}/in"
    add_file(spark, folder, (1, "12:01:00"), (2, "12:02:00"), (1, "12:16:00"), (3, "12:31:00"))
    # The watermark is 12:16: only the bucket that ends at 12:15 is closed.
    assert run_to_end(spark, tmp_path) == [(at("2024-01-01 12:00:00"), 2, 2)]
    # After a restart: one row that is late but within the open bucket, one behind the watermark.
    add_file(spark, folder, (9, "12:03:00"), (4, "12:17:00"), (1, "12:18:00"), (5, "13:00:00"))
    assert run_to_end(spark, tmp_path) == [
        (at("2024-01-01 12:00:00"), 2, 2),
        (at("2024-01-01 12:15:00"), 2, 3),
        (at("2024-01-01 12:30:00"), 1, 1),
    ]
    # Nothing new: nothing changes.
    assert len(run_to_end(spark, tmp_path)) == 3
    assert spark.conf.get(slot_monitor.STATE_PARTITIONS) == "4"
