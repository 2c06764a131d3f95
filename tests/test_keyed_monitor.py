import random
from datetime import date, datetime, timedelta

import pytest

from actionlens.plans import slots
from actionlens.streaming import keyed_monitor

from .conftest import at

START = datetime(2024, 1, 1, 12, 0)


def test_verdict_like_the_batch_rules(spark):
    r = random.Random(1)
    rows, series = [], []
    for k in range(40):
        values = [None if r.random() < 0.1 else float(r.choice([r.randint(0, 9), 5, 400])) for _ in range(r.randint(1, 14))]
        series.append(values)
        rows += [(k, START + timedelta(days=i), v) for i, v in enumerate(values)]
    table = spark.createDataFrame(rows, "k long, time timestamp_ntz, value double")
    batch = slots.latest_per_series(slots.add_verdict(slots.add_bands(table, ["k"])), ["k"]).collect()
    for row in batch:
        got = keyed_monitor.verdict(series[row["k"]])
        want = [row[c] for c in ("rolling_mean", "mean", "sigma", "upper", "lower")]
        assert [None if x is None else pytest.approx(x) for x in want] == list(got[:5])
        assert got[5] == row["status"] and (got[6] == pytest.approx(row["deviation"]) if row["deviation"] is not None else got[6] is None)


@pytest.fixture
def monitor(spark, tmp_path):
    """Run the detector over files that arrive one after the other; each run is a new start on the same state."""
    files = 0

    def run(*rows, beats=()):
        nonlocal files
        files += 1
        frame = spark.createDataFrame([(*r, False) for r in rows] + [(None, t, None, True) for t in beats], "user_id long, time timestamp_ntz, action string, beat boolean")
        frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        feed = spark.readStream.schema(frame.schema).parquet(f"{tmp_path}/in")
        keyed_monitor.run_detector(feed, f"{tmp_path}/alerts", f"{tmp_path}/state", state_partitions=2, availableNow=True).awaitTermination()
        try:
            stored = spark.read.parquet(f"{tmp_path}/alerts")
        except Exception:
            return {}
        return {(r["metric"], r["time"]): (r["status"], r["value"], r["message"].split("\n")[0]) for r in stored.collect()}

    return run


def day_of_actions(day, users=5, time=timedelta(minutes=1)):
    return [(u, START + timedelta(days=day) + time, "view") for u in range(users)]


def test_silence_is_low_and_state_survives_restarts(monitor):
    got = monitor(*[x for d in range(12) for x in day_of_actions(d)], (1, START + timedelta(days=11, hours=1), "view"))
    assert got["activ_users", START + timedelta(days=11)] == ("none", 5.0, "metric activ_users: no anomaly")
    assert not any(m == "No action at all" for _, _, m in got.values())
    # The next day: other slots have actions, this one has none.
    got = monitor((1, START + timedelta(days=12, hours=1), "view"), (1, START + timedelta(days=12, hours=2), "view"))
    assert got["activ_users", START + timedelta(days=12)] == ("low", 0.0, "No action at all")
    # The day after is judged with the days before the gap, by a new start of the stream.
    got = monitor(*day_of_actions(13, 90), (1, START + timedelta(days=13, hours=1), "view"))
    assert got["activ_users", START + timedelta(days=13)][:2] == ("high", 90.0)
    assert got["activ_users", START + timedelta(days=12)] == ("low", 0.0, "No action at all")
    # A slot with too few days behind it is not missed.
    assert ("activ_users", START + timedelta(days=13, hours=2)) not in got


def test_a_silent_feed_is_noticed_by_the_clock(monitor):
    monitor(*[x for d in range(4) for x in day_of_actions(d)])
    hours = [START + timedelta(days=4, hours=h) for h in (-2, 0, 1, 2)]
    got = monitor(beats=hours)
    assert got["views", START + timedelta(days=4)] == ("low", 0.0, "No action at all")
    # Beats make no buckets of their own.
    assert {t for _, t in got} == {START + timedelta(days=d) for d in range(5)}


def test_silence_ends_with_the_look_back(monitor):
    rows = [x for d in range(4) for x in day_of_actions(d)]
    got = monitor(*rows, *[(1, START + timedelta(days=d, hours=1), "view") for d in range(30)])
    silent = sorted(t for (metric, t), (_, _, m) in got.items() if m == "No action at all" and metric == "views")
    # Days 4 to 15: from day 16 on the look-back of 14 days holds one or two days with actions.
    assert [t.day - 1 for t in silent] == list(range(4, 15))


def test_heartbeat_columns(spark):
    feed = spark.createDataFrame([(1, at("2024-01-01 10:00:00"), "view")], "user_id long, time timestamp_ntz, action string")
    clock = spark.createDataFrame([(at("2024-01-01 11:00:00"),)], "time timestamp_ntz")
    rows = keyed_monitor.with_heartbeat(feed, clock).orderBy("time").collect()
    assert [r["beat"] for r in rows] == [False, True] and rows[1]["user_id"] is None
    assert keyed_monitor._time((date(2024, 1, 1) - date(1970, 1, 1)).days, 900) == datetime(2024, 1, 1, 0, 15)
