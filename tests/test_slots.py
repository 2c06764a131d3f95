from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from actionlens.plans import slots
from actionlens.sources import fixtures

from .conftest import at, plan_of, rows_of


def daily_log(actions, counts, slot="12:00:05", newest="12:20:00", first="2024-01-01"):
    """``counts[d]`` users view in the slot on day d; one action later on the last day."""
    rows, day = [], datetime.fromisoformat(first)
    for d, n in enumerate(counts):
        stamp = (day + timedelta(days=d)).strftime("%Y-%m-%d")
        rows += [(u, f"{stamp} {slot}", "view") for u in range(n)]
    rows.append((0, f"{stamp} {newest}", "view"))
    return actions(*rows)


def test_series_follows_the_slot_before_the_newest(actions):
    log = daily_log(actions, [2, 3, 4])
    got = [(r["time"], r["activ_users"]) for r in slots.slot_series(log).orderBy("time").collect()]
    assert got == [(at("2024-01-01 12:00:00"), 2), (at("2024-01-02 12:00:00"), 3), (at("2024-01-03 12:00:00"), 4)]


def test_missing_anchor_gives_no_rows(actions):
    log = daily_log(actions, [2, 3, 4], newest="13:00:00")
    assert slots.slot_series(log).count() == 0
    assert slots.slot_anomalies(log).count() == 0


def test_lookback_is_fourteen_days_with_today(actions):
    log = daily_log(actions, [1] * 20)
    assert slots.slot_series(log).count() == 14
    assert slots.slot_series(log, as_of=date(2024, 1, 25)).count() == 9  # from January 12 on
    assert slots.slot_series(log, as_of=date(2024, 3, 1)).count() == 0


def test_anchor_on_the_day_before(actions):
    log = actions((1, "2024-01-01 23:50:00", "view"), (1, "2024-01-02 00:05:00", "view"))
    assert [r["time"] for r in slots.slot_series(log).collect()] == [at("2024-01-01 23:45:00")]
    # The look-back then starts after the anchor bucket: nothing of its slot is left.
    assert slots.slot_series(log, as_of=date(2024, 1, 15)).count() == 0


def test_bucket_metrics(actions):
    log = actions(
        (1, "2024-01-01 00:00:00", "view"),
        (1, "2024-01-01 00:14:59", "like"),
        (2, "2024-01-01 00:01:00", "view"),
        (2, "2024-01-01 00:02:00", "share"),
        (None, "2024-01-01 00:03:00", "view"),
    )
    got = slots.bucket_metrics(log).first().asDict()
    assert (got["activ_users"], got["actions"], got["views"], got["likes"], got["ctr"]) == (2, 5, 2, 1, 0.5)


def expected_bands(values):
    """The detector in pandas."""
    df = pd.DataFrame({"v": values})
    df["mean3"] = df.v.rolling(3).mean()
    sigma = np.std(df.mean3 - df.v)
    return df.mean3, sigma, df.mean3 + 2.576 * sigma, df.mean3 - 2.576 * sigma


@pytest.mark.parametrize("last, status", [(60, "high"), (10, "none"), (1, "low")])
def test_verdicts(spark, last, status):
    values = [float(v) for v in (10, 11, 9, 10, 10, 11, 9, 10, 11, 10, 9, 10, 10, last)]
    long = spark.createDataFrame(
        [("m", datetime(2024, 1, 1 + i, 12), v) for i, v in enumerate(values)],
        "metric string, time timestamp_ntz, value double",
    )
    judged = slots.add_verdict(slots.add_bands(long, ["metric"]))
    got = slots.latest_per_series(judged, ["metric"]).first()
    assert got["status"] == status
    mean3, sigma, _, _ = expected_bands(values)
    assert got["rolling_mean"] == pytest.approx(mean3.iloc[-1])
    assert got["sigma"] == pytest.approx(sigma)
    mean = np.mean(values)
    wanted = {"high": (values[-1] - mean) / mean, "low": (mean - values[-1]) / values[-1], "none": None}[status]
    assert got["deviation"] == (pytest.approx(wanted) if wanted is not None else None)


def test_bands_equal_pandas(spark):
    values = [float(v) for v in (3, 5, 4, 4, 8, 1, 2, 9, 4, 4, 4, 5, 6, 2)]
    long = spark.createDataFrame(
        [("m", datetime(2024, 1, 1 + i, 12), v) for i, v in enumerate(values)],
        "metric string, time timestamp_ntz, value double",
    )
    got = slots.add_bands(long, ["metric"]).orderBy("time").collect()
    mean3, sigma, upper, lower = expected_bands(values)
    assert [r["rolling_mean"] for r in got[:2]] == [None, None]
    assert [r["upper"] for r in got[2:]] == pytest.approx(list(upper[2:]))
    assert [r["lower"] for r in got[2:]] == pytest.approx(list(lower[2:]))
    for r in got[2:]:  # the band is symmetric about the rolling mean
        assert r["upper"] - r["rolling_mean"] == pytest.approx(r["rolling_mean"] - r["lower"])


def test_short_constant_and_null_series_are_no_anomaly(spark, actions):
    log = daily_log(actions, [5, 5])
    assert {r["status"] for r in slots.slot_anomalies(log).collect()} == {"none"}
    log = daily_log(actions, [5] * 14)
    got = {r["metric"]: r for r in slots.slot_anomalies(log).collect()}
    assert got["activ_users"]["sigma"] == 0.0 and got["activ_users"]["status"] == "none"
    assert set(got) == {"activ_users", "views", "likes", "ctr"}


def test_flat_fraction_is_no_anomaly(spark):
    # Three times 0.2 and then a third of it is not 0.2 in binary.
    long = spark.createDataFrame(
        [("ctr", datetime(2024, 1, 1 + i, 12), 0.2) for i in range(14)],
        "metric string, time timestamp_ntz, value double",
    )
    judged = slots.add_verdict(slots.add_bands(long, ["metric"]))
    assert {r["status"] for r in judged.collect()} == {"none"}


def test_null_breaks_the_rolling_mean(spark):
    values = [1.0, 2.0, None, 4.0, 5.0, 6.0]
    long = spark.createDataFrame(
        [("ctr", datetime(2024, 1, 1 + i, 12), v) for i, v in enumerate(values)],
        "metric string, time timestamp_ntz, value double",
    )
    got = [r["rolling_mean"] for r in slots.add_bands(long, ["metric"]).orderBy("time").collect()]
    assert got == [None, None, None, None, None, 5.0]


def test_alert_text(spark):
    row = [("views", datetime(2024, 1, 5, 12), "high", 60.0, 20.0, 2.0), ("ctr", datetime(2024, 1, 5, 12), "none", None, 0.5, None)]
    df = spark.createDataFrame(
        row, "metric string, time timestamp_ntz, status string, value double, mean double, deviation double"
    )
    got = {r["metric"]: r["message"] for r in slots.alert_records(df).collect()}
    assert got["views"] == (
        "Anomaly found\nMetric: views at 2024-01-05 12:00:00\nabove the mean of the last 14 days by: 200.00%\n"
        "value now: 60.00\nmean: 20.00"
    )
    assert got["ctr"] == "metric ctr: no anomaly"


def test_all_slots_agree_with_the_single_slot(spark):
    feed = fixtures.feed(spark, "/root/testdata/sf0.1").filter("time >= timestamp_ntz'2024-01-17 00:00:00'")
    single = slots.slot_bands(feed).select("metric", "time", "value", "rolling_mean", "sigma")
    every = slots.all_slot_bands(feed).filter("slot = 84600").select("metric", "time", "value", "rolling_mean", "sigma")
    assert rows_of(single) == rows_of(every)


def test_start_of_lookback_reaches_the_scan(spark):
    plan = plan_of(slots.slot_series(fixtures.feed(spark, "/root/testdata/sf0.01"), date(2024, 1, 30)))
    assert plan.count("GreaterThanOrEqual(ts,2024-01-17T00:00)") >= 2  # the scan and the search for the newest
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
