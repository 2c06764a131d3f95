from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from actionlens import functions as fn

from .conftest import at


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def ts(text):
    return F.expr(f"timestamp_ntz'{text}'")


@pytest.mark.parametrize(
    "seconds, days", [(0, 0), (86_399, 0), (86_400, 1), (-1, -1), (-86_399, -1), (-86_400, -1), (-86_401, -2)]
)
def test_whole_days_round_down(spark, seconds, days):
    assert one(spark, fn.whole_days_from_seconds(F.lit(seconds))) == days


def test_whole_days_do_not_count_midnights(spark):
    assert one(spark, fn.whole_days(ts("2024-01-01 18:00:00"), ts("2024-01-02 06:00:00"))) == 0


@pytest.mark.parametrize(
    "text, slot",
    [("00:00:00", 0), ("00:14:59.999", 0), ("00:15:00", 900), ("13:44:59", 48_600), ("23:59:59", 85_500)],
)
def test_slot(spark, text, slot):
    t = ts(f"2024-01-01 {text}")
    assert one(spark, fn.slot_seconds_of(t)) == slot
    start = one(spark, fn.slot_start(fn.day_of(t), fn.slot_seconds_of(t)))
    assert start == at(f"2024-01-01 {slot // 3600:02d}:{slot % 3600 // 60:02d}:00")


def test_elapsed_seconds_cut_both_ends_to_the_second(spark):
    assert one(spark, fn.elapsed_seconds(ts("2024-01-01 00:00:00.9"), ts("2024-01-01 00:00:01.1"))) == 1
    assert one(spark, fn.elapsed_seconds(ts("2024-01-01 00:00:01.1"), ts("2024-01-01 00:00:01.9"))) == 0


def test_epoch_round_trip_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 on this day does not exist in New York.
        t = ts("2024-03-10 02:30:00.5")
        assert one(spark, fn.timestamp_to_epoch(t)) == 1_710_037_800
        assert one(spark, fn.epoch_to_timestamp(F.lit(1_710_037_800))) == at("2024-03-10 02:30:00")
        assert one(spark, fn.timestamp_to_epoch(ts("1969-12-31 23:59:59.5"))) == -1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_months(spark):
    t = ts("2020-01-31 23:59:59")
    assert one(spark, fn.month_of(t)) == date(2020, 1, 1)
    assert one(spark, fn.year_month_text(t)) == "2020-01"
    assert one(spark, fn.year_month_text(t, "\\")) == "2020\\01"


def test_ratio_of_zero_is_null(spark):
    assert one(spark, fn.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, fn.ratio(F.lit(0.0), F.lit(0.0))) is None
    assert one(spark, fn.ratio(F.lit(1), F.lit(4))) == 0.25


@pytest.mark.parametrize("x, down, even", [(2.479, 2.47, 2.48), (0.125, 0.12, 0.12), (0.375, 0.37, 0.38), (-0.125, -0.13, -0.12)])
def test_rounding(spark, x, down, even):
    assert one(spark, fn.floor2(F.lit(x))) == down
    assert one(spark, fn.round2_even(F.lit(x))) == even


def test_percent_text(spark):
    assert one(spark, fn.percent_text(F.lit(0.12345))) == "12.35%"


def test_two_sided_p(spark):
    df = spark.createDataFrame([(1.96, 1.0), (-1.96, 1.0), (0.0, 2.0), (1.0, 0.0), (None, 1.0)], "m double, s double")
    p = [r[0] for r in df.select(fn.normal_two_sided_p("m", "s")).collect()]
    assert p[0] == pytest.approx(0.0499957902964409, rel=1e-12)
    assert p[1] == pytest.approx(p[0], rel=1e-12)
    assert p[2] == 1.0
    assert p[3] is None and p[4] is None


def test_epoch_values_are_utc(spark):
    assert one(spark, fn.epoch_to_timestamp(F.lit(0))) == datetime(1970, 1, 1)
