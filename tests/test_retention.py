import random
from datetime import date

from actionlens.plans import retention as r
from actionlens.sources import fixtures

from .conftest import plan_of, rows_of

DAY = 86_400
JAN, FEB = 1_577_836_800, 1_580_515_200  # 2020-01-01, 2020-02-01


def frames(spark, regs, auths):
    return (
        spark.createDataFrame(regs, "uid long, reg_ts long"),
        spark.createDataFrame(auths, "uid long, auth_ts long"),
    )


def brute_day_numbers(regs, auths):
    reg = dict(regs)
    return {(u, (t - reg[u]) // DAY) for u, t in auths if u in reg and t >= reg[u]}


def test_day_numbers_equal_brute_force(spark):
    rng = random.Random(5)
    regs = [(u, JAN + rng.randrange(40 * DAY)) for u in range(60)]
    auths = [(u, reg + rng.randrange(-2 * DAY, 20 * DAY)) for u, reg in regs for _ in range(rng.randrange(30))]
    auths += [(u, reg + k * DAY + d) for u, reg in regs[:10] for k in (0, 1, 3) for d in (-1, 0, 1)]
    auths += [(999, JAN)]  # no registration
    got = {(x["uid"], x["day_number"]) for x in r.user_day_numbers(*frames(spark, regs, auths)).collect()}
    assert got == brute_day_numbers(regs, auths)


def test_overall(spark):
    regs = [(u, JAN) for u in range(3)]
    auths = [(0, JAN), (1, JAN), (2, JAN), (0, JAN + DAY), (0, JAN + DAY + 5), (1, JAN + 2 * DAY), (2, JAN + 2 * DAY), (2, JAN - 1)]
    assert rows_of(r.retention_overall(*frames(spark, regs, auths))) == [(0, 3, 100.0), (1, 1, 33.33), (2, 2, 66.67)]


def test_overall_keeps_the_first_observed_numbers(spark):
    regs, auths = [(0, JAN)], [(0, JAN + 2 * k * DAY) for k in range(50)]
    got = rows_of(r.retention_overall(*frames(spark, regs, auths)))
    assert [x[0] for x in got] == [2 * k for k in range(30)]


def test_cohorts_matrix_and_horizon(spark):
    regs = [(0, JAN), (1, JAN + 5), (2, FEB)]
    auths = [(0, JAN), (1, JAN + 5), (2, FEB), (0, JAN + 3 * DAY), (2, FEB + 14 * DAY), (2, FEB + 15 * DAY)]
    long = r.retention_cohorts(*frames(spark, regs, auths))
    assert rows_of(long) == [
        (date(2020, 1, 1), 0, 2, 1.0),
        (date(2020, 1, 1), 3, 1, 0.5),
        (date(2020, 2, 1), 0, 1, 1.0),
        (date(2020, 2, 1), 14, 1, 1.0),
    ]
    wide = {x["cohort"]: x.asDict() for x in r.retention_matrix(long).collect()}
    assert wide[date(2020, 1, 1)]["day_3"] == 0.5 and wide[date(2020, 1, 1)]["day_1"] is None
    assert list(wide[date(2020, 2, 1)]) == ["cohort"] + [f"day_{d}" for d in range(15)]
    since = r.retention_cohorts(*frames(spark, regs, auths), first_cohort=date(2020, 2, 1))
    assert {x["cohort"] for x in since.collect()} == {date(2020, 2, 1)}


def test_range_bounds(spark):
    regs = [(0, JAN - 1), (1, JAN), (2, FEB - 1), (3, FEB), (4, FEB + 1)]
    auths = list(regs)
    args = (*frames(spark, regs, auths), 14, date(2020, 1, 1), date(2020, 2, 1))
    assert rows_of(r.retention_range(*args)) == [("2020-01", 0, 2, 1.0)]
    inclusive = r.retention_range(*args, inclusive_instant=True)
    assert rows_of(inclusive) == [("2020-01", 0, 2, 1.0), ("2020-02", 0, 1, 1.0)]


def test_range_equals_filtered_cohorts(spark):
    regs, auths = fixtures.registrations(spark, "/root/testdata/sf0.01"), fixtures.sessions(spark, "/root/testdata/sf0.01")
    ranged = r.retention_range(regs, auths, 14, date(1995, 3, 1), date(1995, 10, 1))
    whole = r.retention_cohorts(regs, auths).filter("cohort >= '1995-03-01' AND cohort < '1995-10-01'")
    assert rows_of(ranged) == rows_of(whole.selectExpr("substring(cast(cohort as string), 1, 7) AS cohort", "day_number", "unique_id", "share"))


def test_repeated_registrations_count_a_user_once(spark):
    regs, auths = [(0, JAN), (0, JAN), (0, JAN + 10)], [(0, JAN + 20)]
    assert rows_of(r.retention_overall(*frames(spark, regs, auths))) == [(0, 1, 100.0)]


def test_shares_are_shares(spark):
    for x in r.retention_cohorts(
        fixtures.event_registrations(spark, "/root/testdata/sf0.01"), fixtures.event_sessions(spark, "/root/testdata/sf0.01")
    ).collect():
        assert 0 < x["share"] <= 1
        assert x["day_number"] != 0 or x["share"] == 1.0


def test_raw_sessions_do_not_meet_the_join(spark):
    regs, auths = fixtures.registrations(spark, "/root/testdata/sf0.01"), fixtures.sessions(spark, "/root/testdata/sf0.01")
    plan = plan_of(r.retention_range(regs, auths, 14, date(1995, 3, 1), date(1995, 10, 1)))
    assert "CartesianProduct" not in plan and "partial_min" in plan


def test_ranges_reach_the_scan(spark, tmp_path):
    regs, auths = frames(spark, [(0, JAN)], [(0, JAN)])
    regs.write.parquet(f"{tmp_path}/regs")
    auths.write.parquet(f"{tmp_path}/auths")
    stored = spark.read.parquet(f"{tmp_path}/regs"), spark.read.parquet(f"{tmp_path}/auths")
    ranged = r.retention_range(*stored, 14, date(2020, 1, 1), date(2020, 2, 1))
    plan = plan_of(ranged)
    assert f"GreaterThanOrEqual(reg_ts,{JAN}), LessThan(reg_ts,{FEB})" in plan
    assert f"GreaterThanOrEqual(auth_ts,{JAN}), LessThanOrEqual(auth_ts,{FEB + 15 * DAY})" in plan
    assert rows_of(ranged) == [("2020-01", 0, 1, 1.0)]
