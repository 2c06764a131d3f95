import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from actionlens.plans import ingame as g

from .conftest import at, rows_of


def saw():
    return F.col("action") == "view"


def stepped():
    return F.col("action") == "click"


def test_exposed_and_segments(actions):
    log = actions(
        (1, "2024-01-01 10:00:00", "view"),
        (1, "2024-01-01 11:00:00", "click"),
        (2, "2024-01-01 09:00:00", "click"),  # before the exposure
        (2, "2024-01-01 10:00:00", "view"),
        (3, "2024-01-01 10:00:00", "click"),  # never exposed
        (4, "2024-01-02 10:00:00", "view"),
        (4, "2024-01-01 10:00:00", "view"),
    )
    exposed = g.exposed_users(log, saw(), stepped())
    assert [(r[0], r[2]) for r in rows_of(exposed)] == [(1, "participant"), (2, "spectator"), (4, "spectator")]
    assert rows_of(g.event_participation(exposed)) == [(3, 1, 1 / 3)]
    first = {r["user_id"]: r["exposed_at"] for r in g.exposed_users(log, saw()).collect()}
    assert first[4] - first[1] == 0


def test_activity_counts_everyone_exposed(actions):
    log = actions(
        (1, "2024-01-01 10:00:00", "view"),
        (1, "2024-01-01 10:10:00", "play"),
        (1, "2024-01-01 10:10:00", "play"),
        (1, "2024-01-01 11:00:00", "play"),  # after a long pause
        (1, "2024-01-02 10:05:00", "play"),
        (1, "2024-01-02 10:07:00", "play"),
        (2, "2024-01-01 10:00:00", "view"),
    )
    got = g.event_activity_by_day(log, g.exposed_users(log, saw()), days=(0, 1, 7))
    assert rows_of(got) == [("all", 0, 2, 600, 300.0), ("all", 1, 2, 120, 60.0), ("all", 7, 2, 0, 0.0)]


def test_reachable_keeps_the_pause_that_crosses_the_horizon(actions):
    log = actions(
        (1, "2024-01-01 23:50:00", "view"),
        (1, "2024-01-02 23:45:00", "play"),  # still day 0
        (1, "2024-01-02 23:49:59", "play"),
        (1, "2024-01-03 00:10:00", "play"),
        (1, "2024-01-09 00:00:00", "play"),
    )
    exposed = g.exposed_users(log, saw())
    cut = g.reachable(log, date(2024, 1, 1), date(2024, 1, 1), horizon=0)
    assert cut.count() == 4
    assert rows_of(g.event_activity_by_day(cut, exposed, (0,))) == rows_of(g.event_activity_by_day(log, exposed, (0,)))


def test_retention_and_split(actions):
    log = actions(
        (1, "2024-01-01 10:00:00", "view"),
        (1, "2024-01-01 10:05:00", "click"),
        (1, "2024-01-02 10:00:00", "play"),
        (2, "2024-01-01 10:00:00", "view"),
        (2, "2024-01-02 09:59:59", "play"),
    )
    assert rows_of(g.event_retention(log, g.exposed_users(log, saw()), (1,))) == [("all", 1, 2, 1, 0.5)]
    split = rows_of(g.event_retention(log, g.exposed_users(log, saw(), stepped()), (1,)))
    assert split == [("participant", 1, 1, 1, 1.0), ("spectator", 1, 1, 0, 0.0)]


def test_revenue_horizon(spark, actions):
    log = actions((1, "2024-01-01 10:00:00", "view"), (2, "2024-01-01 10:00:00", "view"))
    payments = spark.createDataFrame(
        [
            (1, at("2024-01-01 09:59:59"), 1.0),
            (1, at("2024-01-01 10:00:00"), 10.0),
            (1, at("2024-01-08 09:59:59"), 20.0),
            (1, at("2024-01-08 10:00:00"), 40.0),
            (1, at("2024-01-31 09:59:59"), 80.0),
            (1, at("2024-01-31 10:00:00"), 160.0),
            (3, at("2024-01-02 10:00:00"), 5.0),
        ],
        "user_id long, time timestamp_ntz, amount double",
    )
    got = rows_of(g.event_revenue(payments, g.exposed_users(log, saw()), (7, 30)), "horizon")
    assert got == [("all", 2, 7, 1, 30.0, 15.0), ("all", 2, 30, 1, 150.0, 75.0)]


def test_reactivated(actions):
    log = actions(
        (1, "2024-01-01 10:00:00", "play"),
        (1, "2024-01-04 09:59:59", "play"),  # one second short of three days
        (1, "2024-01-07 09:59:59", "play"),
        (1, "2024-01-07 20:00:00", "play"),
        (2, "2024-01-07 20:00:00", "play"),
    )
    assert rows_of(g.reactivated_users(log, 3)) == [(date(2024, 1, 7), 1)]


def test_funnel(actions):
    log = actions(
        (1, "2024-01-01 10:00:00", "s1"), (1, "2024-01-01 10:01:00", "s2"), (1, "2024-01-01 10:02:00", "s3"),
        (2, "2024-01-01 10:00:00", "s1"), (2, "2024-01-01 10:01:00", "s2"),
        (3, "2024-01-01 10:01:00", "s1"), (3, "2024-01-01 10:00:00", "s2"), (3, "2024-01-01 10:02:00", "s3"),
        (4, "2024-01-01 10:00:00", "s2"),
    )
    steps = [(s, F.col("action") == s) for s in ("s1", "s2", "s3")]
    got = rows_of(g.event_funnel(log, steps), "step_number")
    assert got == [(1, "s1", 3, 1.0, 0), (2, "s2", 2, pytest.approx(2 / 3), 1), (3, "s3", 1, pytest.approx(1 / 3), 1)]


def test_funnel_with_a_step_taken_twice(actions):
    """A click before the view does not hide the one after it."""
    log = actions(
        (1, "2024-01-01 10:00:00", "click"), (1, "2024-01-01 10:01:00", "view"), (1, "2024-01-01 10:02:00", "click"),
        (2, "2024-01-01 10:00:00", "view"), (2, "2024-01-01 10:00:00", "click"), (3, "2024-01-01 10:00:00", None),
    )
    steps = [(s, F.col("action") == s) for s in ("view", "click")]
    assert rows_of(g.event_funnel(log, steps), "step_number") == [(1, "view", 2, 1.0, 0), (2, "click", 2, 1.0, 0)]


def test_choice_share(actions):
    log = actions(*[(i, "2024-01-01 10:00:00", a) for i, a in enumerate(["hat", "hat", "hat", "coin", None])])
    assert rows_of(g.choice_share(log, "action")) == [("coin", 1, 0.25), ("hat", 3, 0.75)]


def test_churn(actions):
    log = actions(
        (1, "2024-01-01 10:00:00", "x"), (1, "2024-01-10 10:00:00", "x"), (1, "2024-01-20 10:00:00", "y"),
        (2, "2024-01-01 10:00:00", "x"), (2, "2024-01-10 10:00:00", "x"),
        (3, "2024-01-01 10:00:00", "y"), (3, "2024-01-10 10:00:00", "x"),
        (4, "2024-01-20 10:00:00", "x"), (5, "2024-01-10 10:00:00", "y"), (6, "2024-01-10 10:00:00", None),
    )
    days = [(date(2024, 1, d), date(2024, 1, d)) for d in (1, 10, 20)]
    got = rows_of(g.event_churn(log, F.col("action") == "x", *days))
    assert got == [("newcomer", 1, 1, 1.0), ("veteran", 2, 1, 0.5)]
