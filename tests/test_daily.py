from datetime import date

from pyspark.sql import functions as F

from actionlens.operators.first_seen import first_seen, merge_first_seen
from actionlens.plans import daily
from actionlens.sources import fixtures, readers

from .conftest import plan_of, rows_of

SF = "/root/testdata/sf0.01"


def test_app_series_literal(actions):
    log = actions(
        (1, "2024-01-01 10:00:00", "view"),
        (1, "2024-01-02 10:00:00", "view"),
        (1, "2024-01-02 11:00:00", "like"),
        (2, "2024-01-02 12:00:00", "mess"),
        (3, "2024-01-02 12:00:00", "view"),
        (3, "2024-01-03 00:00:00", "view"),  # today: not reported
    )
    got = rows_of(daily.app_series(log, date(2024, 1, 3)))
    assert got == [
        (date(2024, 1, 1), 1, 1, 1, 1.0, 1.0, 0.0, 0.0),
        (date(2024, 1, 2), 3, 2, 4, 1.33, 0.66, 0.33, 0.33),
    ]


def test_first_seen_reaches_back_before_the_span(actions):
    log = actions((1, "2023-06-01 00:00:00", "view"), (1, "2024-01-02 10:00:00", "view"))
    assert rows_of(daily.app_report(log, date(2024, 1, 3)))[0][:3] == (date(2024, 1, 2), 1, 0)


def test_span_ends_are_half_open(actions):
    log = actions(
        (1, "2023-12-26 23:59:59", "view"),
        (1, "2023-12-27 00:00:00", "view"),
        (1, "2024-01-02 23:59:59", "view"),
        (1, "2024-01-03 00:00:00", "view"),
    )
    days = [r[0] for r in rows_of(daily.app_series(log, date(2024, 1, 3)))]
    assert days == [date(2023, 12, 27), date(2024, 1, 2)]


def test_empty_day_gives_no_row(actions):
    assert rows_of(daily.app_report(actions((1, "2024-01-01 10:00:00", "view")), date(2024, 3, 1))) == []


def test_unknown_actions_and_users(actions):
    log = actions(
        (None, "2024-01-02 10:00:00", "view"),
        (1, "2024-01-02 10:00:00", None),
        (1, "2024-01-02 10:00:01", "share"),
    )
    # A row without a user counts as an action, not as a user; one without an action only as a user.
    assert rows_of(daily.app_report(log, date(2024, 1, 3)))[0][1:4] == (1, 1, 2)


def test_feed_report_without_views(actions):
    log = actions((1, "2024-01-02 10:00:00", "like"))
    assert rows_of(daily.feed_report(log, date(2024, 1, 3))) == [(date(2024, 1, 2), 1, 0, 1, None)]


def test_feed_rate_is_cut_after_scaling(actions):
    log = actions(*[(i, "2024-01-02 10:00:00", a) for i, a in enumerate(["view"] * 3 + ["like"] * 2)])
    assert rows_of(daily.feed_report(log, date(2024, 1, 3)))[0][4] == 66.66


def test_new_by_second_equals_new_by_first_day(spark):
    log = readers.all_actions(fixtures.feed(spark, SF), fixtures.messages(spark, SF))
    by_second = (
        daily.label_new(log)
        .filter("category = 'new'")
        .groupBy(F.to_date("time").alias("date"))
        .agg(F.count_distinct("user_id").alias("new_users"))
    )
    by_day = daily.app_series(log, date(2024, 1, 31), days=30).filter("new_users > 0").select("date", "new_users")
    assert rows_of(by_second) == rows_of(by_day)
    assert sum(r[1] for r in rows_of(by_day)) == log.select("user_id").distinct().count()


def test_union_keeps_every_row(spark):
    feed, messages = fixtures.feed(spark, SF), fixtures.messages(spark, SF)
    assert readers.all_actions(feed, messages).count() == feed.count() + messages.count()


def test_merge_equals_rebuild_in_any_order_and_twice(spark):
    log = readers.all_actions(fixtures.feed(spark, SF), fixtures.messages(spark, SF))
    border = F.expr("timestamp_ntz'2024-01-02 12:00:00'")
    early, late = log.filter(F.col("time") < border), log.filter(F.col("time") >= border)
    whole = rows_of(first_seen(log))
    assert rows_of(merge_first_seen(first_seen(early), late)) == whole
    late_first = merge_first_seen(first_seen(late), early)
    assert rows_of(merge_first_seen(late_first, early)) == whole


def test_report_days_reach_the_scan(spark):
    log = readers.all_actions(fixtures.feed(spark, SF), fixtures.messages(spark, SF))
    known = first_seen(log)
    plan = plan_of(daily.feed_series(fixtures.feed(spark, SF), date(2024, 1, 31)))
    assert "GreaterThanOrEqual(ts,2024-01-24T00:00)" in plan and "LessThan(ts,2024-01-31T00:00)" in plan
    plan = plan_of(daily.app_series(log, date(2024, 1, 31), known_first_seen=known))
    assert "GreaterThanOrEqual(ts,2024-01-24T00:00)" in plan
    # No join by user, no distinct expansion.
    assert "SortMergeJoin [user_id" not in plan and "BroadcastHashJoin [user_id" not in plan and "Expand" not in plan


def test_texts(actions):
    log = actions((1, "2024-01-02 10:00:00", "view"), (1, "2024-01-02 11:00:00", "like"))
    text = daily.feed_report_text(daily.feed_report(log, date(2024, 1, 3))).first()["message"]
    assert text == "Feed report for 2024-01-02\ndau - 1\nview - 1\nlike - 1\nctr - 100.00%"
    text = daily.app_report_text(daily.app_report(log, date(2024, 1, 3))).first()["message"]
    assert "Daily audience: 1\nNew users: 1\nAll actions: 2\nActions per user: 2.00" in text
