from datetime import date, datetime

from pyspark.sql import functions as F

from actionlens.operators.first_seen import first_seen
from actionlens.plans import daily, publish, slots
from actionlens.sources import fixtures, readers, sinks

from .conftest import rows_of

SF = "/root/testdata/sf0.01"
AS_OF = date(2024, 1, 31)


def test_reports_are_stored_once_per_day(spark, tmp_path):
    feed = fixtures.feed(spark, SF)
    actions = readers.all_actions(feed, fixtures.messages(spark, SF))
    folder = str(tmp_path)
    for as_of in (date(2024, 1, 30), AS_OF, AS_OF):
        publish.publish_app_report(actions, as_of, folder, first_seen(actions))
        publish.publish_feed_report(feed, as_of, folder)
    for name, series in (("app", daily.app_series(actions, AS_OF)), ("feed", daily.feed_series(feed, AS_OF))):
        stored = sinks.read_report(spark, f"{folder}/{name}_series", AS_OF).drop("as_of")
        assert rows_of(stored) == rows_of(series)
        texts = sinks.read_report(spark, f"{folder}/{name}_text").orderBy("as_of").collect()
        assert [r["date"] for r in texts] == [date(2024, 1, 29), date(2024, 1, 30)]
    assert "dau - 127" in texts[1]["message"]


def test_alerts_of_one_day_stay_apart(spark, tmp_path):
    feed = fixtures.feed(spark, "/root/testdata/sf0.1")
    path = f"{tmp_path}/alerts"
    border = F.expr("timestamp_ntz'2024-01-30 12:00:00'")
    publish.publish_alerts(feed.filter(F.col("time") < border), path, date(2024, 1, 30))
    for _ in range(2):
        alerts = publish.publish_alerts(feed, path, date(2024, 1, 30))
    assert rows_of(alerts) == rows_of(slots.alert_records(slots.slot_anomalies(feed)))
    stored = sinks.read_alerts(spark, path)
    assert stored.count() == 8 and stored.select("slot").distinct().count() == 2


def test_a_rerun_without_rows_clears_its_day(spark, tmp_path):
    report = spark.createDataFrame([(1, datetime(2024, 1, 31, 10, 15))], "x long, time timestamp_ntz")
    for path, write in (
        (f"{tmp_path}/r", lambda df: sinks.write_report(df, f"{tmp_path}/r", AS_OF)),
        (f"{tmp_path}/a", lambda df: sinks.write_alerts(df, f"{tmp_path}/a", datetime(2024, 1, 31, 10, 20))),
    ):
        read = lambda: (sinks.read_report if path.endswith("/r") else sinks.read_alerts)(spark, path)
        write(report)
        assert read().count() == 1
        write(report.limit(0))
        assert read().count() == 0


def test_first_seen_is_kept(spark, tmp_path):
    actions = readers.all_actions(fixtures.feed(spark, SF), fixtures.messages(spark, SF))
    days = [date(2024, 1, d) for d in (2, 3, 5)]
    for previous, day in zip([None, *days], days):
        kept = publish.publish_first_seen(actions, day, f"{tmp_path}/first_seen", previous)
    before = actions.filter(F.col("time") < daily.midnight(days[-1]))
    assert rows_of(kept) == rows_of(first_seen(before))
    publish.publish_app_report(actions, date(2024, 1, 6), str(tmp_path), previous=days[-1])
    stored = sinks.read_report(spark, f"{tmp_path}/app_series").drop("as_of")
    assert rows_of(stored) == rows_of(daily.app_series(actions, date(2024, 1, 6)))


def test_report_from_first_seen_in_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(publish.publish_first_seen_buckets, "__defaults__", (None, 4))
    actions = readers.all_actions(fixtures.feed(spark, SF), fixtures.messages(spark, SF))
    table = f"seen_{tmp_path.name.replace('-', '_')}"
    for previous, as_of in ((None, date(2024, 1, 4)), (date(2024, 1, 4), date(2024, 1, 6))):
        publish.publish_app_report(actions, as_of, str(tmp_path), previous=previous, table=table)
    stored = sinks.read_report(spark, f"{tmp_path}/app_series", date(2024, 1, 6)).drop("as_of")
    assert rows_of(stored) == rows_of(daily.app_series(actions, date(2024, 1, 6)))


def test_series_ends_with_its_day(spark):
    series = slots.slot_series(fixtures.feed(spark, SF), date(2024, 1, 20))
    assert series.count() > 0 and series.agg(F.max("time")).first()[0].date() <= date(2024, 1, 20)
