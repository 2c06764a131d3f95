from datetime import date

import pytest
from pyspark.errors import PySparkException

from actionlens.plans import daily, slots
from actionlens.sources import readers, schemas, sinks

from .conftest import at, plan_of, rows_of


def test_delimited_files(spark, tmp_path):
    (tmp_path / "reg.csv").write_text("reg_ts;uid\n1577836800;1\n1577836801;2\n")
    (tmp_path / "auth.csv").write_text("auth_ts;uid\n1577836800;1\n")
    (tmp_path / "ab.csv").write_text("user_id;revenue;testgroup\n1;0;b\n2;12.5;a\n")
    (tmp_path / "units.csv").write_text(
        "dwarf_id,hired_date,reported_date,gold_mined,hammer_date\n7,2014-01-02,2014-02-03,1.5,2014-01-01\n"
    )
    assert rows_of(readers.read_registrations_csv(spark, f"{tmp_path}/reg.csv")) == [(1577836800, 1), (1577836801, 2)]
    assert rows_of(readers.read_sessions_csv(spark, f"{tmp_path}/auth.csv")) == [(1577836800, 1)]
    assert rows_of(readers.read_experiment_csv(spark, f"{tmp_path}/ab.csv")) == [(1, 0.0, "b"), (2, 12.5, "a")]
    assert rows_of(readers.read_unit_reports_csv(spark, f"{tmp_path}/units.csv")) == [
        (7, date(2014, 1, 2), date(2014, 2, 3), 1.5, "2014-01-01")
    ]


def test_malformed_files_fail(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("reg_ts;uid\nyesterday;1\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        readers.read_registrations_csv(spark, f"{tmp_path}/bad.csv").collect()
    (tmp_path / "swapped.csv").write_text("uid;reg_ts\n1;1577836800\n")
    with pytest.raises(Exception, match="header"):
        readers.read_registrations_csv(spark, f"{tmp_path}/swapped.csv").collect()


def test_tables_and_queries(spark, tmp_path, actions):
    log = actions((1, "2024-01-01 10:00:00", "view"), (2, "2024-01-02 10:00:00", "like"))
    log.selectExpr("user_id", "time", "action", "1 AS extra").write.parquet(f"{tmp_path}/feed")
    read = readers.read_parquet(spark, f"{tmp_path}/feed", schemas.FEED_ACTIONS)
    assert read.columns == ["user_id", "time", "action"]
    assert rows_of(read) == rows_of(log)
    log.createOrReplaceTempView("feed_table")
    assert rows_of(readers.read_table(spark, "feed_table", schemas.FEED_ACTIONS)) == rows_of(log)
    assert readers.read_query(spark, "SELECT count(*) FROM {feed}", feed=log).first()[0] == 2
    with pytest.raises(PySparkException):
        readers.feed_actions(log.drop("action"))


def test_messages_are_tagged(actions):
    log = actions((1, "2024-01-01 10:00:00", "view"))
    both = readers.all_actions(readers.feed_actions(log), readers.message_actions(log))
    assert rows_of(both) == [(1, at("2024-01-01 10:00:00"), "mess"), (1, at("2024-01-01 10:00:00"), "view")]


def test_writes_replace_only_their_partitions(spark, tmp_path, actions):
    path = f"{tmp_path}/actions"
    first = actions((1, "2024-01-01 10:00:00", "view"), (2, "2024-01-02 10:00:00", "like"))
    sinks.write_actions(first, path)
    again = actions((3, "2024-01-02 11:00:00", "view"))
    for _ in range(2):
        sinks.write_actions(again, path)
    got = rows_of(spark.read.parquet(path).select("user_id", "day"))
    assert got == [(1, date(2024, 1, 1)), (3, date(2024, 1, 2))]


def test_reports_and_alerts(spark, tmp_path, actions):
    log = actions((1, "2024-01-01 10:00:00", "view"), (1, "2024-01-02 10:00:00", "view"))
    for as_of in (date(2024, 1, 2), date(2024, 1, 3), date(2024, 1, 3)):
        report = daily.feed_report(log, as_of)
        sinks.write_report(report, f"{tmp_path}/report", as_of)
        sinks.write_report(daily.feed_report_text(report), f"{tmp_path}/text", as_of)
    got = rows_of(sinks.read_report(spark, f"{tmp_path}/report").select("as_of", "date", "dau"))
    assert got == [(date(2024, 1, 2), date(2024, 1, 1), 1), (date(2024, 1, 3), date(2024, 1, 2), 1)]
    assert sinks.read_report(spark, f"{tmp_path}/text").count() == 2

    log = actions(*[(u, f"2024-01-{d:02d} 12:00:00", "view") for d in range(1, 5) for u in range(d)], (0, "2024-01-04 12:15:00", "view"))
    sinks.write_alerts(slots.alert_records(slots.slot_anomalies(log)), f"{tmp_path}/alerts")
    assert sinks.read_alerts(spark, f"{tmp_path}/alerts").filter("day = '2024-01-04'").count() == 4


def test_days_are_pruned(spark, tmp_path, actions):
    log = actions(*[(d, f"2024-01-{d:02d} 10:00:00", "view") for d in range(1, 11)])
    sinks.write_actions(log, f"{tmp_path}/feed")
    days = readers.read_days(spark, f"{tmp_path}/feed", schemas.FEED_ACTIONS, date(2024, 1, 3), date(2024, 1, 9))
    assert rows_of(daily.feed_series(days, date(2024, 1, 10))) == rows_of(daily.feed_series(log, date(2024, 1, 10)))
    assert "PartitionFilters: [isnotnull(day" in plan_of(days)
