"""Stored states that merge: activity bits, passages, profiles, sketches, buckets and versions."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from actionlens.functions import day_of, timestamp_to_epoch
from actionlens.operators import audit, passages, profile, value_sketches
from actionlens.operators.first_seen import first_seen
from actionlens.plans import activity_bits, ingame, publish, retention
from actionlens.sources import bucketed, schemas, sinks, versions

from .conftest import plan_of, rows_of

DAY = 86_400


# Activity bits


@pytest.fixture
def sessions(spark):
    r = random.Random(3)
    regs = [(u, r.randint(0, 40 * DAY)) for u in range(60)] + [(5, 41 * DAY), (None, 3), (70, None)]
    auths = [(r.randint(0, 65), r.randint(0, 200 * DAY)) for _ in range(1500)] + [(1, r.randint(0, 200 * DAY)) for _ in range(800)]
    auths += [(u, t) for u, t in regs if u is not None and t is not None] + [(None, 5), (3, None)]
    return spark.createDataFrame(regs, "uid long, reg_ts long"), spark.createDataFrame(auths, "uid long, auth_ts long")


def test_bits_give_the_curves(spark, sessions):
    regs, auths = sessions
    state = activity_bits.activity_bits(regs, auths.limit(0))
    for low, high in ((0, 30), (30, 100), (90, 300), (30, 100)):  # days that overlap, and a run that is repeated
        part = auths.filter(F.col("auth_ts").between(low * DAY, high * DAY))
        state = activity_bits.merge_bits(state, activity_bits.activity_bits(regs, part))
    assert rows_of(activity_bits.retention_curve(state, 200)) == rows_of(retention.retention_overall(regs, auths, 200))
    for horizon in (14, 63, 64, 150):
        assert rows_of(activity_bits.cohort_curves(state, horizon)) == rows_of(retention.retention_cohorts(regs, auths, horizon))
    since = date(1970, 2, 1)
    assert rows_of(activity_bits.cohort_curves(state, 14, since)) == rows_of(retention.retention_cohorts(regs, auths, 14, since))
    assert state.filter("uid = 1").count() <= 4 and state.filter("word >= 1").count() > 0


# Passages


def reached(events, steps):
    """Steps passed by a user, each at or after the second of the one before."""
    at, passed = None, 0
    for k in range(steps):
        fits = [s for s, step in events if step == k and (at is None or s >= at)]
        if not fits:
            break
        at, passed = min(fits), k + 1
    return passed


def test_passages_compose_to_the_funnel(spark):
    r = random.Random(5)
    start = datetime(2024, 1, 1)
    rows = [(u, start + timedelta(seconds=r.randint(0, 6) * DAY // 2 + r.randint(0, 4)), r.choice("abcdx")) for u in range(80) for _ in range(r.randint(1, 14))]
    rows += [(900, start + timedelta(seconds=r.randint(0, 3 * DAY)), r.choice("abx")) for _ in range(900)]  # almost half of all rows
    df = spark.createDataFrame([*rows, (None, start, "a")], "user_id long, time timestamp_ntz, action string")
    names = ["a", "b", "c", "d"]
    conditions = [F.col("action") == x for x in names]
    days = passages.day_passages(df, "user_id", day_of("time"), timestamp_to_epoch("time"), conditions)
    users = {x["user"]: x["passage"] for x in passages.merged_passages(days, ["user"]).collect()}
    for u in {u for u, _, _ in rows}:
        events = [(t, names.index(a)) for x, t, a in rows if x == u and a in names]
        if events:
            assert users[u][0] == reached(events, 4)
    funnel = ingame.event_funnel(df, list(zip(names, conditions)))
    want = [sum(reached([(t, names.index(a)) for x, t, a in rows if x == u and a in names], 4) > k for u in {u for u, _, _ in rows}) for k in range(4)]
    assert [x["users"] for x in funnel.orderBy("step_number").collect()] == want
    # Spans made from days compose to the same.
    early, late = (passages.merged_passages(days.filter(cond), ["user"]) for cond in ("day < '2024-01-03'", "day >= '2024-01-03'"))
    both = early.withColumn("day", F.lit(1)).unionByName(late.withColumn("day", F.lit(2)))
    assert {x["user"]: x["passage"] for x in passages.merged_passages(both, ["user"]).collect()} == users
    assert "Window" not in plan_of(funnel)
    assert passages.step_counts(days.limit(0), 4).first()[:] == (0, 0, 0, 0)


def test_composing_is_associative(spark):
    r = random.Random(6)
    rows = [[sorted(r.randint(i, 3) for i in range(4)) for _ in range(3)] for _ in range(50)]
    df = spark.createDataFrame(rows, "a array<int>, b array<int>, c array<int>")
    left = passages.composed(passages.composed(F.col("a"), F.col("b")), F.col("c"))
    right = passages.composed(F.col("a"), passages.composed(F.col("b"), F.col("c")))
    assert df.where(left != right).count() == 0


# Activity as sessions


def test_sessions_equal_the_sum_of_pauses(spark):
    r = random.Random(7)
    start = datetime(2024, 1, 1, 10)
    times = {u: sorted({r.randint(0, 16 * DAY) for _ in range(400)} | {r.randint(0, 20_000) for _ in range(50)}) for u in range(12)}
    # Pauses of exactly the gap, and one second more; a pause over the border of a day since exposure.
    times[20] = [0, 1800, 3601, DAY - 900, DAY + 900, DAY + 2701]
    times[21] = [5]
    times[22] = [r.randint(0, 3 * DAY) for _ in range(5000)]
    rows = [(u, start + timedelta(seconds=t)) for u, ts in times.items() for t in ts] + [(1, None), (None, start)]
    rows += [(99, start + timedelta(seconds=t)) for t in range(50)]  # not exposed
    df = spark.createDataFrame(rows, "user_id long, time timestamp_ntz")
    first = int((start - datetime(1970, 1, 1)).total_seconds())
    exposed = {u: first + (0 if u >= 20 else r.randint(0, DAY)) for u in times}
    segment = {u: "ab"[u % 2] for u in times}
    frame = spark.createDataFrame([(u, exposed[u], segment[u]) for u in times], "user_id long, exposed_at long, segment string")
    days = (0, 1, 7, 14)
    want = {(s, d): 0 for s in "ab" for d in days}
    for u, ts in times.items():
        seconds = sorted({first + t for t in ts})
        for a, b in zip(seconds, seconds[1:]):
            day = (a - exposed[u]) // DAY
            if b - a <= 1800 and day in days:
                want[segment[u], day] += b - a
    got = ingame.event_activity_by_day(df, frame, days, 1800)
    assert {(x["segment"], x["day_number"]): x["seconds"] for x in got.collect()} == want


def test_many_exposed_users(spark, monkeypatch):
    df = spark.createDataFrame([(u, datetime(2024, 1, 1, 10, 0, s)) for u in range(30) for s in (0, 7, 7)], "user_id long, time timestamp_ntz")
    exposed = ingame.exposed_users(df, F.lit(True)).filter("user_id < 20")
    few = rows_of(ingame.event_activity_by_day(df, exposed, (0,)))
    monkeypatch.setattr(ingame, "MAX_BROADCAST_ROWS", 0)
    assert rows_of(ingame.event_activity_by_day(df, exposed, (0,))) == few == [("all", 0, 20, 140, 7.0)]


def test_sessions_on_a_stream(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = [(u, start + timedelta(seconds=t)) for u in (1, 2) for t in (0, 100, 1900, 10_000, 10_010)] + [(3, start + timedelta(days=1))]
    df = spark.createDataFrame(rows, "user_id long, time timestamp_ntz")
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    seconds = lambda x: x.select("user_id", timestamp_to_epoch("time").alias("second")).withColumn("instant", F.timestamp_seconds("second"))
    stream = seconds(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")).withWatermark("instant", "0 seconds")
    query = (
        ingame.user_sessions(stream, ["user_id"], F.col("instant")).select("user_id", "first_second", "last_second")
        .writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(f"{tmp_path}/out")
    )
    query.awaitTermination()
    batch = ingame.user_sessions(seconds(df), ["user_id"], F.col("instant")).select("user_id", "first_second", "last_second")
    live = rows_of(spark.read.parquet(f"{tmp_path}/out"))
    assert live == [x for x in rows_of(batch) if x[0] != 3] and len(live) == 4


# Profiles


def test_profile_equals_the_separate_audits(spark):
    nan = float("nan")
    rows = [(1, "a", 1.5, date(2024, 1, 1), [1, None]), (1, "a", 1.5, date(2024, 1, 1), [1, None]), (None, "", None, None, None), (None, None, nan, None, []), (None, None, None, None, []), (2, "1:a", 0.0, None, [1]), (2, "1", 0.0, None, [1])]
    df = spark.createDataFrame(rows * 3 + [(7, "x" * 1000, 2.0, None, [5])], "id long, s string, x double, `odd name` date, list array<int>")
    columns, duplicates, unique = profile.profile(df, ["id", "s"])
    assert {r["column_name"]: r["nulls"] for r in columns.collect()} == {r["column_name"]: r["nulls"] for r in audit.null_counts(df).collect()}
    assert {r["column_name"]: r["data_type"] for r in columns.collect()} == dict(df.dtypes)
    assert duplicates.first()["duplicates"] == audit.duplicate_rows(df).first()["duplicates"] == 15 and duplicates.first()["rows"] == 22
    for key in ("id", "s"):
        assert tuple(unique[key].first()) == tuple(audit.key_uniqueness(df, key).first())
    parts = [profile.profile_state(df.filter("id = 1"), ["id"]), profile.profile_state(df.filter("id IS NULL OR id <> 1"), ["id"])]
    assert rows_of(profile.duplicates_of(profile.merge_states(*parts))) == rows_of(duplicates)
    empty = profile.profile(df.limit(0), ["id"])
    assert tuple(empty[1].first()) == (0, 0, 0) and tuple(empty[2]["id"].first()) == (0, 0, True)
    assert {r["nulls"] for r in empty[0].collect()} == {0}


def test_profile_reads_once_and_takes_many_columns(spark, tmp_path):
    wide = spark.range(50).select("id", *(F.when(F.col("id") % (i + 2) > 0, F.col("id")).alias(f"c{i}") for i in range(130)))
    wide.write.parquet(f"{tmp_path}/wide")
    df = spark.read.parquet(f"{tmp_path}/wide")
    assert plan_of(profile.profile_state(df)).split("(1)", 2)[0].count("Scan parquet") == 1
    got = {r["column_name"]: r["nulls"] for r in profile.columns_of(profile.profile_state(df), df.dtypes).collect()}
    assert got == {r["column_name"]: r["nulls"] for r in audit.null_counts(df).collect()} and len(got) == 131


# Sketches


def test_sketches_merge_within_their_error(spark):
    r = random.Random(8)
    values = [(r.choice("ab"), date(2024, 1, 1 + r.randint(0, 9)), r.lognormvariate(3, 1)) for _ in range(40_000)]
    df = spark.createDataFrame([*values, ("a", date(2024, 1, 1), None), ("a", date(2024, 1, 1), float("nan")), (None, date(2024, 1, 1), 1.0)], "g string, d date, v double")
    sketches = value_sketches.day_sketches(df.repartition(9), "g", F.col("d"), "v")
    assert sketches.count() == 20
    probabilities = [0.01, 0.25, 0.5, 0.75, 0.99]
    for first, last in ((1, 10), (3, 4)):
        got = value_sketches.quantiles_of_days(sketches, date(2024, 1, first), date(2024, 1, last), probabilities)
        for row in got.collect():
            mine = sorted(v for g, d, v in values if g == row["group"] and first <= d.day <= last)
            assert (row["n"], row["low"], row["high"]) == (len(mine), mine[0], mine[-1])
            for p, q in zip(probabilities, row["quantiles"]):
                rank = sum(v <= q for v in mine) / len(mine)
                assert abs(rank - p) <= value_sketches.RANK_ERROR + 1 / len(mine)
    assert value_sketches.box_of_days(sketches, date(2023, 1, 1), date(2023, 1, 2)).count() == 0


# Buckets


def test_the_stored_side_is_not_moved(spark, tmp_path):
    start = datetime(2024, 1, 1)
    actions = spark.createDataFrame([(u, start + timedelta(hours=u % 70 + k), "view") for u in range(400) for k in range(3)] + [(None, start, "view")], "user_id long, time timestamp_ntz, action string")
    name = f"seen_{tmp_path.name.replace('-', '_')}"
    days = [date(2024, 1, 2), date(2024, 1, 3), date(2024, 1, 5)]
    for previous, day in zip([None, *days], days):
        kept = publish.publish_first_seen_buckets(actions, day, str(tmp_path), name, previous, buckets=4)
    assert rows_of(kept) == rows_of(first_seen(actions))
    known = bucketed.open_bucketed(spark, f"{tmp_path}/as_of=2024-01-03", f"{name}_20240103", schemas.FIRST_SEEN, "user_id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from actionlens.operators.first_seen import merge_into_buckets

        plan = merge_into_buckets(known, actions)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    stored, new = plan.split("FileScan")[0], plan
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    # One exchange, of the new users; none between the join and the stored table.
    assert new.count("Exchange hashpartitioning") == 1 and "Exchange" not in stored.split("SortMergeJoin")[1]


# Versions


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    path = f"{tmp_path}/report"
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, path)
    report = spark.range(3).withColumnRenamed("id", "x")
    sinks.write_report(report, path, date(2024, 1, 1))
    before = versions.current_version(spark, path)
    opened = sinks.read_report(spark, path)
    failing = spark.range(1000).select((F.col("id") + F.raise_error(F.lit("broken half way")).cast("long")).alias("x"))
    with pytest.raises(Exception, match="broken half way"):
        sinks.write_report(failing, path, date(2024, 1, 1))
    assert versions.current_version(spark, path) == before and sinks.read_report(spark, path).count() == 3
    sinks.write_report(report.limit(1), path, date(2024, 1, 1))
    sinks.write_report(report, path, date(2024, 1, 2))
    assert rows_of(sinks.read_report(spark, path)) == [(0, date(2024, 1, 1))] + [(i, date(2024, 1, 2)) for i in range(3)]
    # What was opened before still shows the old version, and readers can go back to it.
    assert opened.count() == 3
    versions.point_to(spark, path, before)
    assert sinks.read_report(spark, path, date(2024, 1, 1)).count() == 3
    gone = versions.drop_versions(spark, path, keep=1)
    assert len(gone) >= 2 and before not in gone and sinks.read_report(spark, path).count() == 3
