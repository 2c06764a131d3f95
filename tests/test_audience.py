from datetime import date

import pytest
from pyspark.sql import functions as F

from actionlens.functions import day_of
from actionlens.operators import distinct, numbering
from actionlens.plans import audience

from .conftest import plan_of, rows_of

DAY = {d: date(2024, 1, d) for d in range(1, 32)}


def test_numbers_are_dense_and_stay(spark):
    keys = spark.range(1000).selectExpr("id % 300 AS user_id").unionByName(spark.createDataFrame([(None,)], "user_id long"))
    first = numbering.numbered(keys.repartition(7), "user_id")
    assert sorted(r["number"] for r in first.collect()) == list(range(1, 301))
    more = numbering.extend_numbers(first, spark.range(250, 350).withColumnRenamed("id", "user_id"), "user_id")
    got = {r["user_id"]: r["number"] for r in more.collect()}
    assert {r["user_id"]: r["number"] for r in first.collect()}.items() <= got.items()
    assert sorted(got.values()) == list(range(1, 351))
    assert numbering.extend_numbers(None, keys.limit(0), "user_id").count() == 0
    assert rows_of(numbering.extend_numbers(numbering.numbered(keys.limit(0), "user_id"), spark.range(1).toDF("user_id"), "user_id")) == [(0, 1)]


def test_conditions_without_expand(actions):
    df = actions((1, "2024-01-01 10:00:00", "view"), (1, "2024-01-01 11:00:00", "like"), (2, "2024-01-01 10:00:00", None), (None, "2024-01-02 10:00:00", "like"), (2, "2024-01-03 10:00:00", "like"))
    got = distinct.distinct_by_condition(df, [day_of("time").alias("date")], "user_id", {"users": None, "likers": F.col("action") == "like"})
    assert rows_of(got, "date") == [(DAY[1], 2, 1), (DAY[2], 0, 0), (DAY[3], 1, 1)]
    assert "Expand" not in plan_of(got)


@pytest.fixture
def many(spark):
    """Users over two chunks of a bitmap; one of them has a third of all rows."""
    users = spark.range(60_000).selectExpr("id AS user_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(id % 20, id % 24) AS time", "IF(id % 3 = 0, 'like', 'view') AS action")
    hot = spark.range(30_000).selectExpr("7 AS user_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(id % 20, 1) AS time", "'view' AS action")
    return users.unionByName(hot)


def test_windows_equal_the_direct_count(many, tmp_path):
    folder = str(tmp_path)
    audience.publish_audience_days(many, DAY[1], DAY[12], folder)
    # The next run repeats a day, and has actions of the days before it again.
    states = audience.publish_audience_days(many, DAY[12], DAY[20], folder, previous=DAY[12])
    assert states.select("chunk").distinct().count() >= 2 and states.count() < 20 * 3 * 3
    got = {(r["date"], r["segment"]): (r["users_1"], r["users_7"], r["users_28"]) for r in audience.audience_series(states, DAY[1], DAY[22]).collect()}
    for segment, condition in (("users", F.lit(True)), ("likers", F.col("action") == "like"), ("viewers", F.col("action") == "view")):
        for d in (1, 5, 12, 20):
            direct = []
            for days in (1, 7, 28):
                window = many.where(condition).where(day_of("time").between(F.lit(DAY[max(1, d - days + 1)]), F.lit(DAY[d])))
                direct.append(window.agg(F.count_distinct("user_id")).first()[0])
            assert got[DAY[d], segment] == tuple(direct)
    # Windows that end after the last action.
    assert got[DAY[22], "users"][0] == 0 < got[DAY[22], "users"][1]
    both = {r["segment"]: r["users"] for r in distinct.distinct_in_both(states, (DAY[1], DAY[2]), (DAY[2], DAY[3])).collect()}
    assert both["users"] == 3000 + 1 and distinct.distinct_in_window(states, DAY[25], DAY[30]).count() == 0


def test_windows_read_stored_days_only(many, tmp_path):
    states = audience.publish_audience_days(many, DAY[1], DAY[12], str(tmp_path))
    plan = plan_of(distinct.rolling_distinct(states, 7, DAY[10], DAY[12]))
    assert "Expand" not in plan and "user_id" not in plan and "PartitionFilters" in plan and "Range" not in plan
