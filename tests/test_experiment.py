import pytest

from actionlens.plans import experiment as ex

from .conftest import rows_of


@pytest.fixture
def table(spark):
    rows = [(1, "a", 0.0), (2, "a", 10.0), (3, "a", 50_000.0), (4, "a", 0.0), (5, "b", 20.0), (6, "b", 0.0), (7, None, 5.0)]
    return spark.createDataFrame(rows, "user_id long, testgroup string, revenue double")


def test_summary_uses_the_own_group_size(table):
    assert rows_of(ex.ab_summary(table)) == [("a", 4, 2, 0.5, 25_005.0, 12_502.5), ("b", 2, 1, 0.5, 20.0, 10.0)]


def test_study_group_sizes(spark):
    sizes = {"a": (202_103, 1_928), "b": (202_667, 1_805)}
    table = None
    for group, (users, payers) in sizes.items():
        part = spark.range(users).selectExpr("id AS user_id", f"'{group}' AS testgroup", f"CAST(IF(id < {payers}, 100, 0) AS DOUBLE) AS revenue")
        table = part if table is None else table.unionByName(part)
    got = {r["testgroup"]: r for r in ex.ab_summary(table).collect()}
    for group, (users, payers) in sizes.items():
        assert (got[group]["users"], got[group]["payers"]) == (users, payers)
        assert got[group]["conversion"] == payers / users


def test_describe_payers(table):
    got = {r["testgroup"]: r for r in ex.describe_payers(table).collect()}
    assert (got["a"]["n"], got["a"]["q50"]) == (2, 25_005.0)
    assert got["b"]["std"] is None


def test_sensitivity(table):
    got = {(r["testgroup"], r["variant"]): r for r in ex.outlier_sensitivity(table).collect()}
    assert len(got) == 4
    assert (got["a", "all"]["users"], got["a", "cut"]["users"]) == (4, 3)
    assert got["a", "cut"]["conversion"] == 1 / 3 and got["a", "cut"]["q50"] == 10.0
    assert ex.without_outliers(table).filter("testgroup = 'a'").count() == 3


def test_text(table):
    got = {r["testgroup"]: r["message"] for r in ex.ab_summary_text(ex.ab_summary(table)).collect()}
    assert got["b"] == "Conversion of group b: 50.00%, revenue per payer: 20.00, revenue per user: 10.00"


def test_nan_is_no_payer(spark):
    from actionlens.plans import experiment

    rows = [(1, "a", 5.0), (2, "a", float("nan")), (3, "a", 0.0)]
    table = spark.createDataFrame(rows, "user_id long, testgroup string, revenue double")
    row = experiment.ab_summary(table).first()
    assert (row["users"], row["payers"], row["arppu"], row["arpu"]) == (3, 1, 5.0, 2.5)
    described = experiment.describe_payers(table).first()
    assert (described["n"], described["mean"]) == (1, 5.0)
