from pyspark.sql import functions as F

from actionlens.operators import audit
from actionlens.operators.hot_keys import join_per_key

from .conftest import plan_of, rows_of


def test_audit(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "x"), (2, None), (None, None)], "k long, s string")
    assert rows_of(audit.null_counts(df)) == [("k", 1), ("s", 2)]
    assert rows_of(audit.column_types(df)) == [("k", "bigint", 4), ("s", "string", 3)]
    assert rows_of(audit.duplicate_rows(df)) == [(2,)]
    assert rows_of(audit.key_uniqueness(df, "k")) == [(5, 2, False)]
    assert rows_of(audit.key_uniqueness(df.filter("k = 2"), "k")) == [(1, 1, True)]
    assert rows_of(audit.unmatched_rows(df, df.filter("k = 2"), "k")) == [(4,)]


def test_audit_of_nothing(spark):
    df = spark.createDataFrame([], "k long, s string")
    assert rows_of(audit.null_counts(df)) == [("k", 0), ("s", 0)]
    assert rows_of(audit.duplicate_rows(df)) == [(0,)]
    assert rows_of(audit.key_uniqueness(df, "k")) == [(0, 0, True)]


def test_hot_key_join_equals_plain_join(spark):
    facts = spark.range(3_000).selectExpr("IF(id % 3 = 0, 7, IF(id % 500 = 1, NULL, id % 500)) AS k", "id AS v")
    known = facts.filter("k IS NOT NULL AND k <> 8")
    per_key = known.groupBy("k").agg(F.min("v").alias("first"), F.count("*").alias("n"))
    plain = rows_of(facts.join(per_key.drop("n"), "k", "left"))
    assert len(plain) == 3_000
    hot = join_per_key(facts, per_key, "k", "n", min_hot_rows=100)
    assert rows_of(hot) == plain and "LeftAnti" in plan_of(hot)
    cold = join_per_key(facts, per_key, "k", "n")
    assert rows_of(cold) == plain and "LeftAnti" not in plan_of(cold)


def test_join_per_key_reads_facts_once_more(spark):
    facts = spark.range(3_000).selectExpr("IF(id % 5 = 0, NULL, id % 50) AS k", "id AS v")
    per_key = facts.filter("k IS NOT NULL").groupBy("k").agg(F.max("v").alias("last"), F.count("*").alias("n"))
    joined = join_per_key(facts, per_key, "k", "n")
    assert plan_of(joined).count(") Range\n") == 1
    assert rows_of(joined) == rows_of(facts.join(per_key.drop("n"), "k", "left"))


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None)], "id long, x double")
    assert {r["column_name"]: r["nulls"] for r in audit.null_counts(df).collect()} == {"id": 0, "x": 2}
