import random

import numpy as np
import pytest

from actionlens.operators import distribution, rank_test, ranks

from .conftest import rows_of


def sample(seed, n=400, zeros=0.5):
    """Two groups; a large part of one value, the rest spread out with ties."""
    rng = random.Random(seed)
    return [
        ("ab"[rng.random() < 0.4], 0.0 if rng.random() < zeros else round(rng.lognormvariate(3, 1.5), 1))
        for _ in range(n)
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, v double")


PROBABILITIES = [0.0, 0.025, 0.25, 0.5, 0.75, 0.975, 1.0]


@pytest.mark.parametrize("max_in_task", [1_000_000, 10])
@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_equal_numpy(spark, seed, max_in_task):
    rows = sample(seed)
    df = frame(spark, rows + [("a", None), (None, 5.0), ("b", float("nan"))])
    got = {r["g"]: r["quantiles"] for r in ranks.quantiles(df, ["g"], "v", PROBABILITIES, max_in_task).collect()}
    assert set(got) == {"a", "b"}
    for g in got:
        assert got[g] == pytest.approx(list(np.quantile([v for h, v in rows if h == g], PROBABILITIES)))


def test_quantiles_of_one_row(spark):
    got = ranks.quantiles(frame(spark, [("a", 3.0), ("b", 1.0), ("b", 2.0)]), ["g"], "v", [0.5], 1).collect()
    assert {r["g"]: r["quantiles"] for r in got} == {"a": [3.0], "b": [1.5]}


def test_rows_before_with_many_ranges(spark):
    rows = sample(3)
    ranged = ranks.with_ranges(ranks.stored_value_counts(frame(spark, rows), ["g"], "v"), 15)
    assert ranged.select("value_range").distinct().count() > 5
    offsets = ranks.range_offsets(ranged, ["g"])
    for r in ranks.with_rows_before(ranged, offsets, ["g"]).collect():
        same = [v for g, v in rows if g == r["g"]]
        assert r["rows_before"] == sum(v < r["value"] for v in same)
        assert r["rows_total"] == len(same) and r["n"] == same.count(r["value"])


def test_no_range_holds_much_more_than_its_share(spark):
    df = spark.range(20_000).selectExpr("'a' AS g", "pow(id, 3) AS v")
    ranged = ranks.with_ranges(ranks.stored_value_counts(df, ["g"], "v"), 1_000)
    assert ranged.groupBy("value_range").count().agg({"count": "max"}).first()[0] <= 1_600


def test_describe(spark):
    rows = sample(4)
    got = {r["g"]: r.asDict() for r in distribution.describe(frame(spark, rows), "g", "v").collect()}
    for g in "ab":
        v = np.array([x for h, x in rows if h == g])
        assert got[g]["n"] == len(v) and got[g]["min"] == v.min() and got[g]["max"] == v.max()
        assert [got[g][k] for k in ("mean", "std", "q25", "q50", "q75")] == pytest.approx(
            [v.mean(), v.std(ddof=1), *np.quantile(v, [0.25, 0.5, 0.75])]
        )


@pytest.mark.parametrize("bins", [1, 7, 30])
def test_histogram_equals_numpy(spark, bins):
    rows = sample(5)
    got = distribution.histogram(frame(spark, rows), "g", ("a", "b"), "v", bins).collect()
    for g in "ab":
        counts, edges = np.histogram([v for h, v in rows if h == g], bins=bins)
        filled = {r["bin"]: r for r in got if r["g"] == g}
        assert {b + 1: n for b, n in enumerate(counts) if n} == {b: r["n"] for b, r in filled.items()}
        for b, r in filled.items():
            assert (r["low"], r["high"]) == pytest.approx((edges[b - 1], edges[b]))


def test_histogram_of_a_constant(spark):
    got = distribution.histogram(frame(spark, [("a", 2.0), ("a", 2.0)]), "g", ("a",), "v", 30).collect()
    counts, _ = np.histogram([2.0, 2.0], bins=30)
    assert [(r["bin"] - 1, r["n"]) for r in got] == [(int(np.argmax(counts)), 2)]


@pytest.mark.parametrize("max_in_task", [1_000_000, 10])
def test_box_summary(spark, max_in_task):
    rows = sample(6)
    for r in distribution.box_summary(frame(spark, rows), "g", ("a", "b"), "v", max_in_task).collect():
        v = np.array([x for h, x in rows if h == r["g"]])
        q25, q50, q75 = np.quantile(v, [0.25, 0.5, 0.75])
        inside = v[(v >= q25 - 1.5 * (q75 - q25)) & (v <= q75 + 1.5 * (q75 - q25))]
        assert (r["q25"], r["q50"], r["q75"]) == pytest.approx((q25, q50, q75))
        assert (r["whisker_low"], r["whisker_high"]) == (inside.min(), inside.max())
        assert r["n_outliers"] == len(v) - len(inside)


@pytest.mark.parametrize("values_per_task", [1_000_000, 20])
def test_mann_whitney_equals_pairwise_count(spark, values_per_task):
    rows = sample(7, 120)
    a, b = [v for g, v in rows if g == "a"], [v for g, v in rows if g == "b"]
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    got = rank_test.mann_whitney(frame(spark, rows), "g", "v", ("a", "b"), values_per_task).first()
    assert got["u"] == u and (got["n_first"], got["n_second"]) == (len(a), len(b))
    # Tie-corrected variance from the tie counts.
    n, ties = len(rows), np.unique([v for _, v in rows], return_counts=True)[1].astype(float)
    sigma = np.sqrt(len(a) * len(b) / 12 * (n + 1 - (ties**3 - ties).sum() / (n * (n - 1))))
    assert got["sigma_u"] == pytest.approx(sigma)
    assert got["z"] == pytest.approx((abs(u - len(a) * len(b) / 2) - 0.5) / sigma)
    assert 0 < got["p_value"] <= 1


def test_same_answer_from_both_ways(spark):
    df = frame(spark, sample(8))
    small = rows_of(ranks.quantiles(df, ["g"], "v", [0.1, 0.9], 1_000_000).selectExpr("g", "quantiles[0]", "quantiles[1]"))
    ranged = rows_of(ranks.quantiles(df, ["g"], "v", [0.1, 0.9], 5).selectExpr("g", "quantiles[0]", "quantiles[1]"))
    for s, r in zip(small, ranged):
        assert s[0] == r[0] and s[1:] == pytest.approx(r[1:])


def test_few_rows(spark):
    empty = frame(spark, [])
    assert ranks.quantiles(empty, ["g"], "v", [0.5], 0).count() == 0
    assert rank_test.mann_whitney(empty, "g", "v", ("a", "b")).first()["p_value"] is None
    assert rank_test.mann_whitney(frame(spark, [("a", 1.0)]), "g", "v", ("a", "b")).first()["p_value"] is None
    same = rank_test.mann_whitney(frame(spark, [("a", 1.0), ("b", 1.0)]), "g", "v", ("a", "b")).first()
    assert (same["u"], same["mean_u"], same["sigma_u"], same["p_value"]) == (0.5, 0.5, 0.0, None)
    assert distribution.histogram(empty, "g", ("a",), "v", 3).count() == 0
    assert distribution.box_summary(empty, "g", ("a",), "v").count() == 0
