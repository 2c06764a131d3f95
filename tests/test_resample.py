import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from actionlens.operators import replica_state, resample

from .conftest import plan_of, rows_of

LABELS = ("a", "b")
STATISTICS = {"order": 0.9, "vector": np.ptp}


def reference(a, b, replicas, statistic=np.mean, seed=0):
    """The scheme one draw at a time: same number of draws from both, paired differences."""
    rng = np.random.default_rng(seed)
    n = max(len(a), len(b))
    return np.array([statistic(rng.choice(a, n) - rng.choice(b, n)) for _ in range(replicas)])


@pytest.fixture(scope="module")
def groups():
    rng = np.random.default_rng(11)
    a = np.round(np.where(rng.random(300) < 0.6, 0, rng.lognormal(3, 1, 300)), 2)
    b = np.round(np.where(rng.random(120) < 0.5, 0, rng.lognormal(3, 0.8, 120)), 2)
    return a, b


@pytest.fixture(scope="module")
def table(spark, groups):
    rows = [(int(i), g, float(v)) for g, values in zip(LABELS, groups) for i, v in enumerate(values, 1000 * (g == "b"))]
    return spark.createDataFrame(rows, "id long, g string, v double").cache()


def stats(df):
    return np.array([r["stat"] for r in df.orderBy("replica").collect()])


@pytest.mark.parametrize("method, replicas", [("resample", 3000), ("poisson", 1500), ("vector", 2000), ("paired", 400)])
def test_distribution_equals_the_scheme(table, groups, method, replicas):
    got = stats(resample.bootstrap_replicas(table, "g", "v", LABELS, replicas=replicas, method=method, statistic=np.mean if method == "vector" else "mean"))
    want = reference(*groups, 4000)
    assert len(got) == replicas
    # Standard error of a mean and of a sigma estimated from the replicas, five times.
    assert abs(got.mean() - want.mean()) < 5 * want.std() / np.sqrt(replicas)
    assert abs(got.std() / want.std() - 1) < 5 / np.sqrt(2 * replicas) + (0.06 if method == "poisson" else 0)


def test_own_size_draws_widen_the_smaller_group(table, groups):
    got = stats(resample.bootstrap_replicas(table, "g", "v", LABELS, replicas=2000, draws="own"))
    a, b = groups
    assert got.std() == pytest.approx(np.sqrt(a.var() / len(a) + b.var() / len(b)), rel=0.08)


@pytest.mark.parametrize("method, statistic, replicas", [("paired", "median", 200), ("order", "median", 2000), ("order", 0.9, 2000), ("order", 0.03, 2000), ("vector", 0.9, 2000)])
def test_quantiles_of_paired_differences(table, groups, method, statistic, replicas):
    payers = table.filter("v > 0")
    of = np.median if statistic == "median" else lambda d: np.quantile(d, statistic)
    asked = of if method == "vector" else statistic
    got = stats(resample.bootstrap_replicas(payers, "g", "v", LABELS, replicas=replicas, method=method, statistic=asked))
    want = reference(*[v[v > 0] for v in groups], 2000, of)
    assert want.std() > 0 and len(got) == replicas
    assert abs(got.mean() - want.mean()) < 5 * want.std() / np.sqrt(min(replicas, 2000) / 2)
    assert abs(got.std() / want.std() - 1) < 5 / np.sqrt(replicas)
    # The whole distribution, not only its first two moments.
    grid = np.quantile(want, [0.1, 0.25, 0.5, 0.75, 0.9])
    assert np.abs((got[:, None] <= grid).mean(0) - (want[:, None] <= grid).mean(0)).max() < 5 * np.sqrt(0.5 / min(replicas, 2000))


@pytest.mark.parametrize("at_once", [1, 7, 1000])
def test_quantiles_of_all_pairs(at_once, monkeypatch):
    monkeypatch.setattr(replica_state, "DIFFERENCES_AT_ONCE", at_once)
    rng = np.random.default_rng(2)
    for k in range(30):
        a, b = (np.round(rng.normal(0, 3, rng.integers(1, 40)), rng.integers(0, 3)) for _ in "ab")
        (x, nx), (y, ny) = (np.unique(v, return_counts=True) for v in (a, b))
        both = replica_state.Collapsed({"a": x, "b": y}, {"a": nx, "b": ny}, LABELS)
        every = np.sort((a[:, None] - b).ravel())
        shares = np.sort(np.concatenate([rng.random(20), [1.0, 0.5, 1 / len(every)]]))
        want = every[np.ceil(shares * len(every) - 1e-9).astype(int) - 1]
        assert both.difference_quantiles(shares) == pytest.approx(want)
        for d in rng.choice(every, 5):
            assert both.share_up_to(d + 1e-9) == pytest.approx((every <= d + 1e-9).mean())


def test_poisson_state_does_not_grow_with_rows(spark):
    """One state of two numbers a replica and task, whatever the number of rows."""
    few = spark.range(2_000).selectExpr("IF(id % 2 = 0, 'a', 'b') AS g", "cast(id % 10 AS double) AS v")
    many = spark.range(200_000).selectExpr("IF(id % 2 = 0, 'a', 'b') AS g", "cast(id % 10 AS double) AS v")
    sigma = {}
    for name, df in (("few", few), ("many", many)):
        replicas = resample.bootstrap_replicas(df, "g", "v", LABELS, replicas=3000, method="poisson")
        assert "Generate" not in plan_of(replicas) and "explode" not in plan_of(replicas)
        sigma[name] = stats(replicas).std()
    assert sigma["few"] == pytest.approx(10 * sigma["many"], rel=0.1)
    assert sigma["many"] == pytest.approx(np.sqrt(2 * np.arange(0, 10, 2).var() / 100_000), rel=0.1)


def test_too_many_values_for_every_task(table, monkeypatch):
    exact = stats(resample.bootstrap_replicas(table, "g", "v", LABELS, replicas=20, method="paired", statistic="median"))
    monkeypatch.setattr(replica_state, "MAX_VALUES", 10)
    assert stats(resample.bootstrap_replicas(table, "g", "v", LABELS, replicas=20, method="order", statistic="median")) == pytest.approx(exact)
    with pytest.raises(ValueError):
        resample.bootstrap_replicas(table, "g", "v", LABELS, replicas=20, method="vector", statistic=np.mean)


def test_any_aggregate_as_statistic(table, groups):
    got = stats(
        resample.bootstrap_replicas(
            table, "g", "v", LABELS, replicas=200, method="paired", statistic=lambda d: F.stddev_pop(d)
        )
    )
    assert got.mean() == pytest.approx(reference(*groups, 500, np.std).mean(), rel=0.05)


@pytest.mark.parametrize("method", resample.METHODS)
def test_same_seed_same_replicas_on_any_partitioning(table, method):
    options = {"replicas": 40, "method": method, "statistic": STATISTICS.get(method, "mean")}
    runs = [stats(resample.bootstrap_replicas(table.repartition(n, F.rand(n)), "g", "v", LABELS, seed=5, **options)) for n in (1, 4, 32)]
    assert runs[0] == pytest.approx(runs[1], rel=1e-9) and runs[0] == pytest.approx(runs[2], rel=1e-9)
    other = stats(resample.bootstrap_replicas(table, "g", "v", LABELS, seed=6, **options))
    assert not np.allclose(runs[0], other)


def test_several_value_parts_and_blocks(table, groups, monkeypatch):
    monkeypatch.setattr(resample, "VALUES_PER_PART", 20)
    monkeypatch.setattr(resample, "REPLICAS_PER_BLOCK", 300)
    got = stats(resample.bootstrap_replicas(table, "g", "v", LABELS, replicas=2000))
    want = reference(*groups, 4000)
    assert len(got) == 2000
    assert abs(got.mean() - want.mean()) < 5 * want.std() / np.sqrt(2000)
    assert abs(got.std() / want.std() - 1) < 0.08


def test_positions_cover_every_row_once(table, groups, monkeypatch):
    monkeypatch.setattr(resample, "POSITIONS_PER_CHUNK", 7)
    got = rows_of(resample.value_positions(table, "g", "v").select("g", "position", "value"))
    want = [(g, i, v) for g, values in zip(LABELS, groups) for i, v in enumerate(sorted(values))]
    assert got == want


def test_summary(spark):
    values = np.random.default_rng(3).normal(1.0, 2.0, 500)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "replica long, stat double")
    got = resample.summarise_replicas(df, level=0.9).first()
    assert got["replicas"] == 500 and got["mean"] == pytest.approx(values.mean())
    assert got["sigma"] == pytest.approx(values.std())
    assert (got["ci_low"], got["ci_high"]) == pytest.approx(tuple(np.quantile(values, [0.05, 0.95])))
    assert got["z"] == pytest.approx(values.mean() / values.std())


def test_equal_constants_have_no_p_value(spark):
    df = spark.createDataFrame([(i, g, 2.0) for i, g in enumerate("aabb")], "id long, g string, v double")
    got = resample.bootstrap_test(df, "g", "v", LABELS, replicas=20).first()
    assert (got["mean"], got["sigma"], got["p_value"]) == (0.0, 0.0, None)


def test_missing_group_gives_no_statistic(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "id long, g string, v double")
    for method in resample.METHODS:
        options = {"method": method, "statistic": STATISTICS.get(method, "mean")}
        assert resample.bootstrap_test(df, "g", "v", LABELS, replicas=5, **options).first()["mean"] is None


def test_interval_contains_a_known_difference(spark):
    rng = np.random.default_rng(9)
    rows = [(i, "a", float(v)) for i, v in enumerate(rng.normal(10, 3, 400))]
    rows += [(i, "b", float(v)) for i, v in enumerate(rng.normal(8, 3, 400), 1000)]
    df = spark.createDataFrame(rows, "id long, g string, v double")
    got = resample.bootstrap_test(df, "g", "v", LABELS, replicas=1000).first()
    assert got["ci_low"] < 2 < got["ci_high"] and got["p_value"] < 1e-6


def test_poisson_of_groups_of_very_different_size(spark):
    rows = [(i, "a", float(i % 7)) for i in range(900)] + [(1000 + i, "b", float(i)) for i in range(9)]
    df = spark.createDataFrame(rows, "id long, g string, v double")
    got = stats(resample.bootstrap_replicas(df, "g", "v", LABELS, replicas=2000, method="poisson"))
    want = reference(np.arange(900) % 7.0, np.arange(9.0), 2000)
    assert abs(got.mean() - want.mean()) < 5 * want.std() / np.sqrt(1000) and got.std() == pytest.approx(want.std(), rel=0.1)


@pytest.mark.parametrize(
    "options",
    [{"method": "jackknife"}, {"statistic": "median"}, {"draws": "half"}, {"method": "poisson", "statistic": "median"}, {"method": "paired", "draws": "own"},
     {"method": "order", "statistic": 1.5}, {"method": "order"}, {"method": "vector"}, {"method": "vector", "statistic": np.mean, "draws": "own"}],
)
def test_wrong_options_are_refused(table, options):
    with pytest.raises(ValueError):
        resample.bootstrap_replicas(table, "g", "v", LABELS, **options)


@pytest.mark.parametrize("method", resample.METHODS)
def test_missing_values_are_left_out(spark, table, method):
    holes = spark.createDataFrame([(9001, "a", None), (9002, "b", float("nan"))], "id long, g string, v double")
    options = {"replicas": 30, "method": method, "statistic": STATISTICS.get(method, "mean")}
    with_holes = stats(resample.bootstrap_replicas(table.unionByName(holes), "g", "v", LABELS, **options))
    assert with_holes == pytest.approx(stats(resample.bootstrap_replicas(table, "g", "v", LABELS, **options)))


def test_pairs_without_broadcast(table, monkeypatch):
    options = {"replicas": 30, "method": "paired"}
    joined = stats(resample.bootstrap_replicas(table, "g", "v", LABELS, **options))
    monkeypatch.setattr(resample, "MAX_BROADCAST_ROWS", 0)
    shuffled = stats(resample.bootstrap_replicas(table, "g", "v", LABELS, **options))
    assert joined == pytest.approx(shuffled)


def test_few_replicas_per_block(table, groups, monkeypatch):
    monkeypatch.setattr(resample, "VALUES_PER_PART", 20)
    monkeypatch.setattr(resample, "SHARES_AT_ONCE", 100)
    got = stats(resample.bootstrap_replicas(table, "g", "v", LABELS, replicas=600))
    want = reference(*groups, 4000)
    assert len(got) == 600 and abs(got.mean() - want.mean()) < 5 * want.std() / np.sqrt(600)


@pytest.mark.parametrize("statistic", ["mean", "median", 0.9])
def test_pairs_looked_up_equal_pairs_joined(table, monkeypatch, statistic):
    """The same draws, without a shuffle of draws; also where a value is searched among the collapsed ones."""
    options = {"replicas": 30, "method": "paired", "statistic": statistic, "seed": 4}
    monkeypatch.setattr(resample, "DRAWS_PER_CHUNK", 64)
    replicas = resample.bootstrap_replicas(table, "g", "v", LABELS, **options)
    assert "Join" not in plan_of(replicas) and "Exchange" not in plan_of(replicas)
    looked_up = stats(replicas)
    monkeypatch.setattr(replica_state, "MAX_EXPANDED", 0)
    both = replica_state.collapsed(table, "g", "v", LABELS)
    for values, up_to in ((both.first, both.first_up_to), (both.second, both.second_up_to)):
        positions = np.arange(up_to[-1])
        assert (replica_state._lookup(values, up_to)(positions) == np.repeat(values, np.diff(up_to))).all()
    monkeypatch.setattr(replica_state, "MAX_VALUES", 10)
    assert looked_up == pytest.approx(stats(resample.bootstrap_replicas(table, "g", "v", LABELS, **options)))


@pytest.mark.parametrize("draws", ["own", "max"])
def test_poisson_weights_by_key(table, groups, draws):
    options = {"replicas": 1500, "method": "poisson", "draws": draws, "key": "id", "seed": 2}
    runs = [stats(resample.bootstrap_replicas(table.repartition(n, F.rand(n)), "g", "v", LABELS, **options)) for n in (1, 9)]
    assert len(runs[0]) == 1500 and runs[0] == pytest.approx(runs[1], rel=1e-9)
    sizes = [max(map(len, groups)) if draws == "max" else len(v) for v in groups]
    sigma = np.sqrt(sum(v.var() / n for v, n in zip(groups, sizes)))
    assert runs[0].std() == pytest.approx(sigma, rel=0.15)
    assert abs(runs[0].mean() - (groups[0].mean() - groups[1].mean())) < 6 * sigma / np.sqrt(1500)


def test_poisson_weight_by_key_is_that_of_its_text(spark):
    """One row a group: the mean is the value whenever the weight is not zero."""
    df = spark.createDataFrame([(1, "a", 5.0), (2, "b", 3.0)], "id long, g string, v double")
    got = {r["replica"]: r["stat"] for r in resample.bootstrap_replicas(df, "g", "v", LABELS, replicas=200, method="poisson", key="id", seed=3).collect()}
    u = lambda key, replica: (int(hashlib.md5(f"3|{key}|{replica}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
    drawn = {r: u(1, r) >= np.exp(-1) and u(2, r) >= np.exp(-1) for r in range(200)}
    assert got == {r: 2.0 if drawn[r] else None for r in range(200)}


@pytest.mark.parametrize("options", [{"method": "paired", "key": "id"}, {"method": "poisson", "key": "id", "rows": 30}])
def test_wrong_use_of_a_key_is_refused(spark, options):
    rows = [(i, "a", 1.0) for i in range(options.pop("rows", 2))] + [(99, "b", 1.0)]
    df = spark.createDataFrame(rows, "id long, g string, v double")
    with pytest.raises(ValueError):
        resample.bootstrap_replicas(df, "g", "v", LABELS, replicas=5, **options)


@pytest.mark.parametrize("at_once, per_range, held", [(1 << 22, 1 << 16, 1 << 24), (50, 16, 200), (700, 3, 1)])
def test_totals_dealt_equal_pairs_looked_up(table, monkeypatch, at_once, per_range, held):
    """Means of values too many for every task: draws are packed by ranges, never a row each in a shuffle."""
    options = {"replicas": 30, "method": "paired", "seed": 4}
    looked_up = stats(resample.bootstrap_replicas(table, "g", "v", LABELS, **options))
    monkeypatch.setattr(resample, "DRAWS_PER_CHUNK", 64)
    monkeypatch.setattr(replica_state, "MAX_VALUES", 10)
    monkeypatch.setattr(replica_state, "PACKED_AT_ONCE", at_once)
    monkeypatch.setattr(replica_state, "POSITIONS_PER_RANGE", per_range)
    monkeypatch.setattr(replica_state, "DRAWS_PER_RANGE", held)
    replicas = resample.bootstrap_replicas(table, "g", "v", LABELS, **options)
    assert "MapInArrow" in plan_of(replicas) and "Join" not in plan_of(replicas).split("MapInArrow")[-1]
    assert stats(replicas) == pytest.approx(looked_up)


@pytest.mark.parametrize("n, size", [(1, 5), (1000, 5), (1000, 200_000), (300_000, 200_000), (70_000, 66_000)])
def test_packed_draws_keep_their_sum(n, size):
    rng = np.random.default_rng(n)
    positions, values = rng.integers(0, size, n), rng.normal(0, 1, size)
    width = replica_state.POSITIONS_PER_RANGE
    packed = list(replica_state._packed(positions, width))
    got = sum(replica_state._total(values[k * width : (k + 1) * width], form, b) for k, form, b in packed)
    assert got == pytest.approx(values[positions].sum())
    assert sum(len(b) for *_, b in packed) <= 2 * n + 4 * width * (n > 255 * size)


def drawn_by_text(groups, replicas, pairs, seed):
    """The mean of each replica, one digest a draw."""
    u = lambda label, replica, i: (int(hashlib.md5(f"{seed}|{label}|{replica}|{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
    mean = lambda label, v, replica: np.mean([v[int(u(label, replica, i) * len(v))] for i in range(pairs)])
    first, second = (np.sort(v) for v in groups)
    return [mean("a", first, r) - mean("b", second, r) for r in range(replicas)]


@pytest.mark.parametrize("values, counted, at_once", [(1_000, True, 64), (1_000, True, 1_300), (10, True, 64), (10, False, 64)])
def test_pairs_are_drawn_many_at_a_time(table, groups, monkeypatch, values, counted, at_once):
    """The draws of the texts, without a row or a call for each; the data are read once."""
    rows = table.sparkSession.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(resample, "DRAWS_PER_CHUNK", at_once)
    monkeypatch.setattr(replica_state, "MAX_VALUES", values)
    if not counted:
        monkeypatch.setattr(replica_state, "MAX_COUNTED", 0)
    monkeypatch.setattr(replica_state, "PACKED_AT_ONCE", 100)
    monkeypatch.setattr(replica_state, "POSITIONS_PER_RANGE", 16)
    read = table.mapInArrow(seen, table.schema)
    replicas = resample.bootstrap_replicas(read, "g", "v", LABELS, replicas=12, method="paired", seed=4)
    assert "md5" not in plan_of(replicas)
    assert stats(replicas) == pytest.approx(drawn_by_text(groups, 12, 300, 4))
    assert rows.value == 420


def test_counts_that_a_byte_does_not_hold(monkeypatch):
    draws = replica_state.PairedDraws(1, LABELS, (2, 50_000), 40_000, 1_000)
    first, second = (np.concatenate(p, axis=1)[0] for p in zip(*(pair for _, pair in draws.positions([3]))))
    for per_byte in (16, 1 << 30):
        monkeypatch.setattr(replica_state, "DRAWS_PER_BYTE", per_byte)
        times = replica_state._counted(draws, 3)
        assert (times[0] == np.bincount(first, minlength=2)).all() and (times[1] == np.bincount(second, minlength=50_000)).all()
        packed = dict(replica_state._packed_replica(draws, 3, 1 << 14))
        for label, positions, n in (("a", first, 2), ("b", second, 50_000)):
            values = np.arange(n) + 0.5
            got = sum(replica_state._total(values[k << 14 : (k + 1) << 14], form, b) for k, form, b in packed[label])
            assert got == pytest.approx(values[positions].sum())
