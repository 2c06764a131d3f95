import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from actionlens.llm import hard_negatives


def table(spark, rows, kind="float"):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    # Columns that the operator uses itself.
    return frame.selectExpr("*", "-1 AS asker", "-1 AS score", "-1 AS rank", "'x' AS vector")


def brute_force(rows, every=100, moved=7):
    good = []
    for vec_id, v, label in rows:
        if vec_id is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((vec_id, (label + 1) % 10 if vec_id % moved == 0 else label, [math.floor(256 * x) for x in v]))
    anchors = {}
    for r in good:
        if r[0] % every == 0:
            anchors[r[0]] = min(anchors.get(r[0], r), r, key=lambda x: x[1:])
    out = []
    for a, label, v in anchors.values():
        scored = sorted((-sum(p * q for p, q in zip(v, w)), i, other == label) for i, other, w in good if i != a and len(w) == len(v))
        for score, p, _ in [x for x in scored if x[2]][:5]:
            fit = [x for x in scored if not x[2] and 80 * -score <= 100 * -x[0] <= 100 * -score][:5]
            out += [(a, p, k + 1, i, -score, -s) for k, (s, i, _) in enumerate(fit)]
    return sorted(out)


def got(frame):
    return sorted(map(tuple, frame.collect()))


@pytest.fixture
def grouped():
    random = np.random.default_rng(5)
    middles = random.standard_normal((12, 16))
    vectors = (middles[random.integers(0, 12, 3000)] + 0.5 * random.standard_normal((3000, 16))).astype(np.float32)
    vectors[500:1500] = vectors[500]  # a third of the rows are equal
    return [(i, v.tolist(), int(i) % 10) for i, v in enumerate(vectors)]


def test_like_brute_force(spark, grouped, monkeypatch):
    want = brute_force(grouped, 20)
    frame = table(spark, grouped).repartition(5)
    assert got(hard_negatives.hard_negatives(frame, 20)) == want
    # Several rounds, lists and clusters, and short steps.
    monkeypatch.setattr(hard_negatives, "LIST_BYTES", 40_000)
    monkeypatch.setattr(hard_negatives, "FIRST_STEP", 8)
    monkeypatch.setattr(hard_negatives, "MEMBERS", 4)
    rows = hard_negatives.usable(frame).withColumn("label", F.expr("IF(vec_id % 7 = 0, (label + 1) % 10, label)"))
    assert got(hard_negatives.mine(rows, rows.where("vec_id % 20 = 0"), round_bytes=6000)) == want


def test_walks_end_early(grouped, monkeypatch):
    ids, labels = np.array([r[0] for r in grouped]), np.array([r[2] for r in grouped])
    vectors = hard_negatives.whole(np.array([r[1] for r in grouped]))
    monkeypatch.setattr(hard_negatives, "FIRST_STEP", 16)
    monkeypatch.setattr(hard_negatives, "LONGEST_STEP", 64)
    monkeypatch.setattr(hard_negatives, "MEMBERS", 2)
    products, seen = hard_negatives.products, []
    monkeypatch.setattr(hard_negatives, "products", lambda a, b: seen.append(len(a) * len(b)) or products(a, b))
    every = np.arange(60)
    askers = hard_negatives.Askers(every, np.full(60, hard_negatives._LOWEST), np.full(60, hard_negatives._HIGHEST))
    asked = hard_negatives.Round(ids[:60], labels[:60], vectors[:60], False, askers, 5)
    asker, found, _ = asked.found_in(ids, labels, vectors)
    scores = vectors[:60] @ vectors.T
    for a in range(60):
        other = np.flatnonzero(labels != labels[a])
        assert found[asker == a].tolist() == other[np.lexsort((other, -scores[a, other]))[:5]].tolist()
    assert sum(seen) < 0.6 * 60 * len(ids)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 0.0], 1), (1, [2.0, 0.5], 2), (2, [1.0, 0.0], 2), (2, [1.0, 0.0], 2), (3, [1.0, -0.001], 1), (4, [0.0, 0.0], 1), (5, [-1.0, 0.0], 2),
        (6, [2.0, 0.0], None), (8, None, 1), (9, [nan, 1.0], 1), (10, [inf, 0.0], 2), (11, [None, 1.0], 2), (None, [5.0, 0.0], 2), (12, [1.0], 1), (100, [3.0], 5),
        (13, [0.9], 5), (15, [0.5], 5), (16, [0.89], 4), (200, [0.0, 0.0], 1), (200, [0.0, 0.0], 1), (300, [], 3), (17, [], 3), (18, [], 4), (400, [7.0, 7.0, 7.0], 1), (500, None, 1),
        (3, [1.0, 0.0], 1), (0, [1.0, 0.0], 1),
    ]
    assert got(hard_negatives.hard_negatives(table(spark, rows, "double"))) == brute_force(rows)
    assert hard_negatives.hard_negatives(table(spark, rows, "double").where("false")).count() == 0


def test_large_components(spark):
    rows = [(i, [(-1.0) ** i * 1e5 * (i + 1) + 0.123, 1e6 / (i + 1), 3.0 * i], i % 3) for i in range(40)]
    assert got(hard_negatives.hard_negatives(table(spark, rows, "double"), 20)) == brute_force(rows, 20)
    # Products that 64 bits do not hold are the largest number that they do.
    huge = [(0, [1e200], 0), (1, [1e308], 1), (2, [1e300], 2), (3, [-1e300], 2)]
    most = (1 << 63) - 1
    assert got(hard_negatives.hard_negatives(table(spark, huge, "double"), 20, 50)) == [(0, 1, 1, 2, most, most)]


def test_limits():
    scores = np.array([0, 1, 5, 99, 100, 12345, -1, -250, (1 << 63) - 1])
    low, high = hard_negatives.limits(scores, 80, 100)
    assert low.tolist() == [-(-80 * int(s) // 100) for s in scores] and high.tolist() == scores.tolist()
