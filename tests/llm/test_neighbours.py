import numpy as np
import pytest

from actionlens.llm import neighbours


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_few_vectors_are_searched_whole(spark):
    random = np.random.default_rng(1)
    vectors = random.standard_normal((300, 24)).astype(np.float32)
    vectors[100:150] = vectors[100]  # ties
    got = neighbours.search_table(table(spark, [(i, v.tolist(), 0) for i, v in enumerate(vectors)])).orderBy("query_id", "rank").collect()
    wide = vectors.astype(float)
    unit = wide / np.sqrt((wide**2).sum(1, keepdims=True))
    want = []
    for q in range(0, 300, 50):
        cosine = np.round(unit @ unit[q], 12)
        order = [i for i in np.lexsort((np.arange(300), -cosine)) if i != q][:5]
        want += [(q, k + 1, i) for k, i in enumerate(order)]
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == want
    assert all(r["score"] == pytest.approx(unit[r["query_id"]] @ unit[r["vec_id"]]) for r in got)


def test_recall_over_lists(spark):
    random = np.random.default_rng(2)
    vectors = random.standard_normal((4000, 32)) + 2 * random.standard_normal((20, 32))[random.integers(0, 20, 4000)]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, vector array<double>")
    got = neighbours.nearest_neighbours(frame, frame.where("vec_id % 50 = 0"), vectors_per_list=200).collect()
    unit = vectors / np.sqrt((vectors**2).sum(1, keepdims=True))
    hit = 0
    for q in range(0, 4000, 50):
        cosine = unit @ unit[q]
        cosine[q] = -2
        hit += len(set(np.argsort(-cosine)[:5].tolist()) & {r["vec_id"] for r in got if r["query_id"] == q})
    assert hit >= 0.9 * 80 * 5


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0], 0), (1, [2.0, 0.0], 0), (2, [0.0, 0.0], 0), (3, None, 0), (4, [nan, 1.0], 0), (5, [inf, 1.0], 0), (6, [None, 1.0], 0), (7, [1.0, 1.0, 1.0], 0), (None, [1.0, 0.0], 0), (50, [0.0, 3.0], 0), (100, None, 0)]
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in neighbours.search_table(table(spark, rows)).collect()}
    assert got == {(0, 1): 1, (0, 2): 50, (50, 1): 0, (50, 2): 1}
    assert neighbours.search_table(table(spark, rows[2:4])).count() == 0


def test_each_length_is_searched(spark):
    random = np.random.default_rng(8)
    rows = [(i, random.standard_normal(2 + i % 3).tolist(), 0) for i in range(240)] + [(150, [1.0, 2.0], 0), (150, [1.0, 2.0], 0), (50, [5.0] * 7, 0)]
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.search_table(table(spark, rows)).collect())
    want = []
    for length in range(2, 8):
        mine = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in rows if len(v) == length]
        # Of rows that repeat an id, the smallest vector asks.
        asks = {i: min((v.tolist() for j, v in mine if j == i)) for i, _ in mine if i % 50 == 0}
        for q, v in ((q, np.array(v)) for q, v in asks.items()):
            near = sorted((-round(float(v @ w / np.sqrt(v @ v) / np.sqrt(w @ w)), 12), i) for i, w in mine if i != q)[:5]
            want += [(q, k + 1, i) for k, (_, i) in enumerate(near)]
    assert got == sorted(want) and {q for q, _, _ in got} == {0, 50, 100, 150, 200}


def test_every_query_finds_five(spark):
    # Two vectors far from one large group: the list that they are in holds fewer rows than are wanted.
    random = np.random.default_rng(3)
    vectors = np.concatenate([[[0.0, 0.0, 0.0, 9.0], [0.1, 0.0, 0.0, 9.0]], random.standard_normal((998, 4)) * 0.1 + [5, 0, 0, 0]])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, vector array<double>")
    got = neighbours.nearest_neighbours(frame, frame.where("vec_id % 50 = 0"), vectors_per_list=50).groupBy("query_id").count().collect()
    assert {r["query_id"]: r["count"] for r in got} == dict.fromkeys(range(0, 1000, 50), 5)


def test_the_first_nearest_stay():
    # Apart in the second of eight column blocks alone: the test would abandon most candidates there.
    random = np.random.default_rng(4)
    apart = lambda n: np.concatenate([np.ones((n, 16)), random.standard_normal((n, 16)) * 3, np.ones((n, 96))], 1)
    row, col, _ = neighbours.scan(apart(1), np.array([100]), apart(6), np.arange(6), np.eye(128))
    assert len(row) == 5 and len(set(col.tolist())) == 5
