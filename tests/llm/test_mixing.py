import pytest
from pyspark.sql import functions as F

from actionlens.llm import mixing


def targets_of(sizes):
    """Share by weight, and share the excess of capped sources again until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        open_weight = sum(weight[s] for s in names if s not in capped)
        new = {s for s in names if s not in capped and rest * weight[s] / open_weight > 3 * sizes[s]}
        if not new:
            return {s: 3 * sizes[s] if s in capped else rest * weight[s] / open_weight for s in names}
        capped |= new


@pytest.mark.parametrize("block_words", [7, 50, 4096])
def test_targets_are_met(documents, block_words):
    texts = ["w " * (1 + i * 7 % 90) for i in range(300)]
    sources = [None if i % 50 == 3 else "abcdefg"[min(6, i % 40)] for i in range(300)]
    df = documents(texts, sources)
    rows = mixing.mix_documents(df, block_words=block_words).join(df.select("doc_id", "source"), "doc_id").collect()
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    want = targets_of(sizes)
    assert len(rows) == 300 and all(r["source_size"] == sizes[r["source"]] for r in rows)
    for s in sizes:
        own = [r for r in rows if r["source"] == s]
        assert own[0]["target"] == pytest.approx(want[s])
        assert sum(r["taken"] for r in own) == int(want[s] + 0.5)
    assert all(r["taken"] <= 3 * r["size"] for r in rows)


def test_schedule_is_even(spark):
    targets = spark.createDataFrame([("a", 0, 1000, 5000.0), ("b", 1, 1000, 3000.0), ("c", 2, 2000, 2000.0)], "source string, source_no int, source_size long, target double")
    slots = mixing.schedule(targets, 10).orderBy("at").collect()
    assert [sum(s["source_no"] == k for s in slots) for k in (0, 1, 2)] == [500, 300, 200]
    for end in (50, 200, 900):  # every prefix of the mix is near the shares
        assert abs(sum(s["source_no"] == 0 for s in slots[:end]) - end / 2) <= 5
    assert sorted(s["turn"] for s in slots if s["source_no"] == 1) == list(range(300))


def test_odd_rows(odd, no_documents):
    rows = mixing.mix_documents(odd).collect()
    assert len(rows) == odd.count() and all(r["taken"] == 0 for r in rows if not r["size"])
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mix_documents(odd).collect()))
    assert mixing.mix_documents(no_documents).count() == 0
    applied = mixing.apply_mix(odd, mixing.mix_documents(odd))
    assert applied.columns == odd.columns
    assert mixing.apply_mix(no_documents, mixing.mix_documents(no_documents)).count() == 0


def test_passes_follow_what_is_taken(documents):
    df = documents(["w " * 10] * 30 + ["v " * 100] * 30, ["a"] * 30 + ["z"] * 30)
    mix = mixing.mix_documents(df)
    rows = mixing.apply_mix(df, mix).groupBy("source").agg(F.count("*").alias("n")).collect()
    assert {r["source"]: r["n"] for r in rows} == {"a": 90, "z": 24}
