import random
import re

from actionlens.llm import near_dedup
from actionlens.llm.links import components


def brute(rows):
    sets, parent = {}, {}
    out = []
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        own = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
        out.append((i, len(own)))
        if i is not None:
            parent[i] = i
            sets.setdefault(i, []).append(own)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return sorted(((i, n, None if i is None else root(i), i is None or root(i) == i) for i, n in out), key=repr)


def check(df):
    got = sorted((tuple(r) for r in near_dedup.near_duplicates(df).collect()), key=repr)
    assert got == brute([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()])


def test_groups_of_copies(documents):
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    texts = []
    for _ in range(12):
        base = [word() for _ in range(r.choice([3, 5, 9, 40, 120]))]
        for _ in range(r.randint(1, 25)):
            copy = [word() if r.random() < r.choice([0, 0.01, 0.04, 0.08]) else w for w in base]
            texts.append(" ".join(copy).upper() if r.random() < 0.3 else "\n".join(copy))
    r.shuffle(texts)
    check(documents(texts))


def test_passage_in_all(documents):
    r = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(60))
    check(documents([" ".join(f"w{r.randint(0, 10**6)}" for _ in range(r.randint(0, 40))) + " " + passage for _ in range(150)]))


def test_centre_of_many_copies(documents, monkeypatch):
    """Pairs of one document, rows of one bucket and of one shingle are dealt to several tasks."""
    from actionlens.operators import hot_keys

    monkeypatch.setattr(near_dedup, "PAIRS_PER_SALT", 10)
    monkeypatch.setattr(hot_keys.join_per_key, "__defaults__", (20,))
    dealt = []
    confirmed = near_dedup._confirmed
    monkeypatch.setattr(near_dedup, "_confirmed", lambda pairs, sets, percent: dealt.append(pairs.count()) or confirmed(pairs, sets, percent))
    r = random.Random(9)
    base = [f"w{r.randint(0, 10**6)}" for _ in range(80)]
    texts = [" ".join(base[:i % 70] + [f"own{i}"] + base[i % 70 + 1 :]) for i in range(180)] + [" ".join(base)] * 5
    check(documents(texts + [" ".join(f"w{r.randint(0, 10**6)}" for _ in range(50)) for _ in range(10)]))
    assert dealt[0] > 100


def test_shingles_have_64_bits():
    import numpy as np

    text = " ".join(map(str, range(5000))).encode()
    data, offsets = np.frombuffer(text + b"a b c d e f", np.uint8), np.array([0, 0, len(text), len(text) + 11])
    hashed, bounds = near_dedup.shingles(data, offsets)
    assert np.diff(bounds).tolist() == [0, 4996, 2] and (np.diff(hashed[: bounds[2]].astype(float)) > 0).all()
    assert (hashed >> np.uint64(60)).max() == 15 and len(np.unique(hashed & np.uint64(0xFFFF))) > 4000


def test_odd_rows(odd, no_documents):
    check(odd)
    assert near_dedup.near_duplicates(no_documents).count() == 0
    kept = near_dedup.keep_first_copies(odd)
    assert kept.columns == odd.columns and kept.where("doc_id IS NULL").count() == 2


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 100), (90, 91)], "a long, b long")
    rows = {tuple(r) for r in components(links).collect()}
    assert rows == {(i, 0) for i in range(41)} | {(90, 90), (91, 90)}
