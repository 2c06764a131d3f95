import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from actionlens.llm import suffixes


def brute(texts, length):
    seen = Counter(t[a : a + length] for t in texts for a in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, int)
        for a in range(len(t) - length + 1):
            if seen[t[a : a + length]] > 1:
                gone[a : a + length] = 1
        spans = int((np.diff(np.append(0, gone)) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("shard_bytes, most_pieces", [(1 << 20, 6), (400, 1000), (400, 2), (1, 0)])
def test_against_brute_force(documents, shard_bytes, most_pieces, monkeypatch):
    """One shard; shards of one hash merged; hashes that are cut anew; all of them cut down to windows."""
    monkeypatch.setattr(suffixes, "MOST_PIECES", most_pieces)
    r = random.Random(5)
    base = ["".join(r.choice("abcdé ") for _ in range(300)) for _ in range(5)]
    own = lambda: "".join(r.choice("fgh") for _ in range(r.randint(0, 40)))
    texts = ["", None, "a" * 100, "ab" * 40, "x" * 9]
    for _ in range(120 if shard_bytes > 1 else 40):
        a = r.randint(0, 200)
        texts.append(own() + r.choice(base)[a : a + r.randint(5, 100)] + own() + r.choice(base)[: r.randint(0, 60)])
    # A period of as many bytes as a window has hashes.
    texts += [("".join(r.choice("mnopq") for _ in range(23)) * 3)[:60]]
    df = documents(texts + texts[5:9])
    rows = suffixes.repeat_digests(df, suffixes.repeated_ranges(df, 30, 8, shard_bytes)).orderBy("doc_id").collect()
    assert [tuple(x)[1:5] for x in rows] == brute([(t or "").encode() for t in texts + texts[5:9]], 30)


def test_a_line_in_all_documents(documents, monkeypatch):
    """Text under one hash without a repeat: pieces of it are not compared with each other."""
    monkeypatch.setattr(suffixes, "MOST_PIECES", 2)
    r = random.Random(8)
    line = "".join(r.choice("abcdef ") for _ in range(30))
    own = lambda n: "".join(r.choice("ghijkl ") for _ in range(n))
    shared = own(60)
    texts = [own(50) + line + own(50) + (shared if i % 100 == 0 else "") for i in range(400)]
    searched = []
    strings = suffixes._strings
    monkeypatch.setattr(suffixes, "_strings", lambda d, wanted, n: searched.append(wanted.count()) or strings(d, wanted, n))
    df = documents(texts)
    rows = suffixes.repeat_digests(df, suffixes.repeated_ranges(df, 40, 8, 1000)).orderBy("doc_id").collect()
    assert [tuple(x)[1:5] for x in rows] == brute([t.encode() for t in texts], 40)
    assert [x["touched"] for x in rows] == [i % 100 == 0 for i in range(400)]
    assert all(x["n_kept"] == x["n_bytes"] - x["n_removed"] for x in rows) and sum(searched) < 400


def test_suffix_array_and_common_prefixes():
    r = random.Random(2)
    for _ in range(40):
        base = [r.randint(0, 2) for _ in range(r.randint(1, 150))]
        text = []
        while len(text) < 600:
            a = r.randrange(len(base))
            text += base[a : a + r.randint(1, 100)] + [256] * (r.random() < 0.3)
        depth = r.choice([5, 16, 40, 100])
        order, new = suffixes.suffix_array(np.array(text, np.int32), depth)
        keys = [tuple(text[i : i + depth]) for i in order]
        assert keys == sorted(keys)
        prefixes = suffixes.common_prefixes(np.array(text, np.int32), order, new, depth)
        for k in range(1, len(order)):
            same = next((m for m in range(depth) if keys[k - 1][m : m + 1] != keys[k][m : m + 1] or m >= len(keys[k])), depth)
            assert prefixes[k] == same


def test_odd_rows(odd, no_documents):
    rows = suffixes.repeat_digests(odd, suffixes.repeated_ranges(odd)).collect()
    assert len(rows) == odd.count() and sum(x["n_removed"] > 0 for x in rows) == 1  # the long one repeats itself
    assert suffixes.repeat_digests(no_documents, suffixes.repeated_ranges(no_documents)).count() == 0
