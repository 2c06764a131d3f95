import hashlib
import json
import random

import numpy as np
import pyarrow as pa
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from actionlens.llm import byte_pairs, lexicon
from actionlens.llm.flat import steps
from actionlens.llm.queries import pair_model

library = tokenizers.Tokenizer.from_file(pair_model())


def library_ids(texts):
    return [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def lexicon_of(words):
    words = sorted(words)
    ids, ends = byte_pairs.merge_words(byte_pairs.load_model(pair_model()), np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words], dtype=np.int64))
    edges = [0, *ends.tolist()]
    return lexicon.Lexicon(lexicon.compile_lexicon({w: ids[a:b].tolist() for w, a, b in zip(words, edges[:-1], edges[1:])}))


SOME = lexicon_of([b" the", b"the", b"'s", b" ", b"\n", b" going", b"ing", b" t", "é".encode(), b"<|endoftext|>"])


def ids_of(texts, words=SOME, step=2000):
    model, out, back = byte_pairs.load_model(pair_model()), [], []
    for _, _, data, offsets in steps(pa.array(texts, pa.string()), step):
        flat, ends = byte_pairs.Words(model, data, offsets).ids(words)
        out += [flat[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]
        back += byte_pairs.decoded(model, flat, ends)
    assert back == [library.decode(x, skip_special_tokens=False) for x in out]
    return out


@pytest.mark.parametrize("words", [None, SOME, lexicon_of([])])
def test_as_the_library(words):
    r = random.Random(3)
    parts = [
        "a", "the", " the", " going", "ing", "'", "'s", "'ll", "'re", "'ve", "'d", "'m", "'t", "l", "s", "r", "e", "v", " ", "  ", "   ", "\n", "\r\n", "\t", " ", "　", "\x85", "1", "22", "½", "²",
        "é", "é", "語", "😀", "\U0010ffff", ".", "!!", "\x00", "<|endoftext|>", "<|endoftext", "|>", "aaaa", "_",
    ]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(3000)]
    texts += ["", " ", "'", "'s", "''s", " 's", "x" * 3000, "ab" * 1500, " " * 500, "\n" * 333 + "a", "<|endoftext|>" * 3, "a<|endoftext|> b", " <|endoftext|>'s"]
    assert ids_of(texts, words) == library_ids(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert ids_of(texts) == library_ids(texts)


def test_lexicon_is_exact_and_minimal():
    r = random.Random(4)
    words = {"".join(r.choice("abc") for _ in range(r.randint(0, 7))) for _ in range(800)}
    entries = {w.encode(): [r.randint(0, 9) for _ in range(r.randint(1, 3))] for w in words}
    built = lexicon.Lexicon(lexicon.compile_lexicon(entries))
    asked = ["".join(r.choice("abcd") for _ in range(r.randint(0, 8))).encode() for _ in range(3000)] + list(entries)
    ends = np.cumsum([len(w) for w in asked])
    places = built.places(np.frombuffer(b"".join(asked), np.uint8), ends - [len(w) for w in asked], ends)
    for w, p in zip(asked, places.tolist()):
        assert (built.ids[built.id_ends[p] : built.id_ends[p + 1]].tolist() if p >= 0 else None) == entries.get(w)
    # As many states as there are different sets of endings.
    prefixes = {w[:i] for w in entries for i in range(len(w) + 1)}
    endings = {frozenset(w[len(p) :] for w in entries if w.startswith(p)) for p in prefixes}
    assert built.states == len(endings)


def test_vocabulary_in_which_merges_go_against_their_order(tmp_path):
    # "abc" is made by an early and by a late merge, so pairs with it come before the late one.
    letters = {c: i for i, c in enumerate(byte_pairs.byte_letters())}
    merges = [["b", "c"], ["a", "bc"], ["abc", "d"], ["a", "b"], ["ab", "c"]]
    vocab = letters | {a + b: 256 + i for i, (a, b) in enumerate(m for m in merges if m != ["ab", "c"])}
    told = json.load(open(pair_model(), encoding="utf-8"))
    told |= {"added_tokens": [], "model": told["model"] | {"vocab": vocab, "merges": merges}}
    path = tmp_path / "small.json"
    path.write_text(json.dumps(told), encoding="utf-8")
    model, small = byte_pairs.PairModel(str(path)), tokenizers.Tokenizer.from_file(str(path))
    assert not model.at_once
    r = random.Random(5)
    texts = ["".join(r.choice("abcd") for _ in range(r.randint(1, 12))) for _ in range(500)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ids, ends = byte_pairs.Words(model, data, np.concatenate([[0], np.cumsum([len(t) for t in texts])])).ids(None)
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == [x.ids for x in small.encode_batch(texts)]


def digests(frame):
    out = []
    for r in frame.select("doc_id", "text").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        out.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(map(repr, out))


def test_digests(odd, no_documents, monkeypatch):
    assert sorted(map(repr, map(tuple, byte_pairs.pair_digests(odd, pair_model()).collect()))) == digests(odd)
    # A lexicon so small that many words tie with the first one left out.
    assert sorted(map(repr, map(tuple, byte_pairs.pair_digests(odd, pair_model(), 3).collect()))) == digests(odd)
    assert byte_pairs.pair_digests(no_documents, pair_model()).count() == 0


def test_word_counts(documents):
    frame = documents(["the cat the cat", "the cat", None, "", "the<|endoftext|> cat", "x" * 40])
    got = {bytes(r["word"]): r["n"] for r in byte_pairs.word_counts(frame.repartition(3), pair_model()).collect()}
    assert got == {b"the": 3, b" cat": 4, b" the": 1}


def test_round_trip(odd):
    name = byte_pairs.fit_lexicon(odd, pair_model())
    back = byte_pairs.decode_documents(byte_pairs.encode_documents(odd, pair_model(), name), pair_model())
    texts = lambda df: sorted(r["text"] or "" for r in df.select("text").collect())
    assert texts(back) == texts(odd) and back.where("text_hash = -1").count() == odd.count()
