import hashlib
import random

import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from actionlens.llm import pieces
from actionlens.llm.flat import steps
from actionlens.llm.queries import piece_model

library = sentencepiece.SentencePieceProcessor(model_file=piece_model())


def ids_of(texts):
    model, out = pieces.load_model(piece_model()), []
    for _, _, data, offsets in steps(pa.array(texts, pa.string()), 500):
        flat, ends = pieces.Encoded(model, data, offsets).flat_ids()
        out += [flat[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]
    return out


def test_as_the_library():
    r = random.Random(1)
    parts = ["a", "b", "e", "t", "h", " ", "  ", "\n", "the", "in", "é", "▁", "語", "1", ".", "\t", "\x00", "😀"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(800)]
    texts += ["", " ", *(" " * n for n in (14, 15, 16, 17, 31, 33, 500)), *(" " * n + "the" for n in (15, 16, 17, 40)), "x" * 3000, "ab" * 1500, "abc" * 999]
    assert ids_of(texts) == library.encode(texts, num_threads=1)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids = ids_of(texts)
    assert ids == library.encode(texts, num_threads=1)
    model = pieces.load_model(piece_model())
    assert [pieces.decode_text(pieces.decode_bytes(model, x)) for x in ids] == [library.decode(x) for x in ids]


def test_digests(odd, no_documents):
    got = pieces.piece_digests(odd, piece_model()).collect()
    want = []
    for r in odd.select("doc_id", "text").collect():
        ids = library.encode(r["text"] or "")
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want.append((r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids) if ids else "")))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert pieces.piece_digests(no_documents, piece_model()).count() == 0


@pytest.mark.parametrize("both", [True, False])
def test_round_trip(odd, both):
    if both:
        back = pieces.encode_and_decode(odd, piece_model())
    else:
        back = pieces.decode_documents(pieces.encode_documents(odd, piece_model()), piece_model())
    texts = lambda df: sorted(r["text"] or "" for r in df.select("text").collect())
    assert texts(back) == texts(odd) and back.where("text_hash = -1").count() == odd.count()
