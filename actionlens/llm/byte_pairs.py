"""Byte-level BPE encoding and decoding with a lexicon of the corpus's frequent words.

Texts are cut into words by the vocabulary's own rule, on flat arrays of characters. Every distinct word
of a step is looked up once in the lexicon (see ``lexicon``); a word that is not there is merged
exactly: in each round every word merges its pair of lowest rank at all its places. The lexicon is
compiled from the most frequent words of all documents. It changes the time, never the ids.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .flat import CONTINUATION, Substrings, steps, texts_of
from .lexicon import Lexicon, compile_lexicon, open_published, publish

# Words of the lexicon, at most, and the longest one in bytes; all others are merged.
LEXICON_WORDS = 65_536
LONGEST_WORD = 32
STEP_BYTES = 4 << 20
_NEVER = np.iinfo(np.int32).max
_OTHER, _LETTER, _NUMBER, _BLANK = range(4)
# Endings that an apostrophe takes along; fixed by the vocabulary's rule.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def byte_letters() -> list[str]:
    """The character that stands for each byte in a vocabulary file: itself where it is printable and no
    blank, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(0x100 + rest.index(b)) for b in range(256)]


def character_classes() -> np.ndarray:
    """Class of every code point, as the library's own patterns have them."""
    from tokenizers import Regex, pre_tokenizers

    surrogates = range(0xD800, 0xE000)
    codes = np.array([c for c in range(0x110000) if c not in surrogates])
    every = "".join(map(chr, codes.tolist()))
    classes = np.full(0x110000, _OTHER, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_BLANK, r"\s+")):
        for _, (low, high) in pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(every):
            classes[codes[low:high]] = kind
    return classes


class PairModel:
    """Merges and ids of a byte-level vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        rule, model = told["pre_tokenizer"], told["model"]
        if rule["type"] != "ByteLevel" or rule["add_prefix_space"] or not rule["use_regex"] or told["normalizer"] or model.get("ignore_merges"):
            raise ValueError(f"{path} is no plain byte-level vocabulary")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in told["added_tokens"]):
            raise ValueError("added tokens that take blanks along are not supported")
        self.added = {t["content"].encode(): t["id"] for t in told["added_tokens"]}
        self.added_pattern = re.compile(b"|".join(re.escape(t) for t in sorted(self.added, key=lambda t: (-len(t), t)))) if self.added else None
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        spelled = {i: bytes(byte_of[x] for x in token) for token, i in model["vocab"].items()}
        self.byte_ids = np.zeros(256, np.int64)
        for i, token in spelled.items():
            if len(token) == 1:
                self.byte_ids[token[0]] = i
        spelled |= {i: token for token, i in self.added.items()}
        self.size = max(spelled) + 1
        by_id = [spelled.get(i, b"") for i in range(self.size)]
        self.token_bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.token_ends = np.concatenate([[0], np.cumsum([len(t) for t in by_id])])
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        vocab = model["vocab"]
        left, right, made = (np.array([f(p) for p in pairs], np.int64) for f in (lambda p: vocab[p[0]], lambda p: vocab[p[1]], lambda p: vocab[p[0] + p[1]]))
        keys = left * self.size + right
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made[order]
        # All places of a pair can be merged at once if what a merge makes takes part in later merges only.
        rank_made = np.full(self.size, -1)
        rank_made[made] = np.arange(len(made))
        self.at_once = bool((np.maximum(rank_made[left], rank_made[right]) < np.arange(len(made))).all())
        self.classes = character_classes()

    def looked_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, and what it makes."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NEVER), self.made[at]


@lru_cache(maxsize=2)
def load_model(path: str) -> PairModel:
    return PairModel(path)


def word_starts(classes: np.ndarray, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which characters begin a word. ``first`` marks the characters that begin a text.

    A word is a run of letters, of numbers or of others, with one space before it, or a run of blanks,
    whose last one stands alone, or goes to the next word if it is a space. An apostrophe that begins a word
    is one with a known ending behind it.
    """
    n = len(codes)
    kind = classes[codes]
    begins = first.copy()
    begins[1:] |= kind[1:] != kind[:-1]
    # The last blank before something else in the same text.
    last = np.flatnonzero((kind[:-1] == _BLANK) & (kind[1:] != _BLANK) & ~first[1:])
    begins[last] = True
    begins[last[codes[last] == 0x20] + 1] = False
    quotes = np.flatnonzero((codes == ord("'")) & begins)
    if len(quotes):
        padded = np.concatenate([codes, [0, 0]])
        end = np.concatenate([first, [True, True, True]])
        taken = np.zeros(len(quotes), np.int64)
        for ending in ENDINGS:
            met = ~end[quotes + 1] & (padded[quotes + 1] == ord(ending[0]))
            if len(ending) == 2:
                met &= ~end[quotes + 2] & (padded[np.minimum(quotes + 2, n + 1)] == ord(ending[1]))
            taken[met & (taken == 0)] = len(ending)
        quotes, taken = quotes[taken > 0], taken[taken > 0]
        begins[quotes + 1] = False
        behind = quotes + 1 + taken
        begins[behind[behind < n]] = True
    return begins


def merge_words(model: PairModel, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words that stand one after the other in ``data``: flat ids, and where each word's end."""
    words = len(ends)
    symbols = model.byte_ids[data]
    word = np.repeat(np.arange(words), np.diff(ends, prepend=0))
    place = np.arange(len(data))
    done: list[tuple] = []
    while len(symbols):
        rank, made = model.looked_up(symbols[:-1], symbols[1:])
        rank = np.append(np.where(word[:-1] == word[1:], rank, _NEVER), _NEVER)
        heads = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        best = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.append(heads, len(word))))
        closed = best == _NEVER
        if closed.any():
            done.append((symbols[closed], word[closed], place[closed]))
        hits = np.flatnonzero((rank == best) & ~closed)
        # Of places that overlap, every second one from the left.
        chained = np.append(False, np.diff(hits) == 1)
        head = np.maximum.accumulate(np.where(chained, 0, np.arange(len(hits)))) if len(hits) else hits
        take = (np.arange(len(hits)) - head) % 2 == 0
        if not model.at_once:
            take = np.append(True, word[hits[1:]] != word[hits[:-1]]) if len(hits) else take
        hits = hits[take]
        symbols[hits] = made[hits]
        stays = ~closed
        stays[hits + 1] = False
        symbols, word, place = symbols[stays], word[stays], place[stays]
    if not done:
        return np.empty(0, np.int64), np.zeros(words, np.int64)
    symbols, word, place = map(np.concatenate, zip(*done))
    order = np.argsort(place)
    return symbols[order], np.cumsum(np.bincount(word, minlength=words))


def spread(flat: np.ndarray, ends: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen parts of ``flat``, one after the other, and where each ends; ``ends`` has a leading zero."""
    sizes = np.diff(ends)[chosen]
    out = np.cumsum(sizes)
    return flat[np.repeat(ends[chosen] - (out - sizes), sizes) + np.arange(out[-1] if len(out) else 0)], out


class Words:
    """The distinct words of the texts of one step, and each text's sequence of them."""

    def __init__(self, model: PairModel, data: np.ndarray, offsets: np.ndarray):
        try:
            text = data.tobytes().decode("utf-8")
        except UnicodeDecodeError:
            texts = [t.decode("utf-8", "replace").encode() for t in texts_of(data, offsets)]
            data = np.frombuffer(b"".join(texts), np.uint8)
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            text = data.tobytes().decode("utf-8")
        self.model, self.data, self.texts = model, data, len(offsets) - 1
        first_byte = np.zeros(len(data) + 1, bool)
        first_byte[offsets] = True
        added_at, added_ids = self._added(data, offsets)
        for low, high in added_at:
            first_byte[[low, high]] = True
        if len(data):
            bytes_at = np.flatnonzero(~CONTINUATION[data])
            codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
            starts = bytes_at[word_starts(model.classes, codes, first_byte[bytes_at])]
        else:
            starts = np.empty(0, np.int64)
        if added_at:
            # Nothing within an added token begins a word.
            edges = np.array(added_at).ravel()
            starts = starts[(np.searchsorted(edges, starts, "right") % 2 == 0) | np.isin(starts, edges[::2])]
        ends = np.append(starts[1:], len(data))[: len(starts)]
        hashed = Substrings(data).hashes(starts, ends)
        if added_at:
            # Added tokens are no words, even where the same bytes could be.
            hashed[np.searchsorted(starts, edges[::2])] ^= np.uint64(1)
        _, firsts, self.sequence, self.counts = np.unique(hashed, return_index=True, return_inverse=True, return_counts=True)
        self.starts, self.ends = starts[firsts], ends[firsts]
        self._verify(starts, ends)
        self.text_ends = np.searchsorted(starts, offsets)
        self.added = {}
        for (low, _), i in zip(added_at, added_ids):
            self.added[int(self.sequence[np.searchsorted(starts, low)])] = i

    def _added(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[tuple[int, int]], list[int]]:
        """Where added tokens stand, from the left within each text, and their ids."""
        raw, found = data.tobytes(), []
        if self.model.added and any(t in raw for t in self.model.added):
            for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                found += [m.span() for m in self.model.added_pattern.finditer(raw, low, high)]
        return found, [self.model.added[raw[a:b]] for a, b in found]

    def _verify(self, starts: np.ndarray, ends: np.ndarray) -> None:
        """Words with the same hash are the same bytes."""
        sizes = ends - starts
        if not ((self.ends - self.starts)[self.sequence] == sizes).all():
            raise ValueError("words of different lengths share a hash")
        there = np.repeat(self.starts[self.sequence] - starts, sizes) + np.arange(len(self.data))
        if not (self.data[there] == self.data).all():
            raise ValueError("different words share a hash")

    def encoded(self, lexicon: Lexicon | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the distinct words: flat ids and, after a leading zero, where each word's end."""
        n = len(self.starts)
        places = lexicon.places(self.data, self.starts, self.ends) if lexicon is not None else np.full(n, -1, np.int64)
        added = np.array(sorted(self.added), np.int64)
        places[added] = -1
        unseen = np.flatnonzero(places < 0)
        unseen = unseen[~np.isin(unseen, added)]
        edges = np.column_stack([self.starts[unseen], self.ends[unseen]])
        sizes = edges[:, 1] - edges[:, 0]
        merge_ends = np.cumsum(sizes)
        bytes_of = self.data[np.repeat(edges[:, 0] - (merge_ends - sizes), sizes) + np.arange(merge_ends[-1] if len(sizes) else 0)]
        merged, merged_ends = merge_words(self.model, bytes_of, merge_ends)
        # Three sources of ids, one after the other, and each word's part of them.
        seen = np.flatnonzero(places >= 0)
        known, known_ends = spread(lexicon.ids, lexicon.id_ends.astype(np.int64), places[seen]) if len(seen) else (np.empty(0, np.int64), np.empty(0, np.int64))
        flat = np.concatenate([known, merged, np.array([self.added[w] for w in added.tolist()], np.int64)]).astype(np.int64)
        starts, counts = np.zeros(n, np.int64), np.ones(n, np.int64)
        for which, part_ends, base in ((seen, known_ends, 0), (unseen, merged_ends, len(known))):
            counts[which] = np.diff(part_ends, prepend=0)
            starts[which] = base + part_ends - counts[which]
        starts[added] = len(known) + len(merged) + np.arange(len(added))
        ends = np.cumsum(counts)
        return flat[np.repeat(starts - (ends - counts), counts) + np.arange(len(flat))], np.concatenate([[0], ends])

    def ids(self, lexicon: Lexicon | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the offsets of each text's part."""
        flat, ends = spread(*self.encoded(lexicon), self.sequence)
        return flat, np.concatenate([[0], ends])[self.text_ends]


def decoded(model: PairModel, ids: np.ndarray, offsets: np.ndarray) -> Iterator[str]:
    """The text of each part of ``ids``. Broken UTF-8 becomes U+FFFD."""
    flat, ends = spread(model.token_bytes, model.token_ends, ids)
    raw, ends = flat.tobytes(), np.concatenate([[0], ends])[offsets].tolist()
    for low, high in zip(ends[:-1], ends[1:]):
        yield raw[low:high].decode("utf-8", "replace")


def word_counts(documents: DataFrame, model_path: str) -> DataFrame:
    """``(word, n)`` of all words of ``documents(text)`` up to the longest length, as bytes; words are added up
    in each step first. Null texts have none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(model_path)
        for batch in batches:
            for _, _, data, offsets in steps(batch.column("text"), STEP_BYTES):
                words = Words(model, data, offsets)
                short = np.flatnonzero(words.ends - words.starts <= LONGEST_WORD)
                short = short[~np.isin(short, np.array(sorted(words.added), np.int64))]
                raw = words.data.tobytes()
                found = [raw[a:b] for a, b in zip(words.starts[short].tolist(), words.ends[short].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(words.counts[short], pa.int64())], names=["word", "n"])

    return documents.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def fit_lexicon(documents: DataFrame, model_path: str, words: int = LEXICON_WORDS) -> str:
    """Name of a published lexicon of the ``words`` most frequent words of all documents that occur at least
    twice, without those that tie with the first one left out. Runs jobs: counts are stored."""
    spark = documents.sparkSession
    counts = cut_lineage(word_counts(documents, model_path).where("n > 1"))
    top = counts.orderBy(F.col("n").desc()).limit(words + 1).select("n").toArrow()["n"].to_numpy()
    least = int(top.min()) if len(top) > words else 1
    chosen = sorted(counts.where(F.col("n") > least).select("word").toArrow()["word"].to_pylist())
    ends = np.cumsum([len(w) for w in chosen], dtype=np.int64)
    ids, id_ends = merge_words(load_model(model_path), np.frombuffer(b"".join(chosen), np.uint8), ends)
    flat, starts = ids.tolist(), [0, *id_ends.tolist()]
    return publish(spark, compile_lexicon({w: flat[a:b] for w, a, b in zip(chosen, starts[:-1], starts[1:])}))


def _steps(batches: Iterator[pa.RecordBatch], model_path: str, lexicon: str | None) -> Iterator[tuple]:
    """``(batch, first row, rows, ids, offsets)`` of every step."""
    model, words = load_model(model_path), open_published(lexicon) if lexicon else None
    for batch in batches:
        for low, high, data, offsets in steps(batch.column("text"), STEP_BYTES):
            yield batch, low, high - low, *Words(model, data, offsets).ids(words)


def encode_documents(documents: DataFrame, model_path: str, lexicon: str | None = None) -> DataFrame:
    """Every row of ``documents`` with ``ids`` (array<int>) in place of the text; null and empty texts
    have no ids. All other columns stay, but for one already called ``ids``."""
    others = [c for c in documents.columns if c not in ("text", "ids")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, low, rows, ids, offsets in _steps(batches, model_path, lexicon):
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(low, rows) for c in others), lists], names=[*others, "ids"])

    frame = documents.select(*others, "text")
    schema = frame.drop("text").withColumn("ids", F.lit(None).cast("array<int>")).schema
    return frame.mapInArrow(encode, schema)


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """Turn ``ids`` back into ``text``, null into null; the other columns stay. An id that the vocabulary does not
    have, or a null one, is an error."""

    @F.pandas_udf("string")
    def decode(ids):
        model = load_model(model_path)
        return ids.map(lambda x: "".join(decoded(model, np.asarray(x, np.int64), np.array([0, len(x)]))) if x is not None else None)

    return encoded.withColumn("text", decode("ids")).drop("ids")


def pair_digests(documents: DataFrame, model_path: str, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of every row; a null text counts as empty.

    Ids are hashed as unsigned 32-bit numbers, lowest byte first; then they are decoded again. Runs jobs:
    the lexicon is compiled from all documents first.
    """
    lexicon = fit_lexicon(documents, model_path, lexicon_words)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(model_path)
        for batch, low, rows, ids, offsets in _steps(batches, model_path, lexicon):
            written, ends = ids.astype("<u4").tobytes(), (4 * offsets).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(low, rows),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array([hashlib.sha256(written[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:])], pa.string()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded(model, ids, offsets)], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
