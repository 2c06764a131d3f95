"""Language of a text by words first and character n-grams for unseen words.

The model holds every word of the training documents and every n-gram of these words, as tables that
stay in Spark. A word of the model counts with its log frequency in each language, mixed with a share of its mean
frequency in all of them, so that what a language lacks costs it the same whatever its size. Any other
word falls back to its n-grams: the longest length of which the model knows one. Scores of the most
frequent words of each language are at hand in every task; a document's other words are joined to the
tables, each distinct word once, and added up by document. Scores are whole numbers of ``1 / UNIT``, so that a sum
does not depend on the order of rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.hot_keys import MIN_HOT_ROWS, join_per_key
from ..session import cut_lineage
from .flat import steps, texts_of

UNKNOWN = "und"
# Scores that every task has at hand: those of the most frequent words, the same number of words for each
# language, one score a language for each word. All other words are joined.
SCORES_AT_HAND = 800_000
LONGEST_GRAM = 4
# Weight of the mean frequency in all languages beside a language's own.
SMOOTHING = 0.1
# Scores are whole numbers of this part of one; 10^8 words do not overflow.
UNIT = 1 << 30
_EDGE = "_"

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: bytes) -> list[str]:
    """Runs of letters, in lower case. Fractions, superscripts and other signs for numbers are no letters."""
    found = _LETTERS.findall(text.decode("utf-8", "replace").lower())
    if not found or "".join(found).isalpha():
        return found
    return [w for x in found for w in ([x] if x.isalpha() else "".join(c if c.isalpha() else " " for c in x).split())]


def in_part(doc_id: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text has this remainder; never for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))


def word_counts(documents: DataFrame, languages: list[str]) -> DataFrame:
    """``(word, n)`` of ``documents(lang, text)``: how often each word occurs in each of ``languages``, as an
    array; words are added up in each batch first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for low, _, data, offsets in steps(batch.column("text")):
                seen: dict[str, Counter] = {}
                for i, text in enumerate(texts_of(data, offsets)):
                    seen.setdefault(langs[low + i], Counter()).update(words_of(text))
                for lang, counts in seen.items():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(counts)), pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                        names=["lang", "word", "n"],
                    )

    counted = documents.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    of = [F.coalesce(F.sum(F.when(F.col("lang") == lang, F.col("n"))), F.lit(0)) for lang in languages]
    return counted.mapInArrow(count, "lang string, word string, n long").groupBy("word").agg(F.array(*of).cast("array<long>").alias("n"))


def _grams(words: DataFrame, size: Column | int) -> DataFrame:
    """A row with ``gram`` for each n-gram of the words with their edges marked; shorter words have none."""
    marked = words.withColumn("marked", F.concat(F.lit(_EDGE), "word", F.lit(_EDGE))).withColumn("size", F.lit(size))
    at = "transform(sequence(1, length(marked) - size + 1), i -> substring(marked, i, size))"
    return marked.where("length(marked) >= size").withColumn("gram", F.explode(F.expr(at))).drop("marked", "word")


def gram_counts(words: DataFrame, languages: int, longest: int = LONGEST_GRAM) -> DataFrame:
    """``(size, gram, n)`` of ``words(word, n)`` with their edges marked."""
    grams = _grams(words, F.explode(F.array(*map(F.lit, range(1, longest + 1)))))
    return grams.groupBy("size", "gram").agg(F.array(*(F.sum(F.col("n")[i]) for i in range(languages))).alias("n"))


def _scores(n: Column, totals: list[Column | int], smoothing: float) -> Column:
    """Log frequency in each language, from the counts ``n`` and all counts of each language."""
    shares = [F.coalesce(F.try_divide(n[i].cast("double"), F.lit(total)), F.lit(0.0)) for i, total in enumerate(totals)]
    mean = sum(shares[1:], shares[0]) * (smoothing / len(shares))
    return F.array(*(F.round((F.log(x + mean) - math.log(1 + smoothing)) * UNIT).cast("long") for x in shares))


def _frequent(wide: DataFrame, most: int, languages: int) -> Column:
    """Whether a word is among the ``most`` most frequent of some language, without those that tie with the
    first one left out. Runs a job that counts the words of each frequency."""
    counted = wide.select(F.posexplode("n").alias("language", "times")).where("times > 0").groupBy("language", "times").count().collect()
    least = [0] * languages
    for language in range(languages):
        taken = 0
        for times, words in sorted(((r["times"], r["count"]) for r in counted if r["language"] == language), reverse=True):
            taken += words
            if taken > most:
                least[language] = times
                break
    return F.greatest(F.lit(False), F.lit(False), *(F.col("n")[i] > x for i, x in enumerate(least)))


class LanguageModel:
    """Log frequencies by language: a row for each word and n-gram of the training documents."""

    def __init__(self, languages: list[str], words: DataFrame, grams: DataFrame, sizes: list[int], at_hand: list[str], table: np.ndarray):
        """``words`` is ``(word, scores)``, ``grams`` is ``(size, gram, scores)`` with the lengths ``sizes``;
        ``at_hand`` are the most frequent words, ``table`` has their scores."""
        self.languages, self.words, self.grams, self.at_hand, self.table = languages, words, grams, at_hand, table
        self.sizes = sorted(sizes, reverse=True)

    def score_words(self, words: DataFrame) -> DataFrame:
        """``words``, distinct by ``word``, with ``scores``; zeros where the model knows no n-gram of the word
        either. Runs a job for the words and one for each length of n-grams that is needed."""
        looked_up = cut_lineage(words.join(self.words, "word", "left"))
        scored, rest = looked_up.where("scores IS NOT NULL"), looked_up.where("scores IS NULL").drop("scores")
        for size in self.sizes:
            if rest.isEmpty():
                return scored
            mean = [F.round(F.avg(F.col("scores")[i])).cast("long") for i in range(len(self.languages))]
            own = rest.select("word", F.col("word").alias("of"))
            found = _grams(own, size).join(self.grams.where(F.col("size") == size).drop("size"), "gram").groupBy("of").agg(F.array(*mean).alias("scores"))
            looked_up = cut_lineage(rest.join(found.withColumnRenamed("of", "word"), "word", "left"))
            scored, rest = scored.union(looked_up.where("scores IS NOT NULL")), looked_up.where("scores IS NULL").drop("scores")
        return scored.union(rest.withColumn("scores", F.array_repeat(F.lit(0).cast("long"), len(self.languages))))

    def score(self, word: str) -> tuple[float, ...]:
        """Scores of one word. May run jobs."""
        if word in self.at_hand:
            known = self.table[self.at_hand.index(word)].tolist()
        else:
            known = self.score_words(self.words.sparkSession.createDataFrame([(word,)], "word string")).first()["scores"]
        return tuple(x / UNIT for x in known)


def fit_languages(documents: DataFrame, words: int | None = None, smoothing: float = SMOOTHING) -> LanguageModel:
    """Learn from all rows of ``documents(lang, text)`` with a language and a text.

    The scores of the ``words`` most frequent words of each language come to the driver, by default an equal
    part of ``SCORES_AT_HAND``; those of all words and n-grams stay in Spark. Runs jobs; the counts of
    words and the scores of n-grams are stored.
    """
    # A row for each language.
    told = documents.where("lang IS NOT NULL AND text IS NOT NULL").groupBy("lang").count().collect()
    languages = sorted(r["lang"] for r in told)
    wide = cut_lineage(word_counts(documents, languages))
    every = range(len(languages))
    # What the words give of each length: 0 for the words themselves, else n-grams.
    sizes = range(LONGEST_GRAM + 1)
    held = {size: F.greatest(F.lit(0), F.char_length("word") + 3 - size) if size else F.lit(1) for size in sizes}
    of_all = wide.agg(*(F.coalesce(F.sum(F.col("n")[i] * held[size]), F.lit(0)).alias(f"t{size}_{i}") for size in sizes for i in every), F.count("*").alias("rows")).first()
    totals = {size: [of_all[f"t{size}_{i}"] for i in every] for size in sizes}
    if not of_all["rows"]:
        languages, every = [], range(0)
    if not languages:
        nothing = F.array().cast("array<long>").alias("scores")
        return LanguageModel([], wide.select("word", nothing), wide.select(F.lit(0).alias("size"), F.col("word").alias("gram"), nothing), [], [], np.empty((0, 0), np.int64))
    of_words = F.col("n"), totals[0], smoothing
    scores = wide.select("word", _scores(*of_words).alias("scores"))
    by_size = [F.coalesce(*(F.when(F.col("size") == size, F.lit(totals[size][i])) for size in sizes[1:])) for i in every]
    grams = cut_lineage(gram_counts(wide, len(languages)).select("size", "gram", _scores(F.col("n"), by_size, smoothing).alias("scores")))
    most = SCORES_AT_HAND // len(languages) ** 2 if words is None else words
    frequent = wide.where(_frequent(wide, most, len(languages))).select("word", _scores(*of_words).alias("scores")).toArrow().combine_chunks()
    table = np.concatenate([np.empty(0, np.int64), *(c.flatten().to_numpy() for c in frequent["scores"].chunks)]).astype(np.int64).reshape(-1, len(languages))
    return LanguageModel(languages, scores, grams, [size for size in sizes[1:] if any(totals[size])], frequent["word"].to_pylist(), table)


def _counted(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """``(row, doc_id, base, rare, times)``: the summed scores of the words at hand, null if the text has no
    word at all, and the other words with how often each occurs, separated by spaces."""
    # Words are letters only.
    shared = documents.sparkSession.sparkContext.broadcast((" ".join(model.at_hand), model.table))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = shared.value
        place = {word: i for i, word in enumerate(names.split())}
        for batch in batches:
            for low, high, data, offsets in steps(batch.column("text")):
                base, rare, times = [], [], []
                for text in texts_of(data, offsets):
                    counts = Counter(words_of(text))
                    at = np.fromiter((place.get(w, -1) for w in counts), np.int64, len(counts))
                    n = np.fromiter(counts.values(), np.int64, len(counts))
                    base.append(n[at >= 0] @ table[at[at >= 0]] if counts else None)
                    others = [w for w, i in zip(counts, at.tolist()) if i < 0]
                    rare.append(" ".join(others))
                    times.append(" ".join(str(counts[w]) for w in others))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(low, high - low) for c in ("row", "doc_id")),
                        pa.array(base, pa.list_(pa.int64())), pa.array(rare, pa.string()), pa.array(times, pa.string()),
                    ],
                    names=["row", "doc_id", "base", "rare", "times"],
                )

    numbered = documents.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return numbered.mapInArrow(count, "row long, doc_id long, base array<long>, rare string, times string")


def predict_languages(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """``(doc_id, lang_pred, score)`` for every row of ``documents``; the text alone decides.

    A null text, a text without letters, and any text if nothing was learned, is ``und`` with score 0.
    The score is the share of the best language's likelihood; equal ones go to the first by name. Runs
    jobs: row numbers, sums and words to be joined are stored, so that row numbers stay as they are.
    """
    if not model.languages:
        return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    width = range(len(model.languages))
    counted = cut_lineage(_counted(documents, model))
    pairs = F.arrays_zip(F.split("rare", " ").alias("word"), F.split("times", " ").alias("n"))
    rare = counted.where("rare <> ''").select("row", F.inline(pairs)).withColumn("n", F.col("n").cast("long"))
    scores = model.score_words(rare.groupBy("word").agg(F.count("*").alias("documents")))
    # A word that many documents have and no training document does is no word at hand: its rows are many.
    most = scores.agg(F.max("documents")).first()[0] or 0
    scored = join_per_key(rare, scores, "word", "documents") if most > MIN_HOT_ROWS else rare.join(scores, "word")
    added = scored.groupBy("row").agg(*(F.sum(F.col("n") * F.col("scores")[i]).alias(f"s{i}") for i in width))
    total = counted.drop("rare", "times").join(added, "row", "left")
    total = total.select("doc_id", *((F.col("base")[i] + F.coalesce(f"s{i}", F.lit(0))).alias(f"s{i}") for i in width))
    best = F.array_max(F.array(*(f"s{i}" for i in width)))
    lang = F.lit(UNKNOWN)
    for i in reversed(width):
        lang = F.when(F.col(f"s{i}") == F.col("best"), F.lit(model.languages[i])).otherwise(lang)
    share = 1 / sum((F.exp((F.col(f"s{i}") - F.col("best")) / UNIT) for i in width), F.lit(0.0))
    return total.withColumn("best", best).select("doc_id", lang.alias("lang_pred"), F.coalesce(share, F.lit(0.0)).alias("score"))


def held_out_languages(documents: DataFrame, parts: int = 4, part: int = 2) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``: learn from the documents outside one part, predict all."""
    held_out = in_part("doc_id", parts, part)
    model = fit_languages(documents.where(~held_out))
    return predict_languages(documents, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
