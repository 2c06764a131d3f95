"""Quality rules under weak supervision.

Rules look at counts of a whole text and vote good, vote bad, or abstain in between and where the
script gives them no meaning. How far each vote can be trusted is not given but estimated, by
expectation-maximisation over the vote patterns of all documents (at most 3 to the number of rules,
whatever the number of documents): there are good documents and some kinds of junk, and for each of
them the model holds its share and how often every rule that votes votes bad. A document is kept by its
posterior probability to be good, so one bad vote can be outvoted by good ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .flat import CONTINUATION, LOWER, SPACE, Substrings, mix, per_row, rows_at, steps, word_spans

GOOD, BAD, ABSTAIN = 1, -1, 0
MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30

# Frequent function words of four languages.
FUNCTION_WORDS = (
    "the of and to in is that for it with as was on be at by this are from or an "
    "de la le et les des en un une du que qui pour dans par sur "
    "der die und das den von zu mit sich auf ist ein dem nicht "
    "el los las del se con no una su para al lo como"
).split()

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
# Ends of sentences outside ASCII, as their last three or two bytes.
_LONG_ENDS = [int.from_bytes(c.encode(), "big") for c in "।॥。！？…።။។"]
_SHORT_ENDS = [int.from_bytes(c.encode(), "big") for c in "؟۔։"]

# First and last code points of scripts that are written without blanks between words: Thai and Lao,
# Myanmar, Khmer, Chinese and Japanese. All of them take three bytes.
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0xA4CF), (0xF900, 0xFAFF))

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_bars", "n_bangs", "n_upper", "n_letters", "n_function_words", "n_lines", "n_ended_lines", "n_unspaced",
)


def _function_hashes() -> np.ndarray:
    words = [w.encode() for w in sorted(set(FUNCTION_WORDS))]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    return np.sort(Substrings(data).hashes(ends - [len(w) for w in words], ends))


def text_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of every text."""
    n = len(offsets) - 1
    count = lambda rows: np.bincount(rows, minlength=n)
    of_bytes = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
    starts, ends, rows = word_spans(data, offsets)
    counts = {
        "n_words": count(rows),
        "word_chars": of_bytes(~SPACE[data] & ~CONTINUATION[data]),
        "n_symbols": of_bytes(_SYMBOLS[data]),
        "n_bars": of_bytes(data == ord("|")),
        "n_bangs": of_bytes(data == ord("!")),
        "n_upper": of_bytes(_UPPER[data]),
        "n_letters": of_bytes(_LETTER[data]),
    }
    leads = np.flatnonzero((data >= 0xE0) & (data < 0xF0))
    leads = leads[leads + 2 < len(data)]
    codes = (data[leads].astype(np.int64) & 0xF) << 12 | (data[leads + 1].astype(np.int64) & 0x3F) << 6 | data[leads + 2] & 0x3F
    unspaced = np.zeros(len(leads), bool)
    for low, high in UNSPACED:
        unspaced |= (codes >= low) & (codes <= high)
    counts["n_unspaced"] = count(rows_at(offsets, leads[unspaced]))
    plain = Substrings(data)
    # Words covered by a window of words that occurs again in the same text.
    covered = np.zeros(len(starts) + 1, np.int64)
    last = len(starts) - REPEAT_WINDOW
    if last >= 0:
        hashed = plain.hashes(starts, ends)
        window = np.zeros(last + 1, np.uint64)
        for k in range(REPEAT_WINDOW):
            window = window * np.uint64(0x9E3779B97F4A7C15) + hashed[k : k + last + 1]
        whole = np.flatnonzero(rows[: last + 1] == rows[REPEAT_WINDOW - 1 :])
        keys = mix(window[whole] ^ mix(rows[whole].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        again = np.zeros(len(keys), bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        np.add.at(covered, whole[again], 1)
        np.add.at(covered, whole[again] + REPEAT_WINDOW, -1)
    counts["n_repeat_words"] = per_row(np.cumsum(covered)[:-1] > 0, rows, n)
    lowered = Substrings(LOWER[data]).hashes(starts, ends)
    known = _function_hashes()
    at = np.minimum(np.searchsorted(known, lowered), len(known) - 1)
    counts["n_function_words"] = per_row(known[at] == lowered, rows, n)
    # Lines: split at every line feed and at the ends of texts; those with a word count.
    breaks = np.flatnonzero(data == 0x0A)
    line_starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    line_rows = np.searchsorted(offsets[:-1], line_starts, "right") - 1
    order = np.lexsort((line_starts, np.concatenate([np.arange(n), rows_at(offsets, breaks)])))
    line_starts = np.concatenate([offsets[:-1], breaks + 1])[order]
    line_rows = np.concatenate([np.arange(n), rows_at(offsets, breaks)])[order]
    line_ends = np.minimum(np.append(line_starts[1:], len(data) + 1) - 1, offsets[1:][line_rows])
    same_row = np.append(line_rows[1:] == line_rows[:-1], False)
    line_ends = np.where(same_row, line_ends, offsets[1:][line_rows])
    nonblank = np.concatenate([[0], np.cumsum(~SPACE[data])])
    worded = nonblank[line_ends] > nonblank[line_starts]
    line_starts, line_ends, line_rows = line_starts[worded], line_ends[worded], line_rows[worded]
    counts["n_lines"] = count(line_rows)
    keys = mix(plain.hashes(line_starts, line_ends) ^ mix(line_rows.astype(np.uint64) + np.uint64(1)))
    _, firsts = np.unique(keys, return_index=True)
    counts["n_dup_lines"] = counts["n_lines"] - count(line_rows[firsts])
    last = ends[np.searchsorted(ends, line_ends, "right") - 1] - 1 if len(line_ends) else np.empty(0, np.int64)
    one, two, three = (data[np.maximum(last - k, 0)].astype(np.int64) << 8 * k for k in range(3))
    ended = np.isin(one, list(b".!?:")) | np.isin(one + two, _SHORT_ENDS) | np.isin(one + two + three, _LONG_ENDS)
    counts["n_ended_lines"] = per_row(ended, line_rows, n)
    return {name: counts[name].astype(np.int64) for name in COUNTS}


def with_counts(documents: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``documents`` under the names ``c0``, ``c1``, ... and the counts of the text."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in steps(batch.column("counted_text")):
                found = text_counts(data, offsets)
                rest = [batch.column(f"c{i}").slice(low, high - low) for i in range(len(columns))]
                yield pa.RecordBatch.from_arrays([*rest, *(pa.array(found[c]) for c in COUNTS)], names=[*(f"c{i}" for i in range(len(columns))), *COUNTS])

    kept = documents.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)))
    schema = kept.select("*", *(F.lit(0).cast("long").alias(c) for c in COUNTS)).schema
    return documents.select(
        *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)), F.col("text").alias("counted_text")
    ).mapInArrow(extract, schema)


def _vote(bad: Column, good: Column) -> Column:
    """Bad, good, or neither; a share of nothing is null and abstains."""
    return F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN)


def votes() -> dict[str, Column]:
    """The rules. Shares are of words, characters, letters or lines."""
    words, lines, chars = (F.nullif(c, F.lit(0)) for c in ("n_words", "n_lines", "word_chars"))
    # Words and sentence ends mean little where words are not set apart; capitals and the listed function words are
    # those of Latin script.
    spaced = F.col("n_unspaced") / chars < 0.2
    latin = F.col("n_letters") / chars > 0.5
    capitals = F.when(latin & (F.col("n_letters") >= 20), F.col("n_upper") / F.col("n_letters"))
    length = F.when(spaced, F.col("word_chars") / words)
    enough = F.col("n_words") >= MIN_WORDS
    ended = F.when(spaced & enough, F.col("n_ended_lines") / lines)
    function_words = F.when(latin & enough, F.col("n_function_words") / words)
    symbols = (F.col("n_symbols") - F.col("n_bars")) / words
    bars, bangs, repeated = (F.col(c) / words for c in ("n_bars", "n_bangs", "n_repeat_words"))
    same_lines = F.col("n_dup_lines") / lines
    return {
        "symbols": _vote(symbols > 0.3, symbols < 0.1),
        "bars": _vote(bars > 0.2, bars < 0.05),
        "bangs": _vote(bangs > 0.3, bangs < 0.1),
        "capitals": _vote(capitals > 0.4, capitals < 0.2),
        "word_length": _vote(~length.between(2, 20), length.between(3, 12)),
        "repeated_words": _vote(repeated > 0.2, repeated < 0.05),
        "repeated_lines": _vote((F.col("n_dup_lines") >= 3) & (same_lines > 0.3), same_lines < 0.1),
        "ended_lines": _vote(ended < 0.1, ended > 0.5),
        "function_words": _vote(function_words < 0.03, function_words > 0.1),
    }


# Kinds of junk, by the rules that are meant to notice them.
KINDS = {
    "symbols": ("symbols",),
    "menus": ("bars",),
    "shouting": ("bangs", "capitals"),
    "repetition": ("repeated_words", "repeated_lines"),
    "fragments": ("ended_lines", "word_length"),
}
# What is assumed beforehand: shares of each kind, and how often a rule that votes votes bad on good documents, on its
# own kind of junk, and on other kinds. A text can be in a language whose function words are not listed.
KIND_SHARE, BAD_ON_GOOD, BAD_ON_OWN, BAD_ON_OTHER = 0.02, 0.02, 0.9, 0.1
FUNCTION_WORDS_ON_GOOD, FUNCTION_WORDS_ON_JUNK = 0.1, 0.5


def assumptions() -> tuple[dict[str, float], dict[str, dict[str, float]]]:
    """Share of each class, ``good`` first, and by class how often each rule that votes votes bad."""
    shares = {"good": 1 - KIND_SHARE * len(KINDS)} | dict.fromkeys(KINDS, KIND_SHARE)
    rates = {}
    for kind, own in ({"good": ()} | KINDS).items():
        other = BAD_ON_GOOD if kind == "good" else BAD_ON_OTHER
        rates[kind] = {rule: BAD_ON_OWN if rule in own else other for rule in votes()}
        rates[kind]["function_words"] = FUNCTION_WORDS_ON_GOOD if kind == "good" else FUNCTION_WORDS_ON_JUNK
    return shares, rates


@dataclass(frozen=True)
class RuleModel:
    """``shares`` of good documents and of each kind of junk, and ``rates``: by class, how often each rule votes
    bad if it votes."""

    shares: dict[str, float]
    rates: dict[str, dict[str, float]]

    def _evidence(self, kind: str) -> Column:
        total = F.lit(math.log(self.shares[kind]))
        for rule, rate in self.rates[kind].items():
            total = total + F.when(F.col(rule) == BAD, math.log(rate)).when(F.col(rule) == GOOD, math.log(1 - rate)).otherwise(0.0)
        return total

    def posterior(self) -> Column:
        """Probability to be good, from the rules' votes in columns of their names."""
        good = self._evidence("good")
        odds = [F.exp(self._evidence(kind) - good) for kind in self.shares if kind != "good"]
        return 1 / sum(odds, F.lit(1.0))


def with_votes(counted: DataFrame) -> DataFrame:
    return counted.select("*", *(vote.alias(rule) for rule, vote in votes().items()))


def fit_rules(counted: DataFrame, rounds: int = 500, prior_weight: float = 0.05) -> RuleModel:
    """Estimate shares and rates by expectation-maximisation over all rows of ``counted`` that the fixed thresholds
    let pass, for the others are not judged by votes.

    A share of ``prior_weight`` imagined documents is as assumed beforehand, so that classes keep their
    meaning and a rule that hardly ever votes keeps its rate; empty input gives the assumptions. Runs a job.
    """
    rules = list(votes())
    patterns = with_votes(counted.where(~_failed())).groupBy(*rules).count().collect()
    table = np.array([[r[n] for n in rules] for r in patterns], float).reshape(-1, len(rules))
    weight = np.array([r["count"] for r in patterns], float)
    bad, voted = (table == BAD).astype(float), (table != ABSTAIN).astype(float)
    shares, rates = assumptions()
    share = before_share = np.array(list(shares.values()))
    rate = before_rate = np.array([[rates[kind][rule] for rule in rules] for kind in shares])
    imagined = max(weight.sum(), 1.0) * prior_weight
    for _ in range(rounds):
        evidence = np.log(share) + bad @ np.log(rate).T + (voted - bad) @ np.log(1 - rate).T
        belongs = np.exp(evidence - evidence.max(1, initial=-np.inf, keepdims=True))
        belongs *= (weight / belongs.sum(1))[:, None]
        assumed = imagined * before_share[:, None]
        last_share, last_rate = share, rate
        rate = (belongs.T @ bad + assumed * before_rate) / (belongs.T @ voted + assumed)
        share = (belongs.sum(0) + imagined * before_share) / (weight.sum() + imagined)
        if max(np.abs(rate - last_rate).max(), np.abs(share - last_share).max()) < 1e-10:
            break
    return RuleModel(dict(zip(shares, share.tolist())), {kind: dict(zip(rules, row.tolist())) for kind, row in zip(shares, rate)})


def _failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def judge_documents(documents: DataFrame) -> DataFrame:
    """``(doc_id, counts, base_failed, posterior, kept)`` for every row of ``documents``.

    A null or empty text has no words and fails. Equal rows get equal rows. Runs jobs: the counts
    are stored, for fitting and judging both read them.
    """
    counted = cut_lineage(with_counts(documents, ["doc_id"]))
    model = fit_rules(counted)
    judged = with_votes(counted).withColumn("posterior", model.posterior())
    return judged.select(
        F.col("c0").cast("long").alias("doc_id"),
        *COUNTS,
        _failed().alias("base_failed"),
        "posterior",
        (~_failed() & (F.col("posterior") >= 0.5)).alias("kept"),
    )


def keep_good(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that are kept, with their columns. Texts are counted twice, once to
    fit the rules, rather than joined. Runs a job."""
    model = fit_rules(with_counts(documents, []))
    counted = with_votes(with_counts(documents, documents.columns).where(~_failed())).where(model.posterior() >= 0.5)
    return counted.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(documents.columns)))
