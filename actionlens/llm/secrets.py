"""Secrets in texts: fixed patterns, and a battery of randomness tests on code-like tokens.

Built from DataFrame functions only. Tokens are tested against what a random string of their inferred
encoding would look like: uniform use of the alphabet (chi-squared), runs above and below the middle of
the alphabet, and serial correlation. The three p-values are combined by Fisher's method. A token of
letters of one case, like any long word, is also judged by how likely it has no digit. A run that fits no
encoding, like a path with a key in it, is tested by its parts. Ordinary tokens are rejected by the tests; how many of the rejections may be wrong is
controlled by the Benjamini-Hochberg rule over all tokens of the corpus, separately for every encoding
and class of lengths, because short tokens give weak evidence, and for tokens without a digit and parts. Tokens that no test can tell from random
ones are reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.significance import erfc, normal_upper_p
from ..session import cut_lineage

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
# Only runs of full length: shorter runs of these letters are in every word, and a run has no other start.
HEX = r"[0-9a-f]{32,}"
MIN_VALUE, MIN_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "random")

# A maximal run of code letters, of 20 letters at least.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"
# Parts of a run that fits no encoding: without the marks of one encoding, of the other, and of both.
PARTS = (r"[A-Za-z0-9_-]{20,}+", r"[A-Za-z0-9+/]{20,}+", r"[A-Za-z0-9]{20,}+")

# Alphabets by encoding, from the narrowest; a token has the first that holds all its letters.
ENCODINGS = {
    "hex": ("0123456789abcdef", r"^[0-9a-f]+$"),
    "upper_hex": ("0123456789ABCDEF", r"^[0-9A-F]+$"),
    "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", r"^[A-Z2-7]+$"),
    "base36": ("0123456789abcdefghijklmnopqrstuvwxyz", r"^[0-9a-z]+$"),
    "upper_base36": ("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", r"^[0-9A-Z]+$"),
    "base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", r"^[A-Za-z0-9+/]+$"),
    "base64url": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", r"^[A-Za-z0-9_-]+$"),
}
# Encodings of one case, in which words are tokens too.
ONE_CASE = ("hex", "upper_hex", "base32", "base36", "upper_base36")
MAX_FALSE_DISCOVERIES = 0.05
# p-values are ranked in bins of this width of their logarithm to base ten, rounded up.
_BIN = 0.01
_LAST_BIN = 30_000


def _spans(text: str, pattern: str, group: int, least: int) -> Column:
    """Code-point spans ``(start, end, token)`` of the matches of which ``group`` has ``least`` letters.

    Matches and the pieces between them alternate, so their lengths add up to positions.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.split(text, pattern, -1)
    empty = F.expr("CAST(array() AS array<struct<start:int,end:int,token:string>>)")

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.char_length(x["between"])
        end = start + F.char_length(x["found"])
        span = F.struct(start.alias("start"), end.alias("end"), x["found"].alias("token"))
        kept = F.when(F.char_length(x["values"]) >= least, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    spans = F.aggregate(
        F.arrays_zip(F.slice(between, F.lit(1), F.size(found)).alias("between"), found.alias("found"), values.alias("values")),
        F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        step,
        lambda state: state["spans"],
    )
    return F.when(F.regexp_like(text, F.lit(pattern)), spans).otherwise(empty)


def scan_texts(documents: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, assign, access, hex, tokens)`` with an array of spans for each pattern."""
    keyed = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("text_hash")
    )
    return keyed.select(
        "doc_id",
        "text_hash",
        _spans("text", ASSIGN, 2, MIN_VALUE).alias("assign"),
        _spans("text", ACCESS, 0, MIN_ACCESS).alias("access"),
        _spans("text", HEX, 0, 32).alias("hex"),
        _spans("text", TOKEN, 0, 20).alias("tokens"),
    )


def _encoding(token: Column) -> Column:
    name = F.lit(None).cast("string")
    for encoding, (_, letters) in reversed(ENCODINGS.items()):
        name = F.when(F.regexp_like(token, F.lit(letters)), F.lit(encoding)).otherwise(name)
    return name


def _has_digit(token: Column) -> Column:
    return F.regexp_like(token, F.lit("[0-9]"))


def _at_least(x: Column, least: float) -> Column:
    return F.greatest(x, F.lit(least))


def battery(tokens: DataFrame) -> DataFrame:
    """Add ``encoding``, ``p_uniform``, ``p_runs``, ``p_serial`` and the combined ``p`` to rows with
    ``token``. A test that has nothing to compare, as for a token of one letter, rejects. For letters of
    one case without a digit, ``p`` is twice the smaller of the combined one and the chance of no digit."""
    alphabet = F.lit(None).cast("string")
    for encoding, (letters, _) in ENCODINGS.items():
        alphabet = F.when(F.col("encoding") == encoding, F.lit(letters)).otherwise(alphabet)
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    n, k = F.col("n"), F.col("k")
    shaped = (
        tokens.withColumn("encoding", _encoding(F.col("token")))
        .where("encoding IS NOT NULL")
        .withColumn("alphabet", alphabet)
        .withColumn("k", F.length("alphabet").cast("double"))
        .withColumn("n", F.length("token").cast("double"))
        .withColumn("codes", F.transform(F.split("token", ""), lambda c: F.instr(F.col("alphabet"), c).cast("double") - 1))
    )
    counts = F.transform(F.array_distinct("codes"), lambda c: F.size(F.filter("codes", lambda x: x == c)).cast("double"))
    uniform = F.col("k") / n * total(F.transform(counts, lambda c: c * c)) - n
    high = F.transform("codes", lambda c: (c >= F.col("k") / 2).cast("double"))
    ahead = F.slice("codes", F.lit(2), F.size("codes") - 1)
    behind = F.slice("codes", F.lit(1), F.size("codes") - 1)
    tested = (
        shaped.withColumn("z_uniform", (uniform - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n))
        .withColumn("n_high", total(high))
        .withColumn("changes", total(F.zip_with(ahead, behind, lambda a, b: ((a >= F.col("k") / 2) != (b >= F.col("k") / 2)).cast("double"))))
        .withColumn("mean", total(F.col("codes")) / n)
        .withColumn("spread", total(F.transform("codes", lambda c: (c - F.col("mean")) * (c - F.col("mean")))))
        .withColumn("lagged", total(F.zip_with(ahead, behind, lambda a, b: (a - F.col("mean")) * (b - F.col("mean")))))
    )
    both = 2 * F.col("n_high") * (n - F.col("n_high"))
    expected = both / n + 1
    spread = both * (both - n) / (n * n * (n - 1))
    z_runs = F.abs(F.col("changes") + 1 - expected) / F.sqrt(F.when(spread > 0, spread))
    # The mean of the lagged correlation of random values is -1/n.
    z_serial = F.abs(F.col("lagged") / F.when(F.col("spread") > 0, F.col("spread")) + 1 / n) * F.sqrt(n)
    two_sided = lambda z: F.coalesce(erfc(z / F.sqrt(F.lit(2.0))), F.lit(0.0))
    scored = (
        tested.withColumn("p_uniform", normal_upper_p(F.col("z_uniform")))
        .withColumn("p_runs", two_sided(z_runs))
        .withColumn("p_serial", two_sided(z_serial))
    )
    half = -sum((F.log(_at_least(F.col(p), 1e-300)) for p in ("p_uniform", "p_runs", "p_serial")), F.lit(0.0))
    # Chi-squared with six degrees of freedom.
    scored = scored.withColumn("half", half).withColumn("p", F.exp(-F.col("half")) * (1 + F.col("half") + F.col("half") * F.col("half") / 2))
    digits = F.col("k") - F.length(F.regexp_replace("alphabet", "[0-9]", ""))
    wordlike = F.col("encoding").isin(*ONE_CASE) & ~_has_digit(F.col("token"))
    scored = scored.withColumn("p", F.when(wordlike, F.least(F.lit(1.0), 2 * F.least(F.col("p"), F.pow(1 - digits / k, n)))).otherwise(F.col("p")))
    return scored.select(*tokens.columns, "encoding", "p_uniform", "p_runs", "p_serial", "p")


def _with_strata(scored: DataFrame) -> DataFrame:
    """Encoding, form (whole run or part, with a digit or without), length class (doubling lengths) and the
    bin of ``p``."""
    bin_of = F.least(F.lit(_LAST_BIN), F.floor(-F.log10(_at_least(F.col("p"), 1e-300)) / _BIN)).cast("int")
    scored = scored.withColumn("form", F.col("part").cast("int") * 2 + _has_digit(F.col("token")).cast("int"))
    return scored.withColumn("length_class", F.floor(F.log2(F.length("token"))).cast("int")).withColumn("bin", bin_of)


def rejection_bounds(scored: DataFrame, level: float = MAX_FALSE_DISCOVERIES) -> DataFrame:
    """``(encoding, form, length_class, bound)``: tokens in bin ``bound`` or above are rejected as not random.

    Benjamini-Hochberg on bin counts: the largest p whose rank allows it. Every p of a bin counts as
    the bin's largest, which only makes the rule stricter. There are a few thousand bins at most.
    """
    bins = scored.groupBy("encoding", "form", "length_class", "bin").agg(F.count("*").alias("tokens"))
    stratum = Window.partitionBy("encoding", "form", "length_class")
    smaller = stratum.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = bins.withColumn("rank", F.sum("tokens").over(smaller)).withColumn("all", F.sum("tokens").over(stratum))
    allowed = F.pow(F.lit(10.0), -F.col("bin") * _BIN) <= level * F.col("rank") / F.col("all")
    return ranked.where(allowed).groupBy("encoding", "form", "length_class").agg(F.min("bin").alias("bound"))


def with_parts(each: DataFrame) -> DataFrame:
    """``each(doc_id, text_hash, span, token)`` with ``part``, and a further row for each part of a token that
    fits no encoding. Parts of a token can overlap; equal ones are one."""
    found = F.transform(
        F.concat(*(_spans("token", p, 0, 20) for p in PARTS)),
        lambda s: F.struct((s["start"] + F.col("span.start")).alias("start"), (s["end"] + F.col("span.start")).alias("end"), s["token"].alias("token")),
    )
    parts = each.where(_encoding(F.col("token")).isNull()).select("doc_id", "text_hash", F.explode(F.array_distinct(found)).alias("span"))
    return each.withColumn("part", F.lit(False)).union(parts.select("*", "span.token", F.lit(True).alias("part")))


def random_tokens(scanned: DataFrame, level: float = MAX_FALSE_DISCOVERIES) -> DataFrame:
    """``(doc_id, text_hash, random)``: the spans of tokens that pass as random. Runs a job that stores
    the test results, which two steps read."""
    each = scanned.select("doc_id", "text_hash", F.explode("tokens").alias("span")).select("doc_id", "text_hash", "span", "span.token")
    scored = cut_lineage(_with_strata(battery(with_parts(each))).select("doc_id", "text_hash", "span", "encoding", "form", "length_class", "bin"))
    bounds = rejection_bounds(scored, level)
    return (
        scored.join(bounds, ["encoding", "form", "length_class"], "left")
        .where("bound IS NULL OR bin < bound")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("span").alias("random"))
    )


def _listed(kinds: list[str]) -> Column:
    """All spans of ``kinds`` as ``kind:start:end``, by start, then kind."""
    of_kind = lambda kind: F.transform(
        F.coalesce(F.col(kind), F.expr("CAST(array() AS array<struct<start:int,end:int,token:string>>)")),
        lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end")),
    )
    names = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(F.concat(*map(of_kind, kinds)))
    return F.concat_ws(
        ",", F.transform(ordered, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    )


def find_secrets(documents: DataFrame, level: float = MAX_FALSE_DISCOVERIES) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` for every row of ``documents``.

    Positions count code points. A null text is empty and has no spans. Runs jobs: spans and test
    results are stored; no text is shuffled.
    """
    scanned = cut_lineage(scan_texts(documents))
    random = random_tokens(scanned, level)
    joined = scanned.alias("d").join(random.alias("r"), F.expr("d.doc_id <=> r.doc_id AND d.text_hash = r.text_hash"), "left")
    rows = joined.select("d.doc_id", "d.assign", "d.access", "d.hex", "r.random")
    return rows.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(_listed(list(KINDS[:3])), 256).alias("base_sha256"),
        _listed(list(KINDS)).alias("spans"),
    )
