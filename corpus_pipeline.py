"""From raw documents to token ids: five stages, each on what the one before has kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its rows are written as Parquet and
read again as the next one's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actionlens.llm import line_dedup, mixing, near_dedup, pieces, quality_rules
from actionlens.llm.queries import piece_model
from actionlens.session import scratch_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; a null or empty text goes."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that others hold; ``n_chars`` follows the text. No row goes."""
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return kept.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else kept


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return near_dedup.keep_first_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix of sources takes them: a row for each pass over a document. Documents that
    the mix does not reach, and those without words, go."""
    return mixing.apply_mix(docs, mixing.mix_documents(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its piece ids, their number, and the text that the ids decode to."""
    coded = pieces.encode_and_decode(docs, piece_model())
    added = ["token_ids", "n_tokens"]
    return coded.select(*(c for c in docs.columns if c not in added), *added)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near-duplicates", near_copies),
    ("source mix", mixture),
    ("piece encoding", tokens),
]

# Fitting the rules' accuracies has no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        path = scratch_folder(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
