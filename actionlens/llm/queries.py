"""The numbered queries, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import byte_network, byte_pairs, hard_negatives, language, line_dedup, merkle, mixing, near_dedup, neighbours, pieces, quality_rules, secrets, suffixes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op1_line_dedup(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    return line_dedup.line_digests(documents, line_dedup.keep_bitmaps(documents))


@register
def op2_mixing(spark, sf_dir):
    return mixing.mix_documents(_table(spark, sf_dir, "documents")).drop("text_hash")


@register
def op7_quality_rules(spark, sf_dir):
    return quality_rules.judge_documents(_table(spark, sf_dir, "documents"))


def piece_model() -> str:
    """Path of the public piece model, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@register
def op10_pieces(spark, sf_dir):
    return pieces.piece_digests(_table(spark, sf_dir, "documents"), piece_model())


@register
def op8_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


@register
def op4_suffix_dedup(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    return suffixes.repeat_digests(documents, suffixes.repeated_ranges(documents))


@register
def op5_secrets(spark, sf_dir):
    return secrets.find_secrets(_table(spark, sf_dir, "documents"))


@register
def op3_quality_classifier(spark, sf_dir):
    return byte_network.held_out_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@register
def op9_language(spark, sf_dir):
    return language.held_out_languages(_table(spark, sf_dir, "documents"))


@register
def op6_neighbours(spark, sf_dir):
    return neighbours.search_table(_table(spark, sf_dir, "embeddings"))


@register
def op11_manifest(spark, sf_dir):
    return merkle.verified_manifest(_table(spark, sf_dir, "documents"))


@register
def op13_hard_negatives(spark, sf_dir):
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"))


def pair_model() -> str:
    """Path of the public byte-level vocabulary, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register
def op12_byte_pairs(spark, sf_dir):
    return byte_pairs.pair_digests(_table(spark, sf_dir, "documents"), pair_model())
