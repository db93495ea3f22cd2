"""The queries of this folder and their SQL twins, as the driver names them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwright.llm import alignment, byte_pairs, exact_dedup, jaccard_join, language_id, merkle, packing, piece_ids, quality, repeats, secret_scan, top_k, toxicity
from pairwright.llm.frames import table

Query = Callable[[SparkSession, str], DataFrame]

BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text of ``documents``."""
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every text of ``documents``."""
    return secret_scan.secret_scan(table(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of nearly equal texts of ``documents``."""
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token windows of all of ``documents``."""
    return packing.packing(table(spark, sf_dir, "documents"), BYTE_TOKENIZER)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text of ``documents``."""
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts of ``documents``."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of ``embeddings`` of every fiftieth."""
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated strings of 400 bytes of ``documents``, removed."""
    return repeats.without_repeats(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text of ``documents``."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_piece_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every text of ``documents``."""
    return piece_ids.piece_ids(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all ``documents`` against their manifest, some rows tampered with."""
    return merkle.checked_copy(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two vocabularies that end together, in every text of ``documents``."""
    return alignment.alignment(table(spark, sf_dir, "documents"), BYTE_TOKENIZER, PIECE_MODEL)


def op13_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every text of ``documents``, by ranks."""
    return byte_pairs.byte_pairs(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_secret_scan": op2_secret_scan,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_packing": op4_packing,
    "op5_language_id": op5_language_id,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_top_k": op7_top_k,
    "op8_repeats": op8_repeats,
    "op9_toxicity": op9_toxicity,
    "op10_piece_ids": op10_piece_ids,
    "op11_merkle": op11_merkle,
    "op12_alignment": op12_alignment,
    "op13_byte_pairs": op13_byte_pairs,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op2_secret_scan": secret_scan.ORACLE,
    "op3_jaccard_join": jaccard_join.ORACLE,
    "op6_exact_dedup": exact_dedup.ORACLE,
    "op7_top_k": top_k.ORACLE,
    "op8_repeats": repeats.ORACLE,
    "op11_merkle": merkle.ORACLE,
}
