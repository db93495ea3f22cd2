"""A corpus made ready for training: five stages over ``documents``, each an operator of ``pairwright.llm``.

Each stage takes what its predecessor kept and, but for the last, returns the
columns of ``documents``: toxic documents go, of equal texts one stays, of each
group of nearly equal texts (five words a shingle, a similarity of 0.8) one
stays, secrets are masked in place, and what is left is packed to token windows.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwright.llm import exact_dedup, jaccard_join, packing, secret_scan, toxicity
from pairwright.llm.frames import landed, table

TOXIC = 0.5
NEAR = jaccard_join.Rule(words=5, percent=80)
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

# The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC``."""
    model = toxicity.fit_on(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score_column(model, F.col("text")) < TOXIC)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of nearly equal texts."""
    return jaccard_join.one_of_each(docs, NEAR)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with asterisks where a secret was."""
    return secret_scan.masked(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in token windows."""
    return packing.packing(docs, TOKENIZER)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", mask_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's result is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
