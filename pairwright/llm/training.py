"""Bounded samples of labelled texts, for models that are fitted in one place.

The bound is a number of rows; which rows is decided by a hash of the id, so
the sample is the same in every run and does not depend on partitions.  Held-out
rows never take part.  What a fit needs of a text is worked out beside the text,
on the executors; no text is sent to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairwright.llm.frames import held_out, landed, text_of
from pairwright.llm.words import tidied

# Labelled ids are numbered in so many parts first, so that a common label is not one task's.
PARTS = 256


def sample_ids(labelled: DataFrame, label: Column, per_class: int) -> DataFrame:
    """At most ``per_class`` ids of each label: ``doc_id``, ``label``."""
    rows = labelled.select("doc_id", label.alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out()
    )
    by_hash = (F.xxhash64("doc_id"), F.col("doc_id"))
    part = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(PARTS))
    in_part = Window.partitionBy("label", "part").orderBy(*by_hash)
    of_label = Window.partitionBy("label").orderBy(*by_hash)
    few = rows.withColumn("part", part).withColumn("nth", F.row_number().over(in_part)).where(F.col("nth") <= per_class)
    few = few.withColumn("nth", F.row_number().over(of_label)).where(F.col("nth") <= per_class)
    return few.select("doc_id", "label")


def sample(
    docs: DataFrame,
    labelled: DataFrame,
    label: Column,
    per_class: int,
    of_text: Callable[[Column], Column],
    text_column: str = "text",
) -> DataFrame:
    """``value`` (``of_text``) and ``label`` of the sampled rows of label 0 or 1 in a fixed order, in one partition.

    There are at most twice ``per_class`` of them.  The ids that are broadcast are as few as that, whatever the
    size of the tables.
    """
    ids = sample_ids(labelled, label, per_class).where(F.col("label").isin(0, 1))
    texts = docs.select("doc_id", text_of(text_column).alias("text"))
    return (
        texts.join(F.broadcast(ids), "doc_id")
        .select(F.xxhash64("doc_id").alias("by_id"), F.xxhash64("text").alias("by_text"), "label", of_text(F.col("text")).alias("value"))
        .orderBy("by_id", "by_text", "label")
        .limit(per_class * 2)
        .select("value", "label")
    )


def sample_of_every_label(docs: DataFrame, label: Column, per_class: int, of_text: Callable[[Column], Column]) -> DataFrame:
    """``value`` (``of_text``) and ``label`` of at most ``per_class`` rows of each label of ``docs`` itself, however many labels there are.

    They are written, as one reading of the texts serves all uses.
    """
    ids = sample_ids(docs, label, per_class).distinct()
    found = docs.select("doc_id", label.alias("label"), text_of().alias("text")).join(ids, ["doc_id", "label"])
    by = (F.xxhash64("doc_id"), F.xxhash64("text"))
    # repeated ids may have brought more rows
    few = found.withColumn("nth", F.row_number().over(Window.partitionBy("label").orderBy(*by))).where(F.col("nth") <= per_class)
    return landed(few.select("label", of_text(F.col("text")).alias("value")), "sample")


def fitted(sampled: DataFrame, fit: Callable[[pa.Table], dict], schema: str) -> dict | None:
    """What ``fit`` makes of a sample, in one task; None without any row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield pa.RecordBatch.from_pylist([fit(pa.Table.from_batches(held))])

    row = sampled.coalesce(1).mapInArrow(tidied(run), schema).first()
    return row.asDict() if row else None
