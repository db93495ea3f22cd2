"""Exact dedup: one document of each group of equal texts stays.

Texts are grouped by a 128-bit hash of the text without white space.  The bytes
themselves are part of the grouping key, so texts that merely share a hash fall
into groups of their own.  Copies fold into one row per group on the side of
the scan, before the shuffle: a text that a third of the rows share reaches the
shuffle once per task.  Documents then find their group by hash and digest,
which moves no text.

Defined cases: a null text counts as empty; of equally long texts the smallest
id stays, an id before a null; rows that repeat the id and the length of the
row that stays are the same document and are marked kept as well; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.llm.frames import text_of, unwrapped, wrapped

WHITE_SPACE = "[\\x20\\x09-\\x0D]+"


def normalised(text: Column) -> Column:
    """The text without its ASCII white space."""
    return F.regexp_replace(text, WHITE_SPACE, "")


def content_hash(text: Column) -> Column:
    """128 bits of the content."""
    return F.unhex(F.md5(text))


def _keyed(docs: DataFrame, id_column: str, text_column: str, hashed: Callable[[Column], Column]) -> DataFrame:
    text = text_of(text_column)
    return docs.select(
        F.col(id_column).alias("doc_id"),
        F.char_length(text).alias("n"),
        normalised(text).alias("content"),
    ).withColumn("hash", hashed(F.col("content")))


def groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per distinct text: ``hash``, ``text_sha256``, ``keep_id``, ``longest``, ``group_size``."""
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    return (
        _keyed(docs, id_column, text_column, hashed)
        .groupBy("hash", "content")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
        .select(
            "hash",
            F.sha2("content", 256).alias("text_sha256"),
            F.col("best.doc_id").alias("keep_id"),
            (-F.col("best.less")).alias("longest"),
            "group_size",
        )
    )


def exact_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """Every row of ``docs`` with its group and whether it stays."""
    rows = _keyed(docs, id_column, text_column, hashed).select(
        "doc_id", "n", "hash", F.sha2("content", 256).alias("text_sha256")
    )
    found = groups(docs, id_column, text_column, hashed)
    return rows.join(found, ["hash", "text_sha256"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n") == F.col("longest"))).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns; of repeated rows, one."""
    text = text_of(text_column)
    content = normalised(text)
    rows = wrapped(
        docs,
        doc_id=F.col(f"`{id_column}`"),
        n=F.char_length(text),
        hash=content_hash(content),
        text_sha256=F.sha2(content, 256),
    )
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n") == F.col("longest"))
    kept = rows.join(groups(docs, id_column, text_column), ["hash", "text_sha256"]).where(stays)
    alone = kept.where(F.col("group_size") == 1)
    copied = kept.where(F.col("group_size") > 1).dropDuplicates(["hash", "text_sha256"])
    return unwrapped(alone.unionByName(copied), docs.columns)


ORACLE = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents
), g AS (
  SELECT content, arg_min(doc_id, (-n, doc_id)) AS keep_id, count(*) AS group_size
  FROM t GROUP BY content
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(content) AS text_sha256
FROM t JOIN g USING (content)
"""
