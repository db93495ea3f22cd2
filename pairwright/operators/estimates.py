"""Sizing a matching job before it runs, from counts alone."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Wide enough that n*n of any table fits.
WIDE = "decimal(38,0)"


def all_known(columns: Sequence[str]) -> Column:
    """True where none of the columns is null."""
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))


def block_sizes(df: DataFrame, block: Sequence[str]) -> DataFrame:
    """Records per block, null blocks included."""
    return df.groupBy(*block).agg(F.count(F.lit(1)).alias("records"))


def largest_blocks_first(df: DataFrame, block: Sequence[str]) -> DataFrame:
    return block_sizes(df, block).orderBy(F.desc("records"), *block)


def estimate_pairs(df: DataFrame, block: Sequence[str] = ()) -> DataFrame:
    """How many pairs a job would compare, without forming any.

    ``ordered_pairs`` is the sum of n*n over blocks: every order, each record
    with itself, null blocks included.  ``candidate_pairs`` is what the join
    yields: n(n-1)/2 over blocks without nulls.  Without a block the whole
    table is one block.
    """
    sizes = block_sizes(df, block)
    records = F.col("records").cast("decimal(19,0)")
    unordered = (records * (records - F.lit(1)) / F.lit(2)).cast(WIDE)
    joined = F.when(all_known(block), unordered).otherwise(F.lit(0)) if block else unordered
    return sizes.agg(
        F.count(F.lit(1)).alias("blocks"),
        F.sum("records").alias("records"),
        F.max("records").alias("largest_block"),
        F.sum((records * records).cast(WIDE)).cast(WIDE).alias("ordered_pairs"),
        F.sum(joined).cast(WIDE).alias("candidate_pairs"),
    )


def pair_report(df: DataFrame, block: Sequence[str]) -> DataFrame:
    """The estimate without blocking and with it, one labelled row each."""
    plain = estimate_pairs(df).select(F.lit("none").alias("blocking"), "*")
    blocked = estimate_pairs(df, block).select(F.lit(",".join(block)).alias("blocking"), "*")
    return plain.unionAll(blocked)


def pair_count(df: DataFrame, column: str, value: str) -> DataFrame:
    """Pairs within one named block, with and without an order on the ids.

    Only counts are wanted, so the block is counted and never joined.
    """
    n = F.count(F.lit(1)).cast("decimal(19,0)")
    return df.where(F.col(column) == value).agg(
        F.count(F.lit(1)).alias("records"),
        (n * n).cast(WIDE).alias("all_pairs"),
        (n * (n - F.lit(1)) / F.lit(2)).cast(WIDE).alias("ordered_once"),
    )
