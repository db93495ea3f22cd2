"""Regular-expression filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwright.functions.text import regex_full


def matching_rows(df: DataFrame, column: str, pattern: str, ignore_case: bool = False) -> DataFrame:
    """Rows whose whole value matches the pattern."""
    return df.where(regex_full(F.col(column), pattern, ignore_case))


def street_starts_with(df: DataFrame, column: str, letter: str) -> DataFrame:
    """Streets that start with a letter after any spaces, in either case."""
    return matching_rows(df, column, f" *{letter}.*", ignore_case=True)


def non_simple_house_number(df: DataFrame, column: str) -> DataFrame:
    """House numbers holding anything but digits (``37/36``, ``110A``)."""
    return matching_rows(df, column, ".*[^0-9].*")
