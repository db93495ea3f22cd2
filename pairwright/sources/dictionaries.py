"""The standardization dictionary and its rules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

DICTIONARY = StructType(
    [
        StructField("token", StringType()),
        StructField("term", StringType()),
        StructField("context", StringType()),
    ]
)

# The first names and address words, each with its short form and context.
STANDARD_ROWS = [
    ("MAXINE", "MAX", "NAME"),
    ("MAXIMO", "MAX", "NAME"),
    ("MAXIE", "MAX", "NAME"),
    ("MAXWELL", "MAX", "NAME"),
    ("JEFFREY", "JEFF", "NAME"),
    ("JEFFERY", "JEFF", "NAME"),
    ("JEFFRY", "JEFF", "NAME"),
    ("JEFFIE", "JEFF", "NAME"),
    ("JEFFERSON", "JEFF", "NAME"),
    ("JACKIE", "JACK", "NAME"),
    ("JACKSON", "JACK", "NAME"),
    ("JACKI", "JACK", "NAME"),
    ("JACKLYN", "JACK", "NAME"),
    ("JACKELYN", "JACK", "NAME"),
    ("LEONA", "LEO", "NAME"),
    ("LEONARDO", "LEO", "NAME"),
    ("LEONILA", "LEO", "NAME"),
    ("LEOLA", "LEO", "NAME"),
    ("LEON", "LEO", "NAME"),
    ("LEONARD", "LEO", "NAME"),
    ("LEONIDA", "LEO", "NAME"),
    ("AVENUE", "AVE", "ADDRESS"),
    ("STREET", "ST", "ADDRESS"),
    ("BOULEVARD", "BLVD", "ADDRESS"),
    ("COURT", "CT", "ADDRESS"),
    ("LANE", "LN", "ADDRESS"),
    ("CIRCLE", "CIR", "ADDRESS"),
    ("PARKWAY", "PKWY", "ADDRESS"),
    ("WAY", "WY", "ADDRESS"),
    ("DRIVE", "DR", "ADDRESS"),
    ("FIRST", "1ST", "ADDRESS"),
    ("SECOND", "2ND", "ADDRESS"),
    ("THIRD", "3RD", "ADDRESS"),
    ("FOURTH", "4TH", "ADDRESS"),
    ("FIFTH", "5TH", "ADDRESS"),
    ("SIXTH", "6TH", "ADDRESS"),
    ("SEVENTH", "7TH", "ADDRESS"),
    ("EIGHTH", "8TH", "ADDRESS"),
    ("NINTH", "9TH", "ADDRESS"),
    ("ELEVENTH", "11TH", "ADDRESS"),
]


def dictionary_df(spark: SparkSession, rows: Iterable[tuple[str, str, str]] | None = None) -> DataFrame:
    """A dictionary frame from given rows, or the standard one."""
    return spark.createDataFrame(list(STANDARD_ROWS if rows is None else rows), DICTIONARY)


def validate_dictionary(dictionary: DataFrame) -> DataFrame:
    """Violations of the two rules: no nulls, and one term per token and context."""
    keys = dictionary.groupBy("token", "context").agg(
        F.count(F.lit(1)).alias("entries"),
        F.count_if(
            F.col("token").isNull() | F.col("term").isNull() | F.col("context").isNull()
        ).alias("with_null"),
    )
    problems = F.array_compact(
        F.array(
            F.when(F.col("with_null") > 0, F.lit("null")),
            F.when(F.col("entries") > 1, F.lit("duplicate")),
        )
    )
    return keys.select("token", "context", "entries", F.explode(problems).alias("problem"))
