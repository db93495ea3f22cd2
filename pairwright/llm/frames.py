"""Helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwright.session import shared_folder

FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def landed(df: DataFrame, purpose: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: the lineage ends here.

    A lost executor then costs a read of these files, never the work before.
    """
    return Scratch().landed(df, purpose, options)


class Scratch:
    """Tables written on the way to a result, removed when all that is made of them is written itself."""

    def __init__(self) -> None:
        self.written: list[tuple[SparkSession, str]] = []

    def landed(self, df: DataFrame, purpose: str, options: Mapping[str, str] | None = None) -> DataFrame:
        """As :func:`landed`."""
        spark = df.sparkSession
        path = shared_folder(spark, purpose)
        df.write.options(**(options or {})).parquet(path)
        self.written.append((spark, path))
        return spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Remove the tables, through the file system that Spark wrote them with.

        Spark removes the shuffle files of plans that its driver has collected as
        garbage, so it is asked to look for some.
        """
        for spark, path in self.written:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
            spark._jvm.System.gc()
        self.written = []


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a row is kept from every fit: crc32 of its id as text, mod 5, is 0.

    A row without an id counts as one with the empty text, so it is held out.
    """
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return F.crc32(text) % FOLDS == 0


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


ROW = "row"


def wrapped(docs: DataFrame, **more: Column) -> DataFrame:
    """Each row of ``docs`` as one struct ``row``, with ``more`` beside it, so that no names can clash."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW), *[c.alias(n) for n, c in more.items()]
    )


def unwrapped(rows: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The rows that :func:`wrapped` packed, some columns changed."""
    return rows.select(*[changed[c].alias(c) if c in changed else F.col(f"{ROW}.`{c}`").alias(c) for c in columns])
