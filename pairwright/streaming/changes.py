"""Measuring a table that changes in any way, without reading it whole each time.

Metrics are kept per file, as partial aggregates that add up to the table's.  Each
time, files are listed; only files that are new or were written again are read,
and those that vanished drop out.  The sum is recorded whether or not anything
changed, as a measurement of the whole table would be.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType, TimestampType

from pairwright.operators import quality
from pairwright.operators.quality import Metric

PARTIALS = StructType(
    [
        StructField("file", StringType()),
        StructField("size", LongType()),
        StructField("modified", TimestampType()),
        StructField("partial", ArrayType(DoubleType())),
        StructField("version", LongType()),
    ]
)


def listed(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """``file, size, modified`` of the table's files; none of them is opened."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_modification_time").alias("modified"),
        )
    )


def kept(spark: SparkSession, state: str) -> tuple[DataFrame, int]:
    """The newest version of the partial aggregates, and its number; version 0 is empty."""
    place = spark._jvm.org.apache.hadoop.fs.Path(state)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], PARTIALS), 0
    every = spark.read.schema(PARTIALS).parquet(state)
    newest = every.agg(F.max("version")).first()[0] or 0
    return every.where(F.col("version") == newest), newest


def partial_metrics(
    spark: SparkSession, files: Sequence[str], schema: StructType, metrics: Sequence[tuple[Metric, str]]
) -> DataFrame:
    """``file, partial``: each file's own value of every metric."""
    values = F.array(*[m.aggregate(column).cast("double") for m, column in metrics])
    if not files:
        return spark.createDataFrame([], "file string, partial array<double>")
    rows = spark.read.schema(schema).parquet(*[unquote(f) for f in files])
    return rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(values.alias("partial"))


def measure_changes(
    spark: SparkSession,
    path: str,
    schema: StructType,
    metrics: Sequence[tuple[Metric, str]],
    table_name: str,
    results: str,
    state: str,
    at: datetime | None = None,
) -> int:
    """Record the metrics of the table as it is now; returns how many files were read.

    The metrics are counts, so files add up.  The list of changed files is what
    the driver plans the reading with.  The new partial aggregates are written as
    another version; the version before stays readable.
    """
    known, version = kept(spark, state)
    now = listed(spark, path)
    same = ["file", "size", "modified"]
    changed = now.join(known, same, "left_anti")
    names = [r["file"] for r in changed.select("file").collect()]
    nothing = F.array(*[F.lit(0.0)] * len(metrics))
    fresh = changed.join(partial_metrics(spark, names, schema, metrics), "file", "left")
    fresh = fresh.select(*same, F.coalesce("partial", nothing).alias("partial"))
    valid = known.select(*same, "partial").join(now, same, "left_semi").unionByName(fresh)
    number = version + 1
    valid.withColumn("version", F.lit(number).cast("long")).write.mode("append").parquet(state)
    current = spark.read.schema(PARTIALS).parquet(state).where(F.col("version") == number)
    sums = current.agg(*[F.coalesce(F.sum(F.col("partial")[k]), F.lit(0.0)).alias(f"_m{k}") for k in range(len(metrics))])
    values = sums.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.lit(m.name).alias("metric_name"), F.col(f"_m{k}").alias("value"))
                    for k, (m, c) in enumerate(metrics)
                ]
            )
        )
    )
    stamped = quality.measurements(values, table_name, at, number)
    quality.record_metrics(stamped, results, table_name, "changes", number)
    return len(names)
