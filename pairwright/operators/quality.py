"""Quality metrics: definitions, bindings, measurements and their history."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from pairwright.functions import identifiers

CORE = "CORE"

RESULTS = StructType(
    [
        StructField("measurement_time", TimestampType()),
        StructField("table_name", StringType()),
        StructField("column_name", StringType()),
        StructField("metric_name", StringType()),
        StructField("value", DoubleType()),
        StructField("batch_id", LongType()),
    ]
)
# What tells one series of measurements from another.
SERIES = ("table_name", "column_name", "metric_name")
BINDINGS = StructType(
    [StructField(n, StringType()) for n in ("table_name", "column_name", "metric_name", "schedule")]
)


@dataclass(frozen=True)
class Metric:
    """A named aggregate over one column of a table."""

    name: str
    aggregate: Callable[[str], Column]
    schema_name: str = "QUALITY_METRICS"


def invalid_pesel_count(column: str) -> Column:
    """How many values are null, malformed or the placeholder."""
    return F.count_if(identifiers.is_invalid_pesel_format(F.col(column)))


INVALID_PESEL_COUNT = Metric("INVALID_PESEL_COUNT", invalid_pesel_count)
NULL_COUNT = Metric("NULL_COUNT", lambda c: F.count_if(F.col(c).isNull()), CORE)
ROW_COUNT = Metric("ROW_COUNT", lambda _: F.count(F.lit(1)), CORE)


def audit_pesel(df: DataFrame, column: str, flag: str = "pesel_valid") -> DataFrame:
    """Flag every row by the checksum rule."""
    return df.withColumn(flag, identifiers.is_valid_pesel(F.col(column)))


def audit_summary(df: DataFrame, column: str) -> DataFrame:
    """Row, checksum-valid and format-invalid counts in one scan."""
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(identifiers.is_valid_pesel(F.col(column))).alias("checksum_valid"),
        invalid_pesel_count(column).alias("format_invalid"),
    )


def evaluate(df: DataFrame, metrics: Sequence[tuple[Metric, str]]) -> DataFrame:
    """(column_name, metric_name, value), all metrics in one scan."""
    aggregates = [m.aggregate(c).cast("double").alias(f"_m{i}") for i, (m, c) in enumerate(metrics)]
    rows = [
        F.struct(
            F.lit(column).alias("column_name"),
            F.lit(metric.name).alias("metric_name"),
            F.col(f"_m{i}").alias("value"),
        )
        for i, (metric, column) in enumerate(metrics)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def measurements(
    values: DataFrame, table_name: str, at: datetime | Column | None = None, batch_id: int = 0
) -> DataFrame:
    """Stamp evaluated values as rows of the results table, with a time or a column of times."""
    moment = F.current_timestamp() if at is None else at if isinstance(at, Column) else F.lit(at).cast("timestamp")
    return values.select(
        moment.alias("measurement_time"),
        F.lit(table_name).alias("table_name"),
        "column_name",
        "metric_name",
        F.col("value").cast("double").alias("value"),
        F.lit(batch_id).cast("long").alias("batch_id"),
    )


def record_metrics(stamped: DataFrame, folder: str, table_name: str, run: str, batch_id: int) -> None:
    """Append one batch of a table's measurements; writing it again replaces it.

    Every batch of every run of every table owns a folder, so a retried or
    replayed batch never counts twice, and neither another table nor a run that
    starts to count anew overwrites it.
    """
    owner = "/".join(quote(part, safe="") for part in (table_name, run, str(batch_id)))
    stamped.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{owner}")


def no_results(spark: SparkSession) -> DataFrame:
    """The results of tables that were never measured."""
    return spark.createDataFrame([], RESULTS)


def read_results(spark: SparkSession, folder: str) -> DataFrame:
    """The measurements of all tables, runs and batches."""
    return spark.read.schema(RESULTS).option("recursiveFileLookup", "true").parquet(folder)


def results_for(results: DataFrame, table_name: str) -> DataFrame:
    """The measurements of one table."""
    return results.where(F.col("table_name") == table_name)


def history(results: DataFrame, metric: str | None = None, newest_first: bool = False) -> DataFrame:
    """(measurement_time, table_name, column_name, metric_name, value) in time order."""
    chosen = results if metric is None else results.where(F.col("metric_name") == metric)
    typed = chosen.select(
        F.col("measurement_time").cast("timestamp").alias("measurement_time"),
        *SERIES,
        F.col("value").cast("double").alias("value"),
    )
    time = F.col("measurement_time")
    return typed.orderBy(time.desc() if newest_first else time.asc(), *SERIES)


def latest_metric(results: DataFrame) -> DataFrame:
    """The newest value of every metric of every column and table; the later batch wins a tie."""
    tie = [F.col("batch_id")] if "batch_id" in results.columns else []
    newest = F.max_by(
        F.struct("measurement_time", "value"), F.struct(F.col("measurement_time"), *tie, F.col("value"))
    )
    return results.groupBy(*SERIES).agg(newest.alias("newest")).select(
        *SERIES,
        F.col("newest.measurement_time").alias("measurement_time"),
        F.col("newest.value").alias("value"),
    )


def metric_names(results: DataFrame) -> DataFrame:
    return results.select("metric_name").distinct()


def metrics_df(spark: SparkSession, metrics: Sequence[Metric]) -> DataFrame:
    """The known metrics, by schema and name."""
    return spark.createDataFrame(
        [(m.schema_name, m.name) for m in metrics], "schema_name string, metric_name string"
    )


def outside_core(listing: DataFrame) -> DataFrame:
    """Metrics that do not belong to the core schema."""
    return listing.where(F.col("schema_name") != CORE)


def bindings_df(spark: SparkSession, rows: Sequence[tuple[str, str, str, str]] = ()) -> DataFrame:
    return spark.createDataFrame(list(rows), BINDINGS)


def _is_binding(table_name: str, column_name: str, metric_name: str) -> Column:
    return (
        (F.col("table_name") == table_name)
        & (F.col("column_name") == column_name)
        & (F.col("metric_name") == metric_name)
    )


def detach(bindings: DataFrame, table_name: str, column_name: str, metric_name: str) -> DataFrame:
    """Bindings without the given one."""
    return bindings.where(~_is_binding(table_name, column_name, metric_name))


def attach(
    bindings: DataFrame, table_name: str, column_name: str, metric_name: str, schedule: str = "5 minutes"
) -> DataFrame:
    """Bindings with the given one, replacing an earlier copy of it."""
    added = bindings.sparkSession.createDataFrame(
        [(table_name, column_name, metric_name, schedule)], BINDINGS
    )
    return detach(bindings, table_name, column_name, metric_name).unionByName(added)


def set_schedule(bindings: DataFrame, table_name: str, schedule: str) -> DataFrame:
    """Change the measurement period of one table."""
    changed = F.when(F.col("table_name") == table_name, F.lit(schedule))
    return bindings.withColumn("schedule", F.coalesce(changed, F.col("schedule")))


def bindings_for(bindings: DataFrame, table_name: str) -> DataFrame:
    return bindings.where(F.col("table_name") == table_name)


def attached_metrics(bindings: DataFrame, table_name: str, known: Sequence[Metric]) -> list[tuple[Metric, str]]:
    """The metrics bound to a table, ready for :func:`evaluate`.

    Bindings are written by hand, one for a metric of a column, and each becomes
    an aggregate of one query.
    """
    rows = bindings_for(bindings, table_name).orderBy("metric_name", "column_name").collect()
    by_name = {metric.name: metric for metric in known}
    return [(by_name[row["metric_name"]], row["column_name"]) for row in rows]


def measure(
    tables: Mapping[str, DataFrame],
    bindings: DataFrame,
    known: Sequence[Metric],
    at: datetime | None = None,
    batch_id: int = 0,
) -> DataFrame:
    """Measurements of everything that is bound, one scan per table.

    Tables without bindings are not read; bindings of other tables are left
    alone.  What is due by its ``schedule`` is told by :mod:`pairwright.operators.periods`.
    """
    frames = []
    for name, table in tables.items():
        attached = attached_metrics(bindings, name, known)
        if attached:
            frames.append(measurements(evaluate(table, attached), name, at, batch_id))
    return reduce(DataFrame.unionAll, frames) if frames else bindings.sparkSession.createDataFrame([], RESULTS)


def matching_names(frame: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose name matches a LIKE pattern."""
    return frame.where(F.col(column).like(pattern))
