"""Metrics per event-time window of a stream, each window recorded once.

The watermark trails the newest event time of earlier batches by a delay.  A
window is final when the watermark has passed its end; it is then recorded and
never changes.  Rows that come after that are late: they change nothing but the
count of late rows.

Every batch leaves its partial aggregates per window under its own id.  A replay
writes the same rows again, so a failed batch counts once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StructField, StructType, TimestampType

from pairwright.operators import quality
from pairwright.operators.quality import Metric
from pairwright.streaming.monitor import run_id

PARTIALS = StructType(
    [
        StructField("start", TimestampType()),
        StructField("end", TimestampType()),
        StructField("late", BooleanType()),
        StructField("rows", LongType()),
        StructField("newest", TimestampType()),
        StructField("partial", ArrayType(DoubleType())),
        StructField("batch_id", LongType()),
    ]
)


def monitor_windowed(
    stream: DataFrame,
    metrics: Sequence[tuple[Metric, str]],
    time_column: str,
    table_name: str,
    results: str,
    checkpoint: str,
    window: str = "5 minutes",
    delay: str = "10 minutes",
    every: str | None = "5 minutes",
) -> StreamingQuery:
    """Record the metrics of every window when it is final, stamped with its end.

    Rows without an event time belong to no window.  ``every=None`` takes what is
    there now and stops.  :func:`late_rows` tells what came too late.
    """
    state = partials_folder(checkpoint)
    run = run_id(stream.sparkSession, checkpoint)

    def fold(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _batches(spark, state, batch_id - 1).agg(F.max("newest")).first()[0]
        passed = _less(F.lit(before).cast("timestamp"), delay)
        span = F.window(time_column, window)
        values = F.array(*[m.aggregate(c).cast("double") for m, c in metrics])
        counted = (
            batch.where(F.col(time_column).isNotNull())
            .groupBy(span.alias("span"))
            .agg(F.count(F.lit(1)).alias("rows"), F.max(time_column).cast("timestamp").alias("newest"), values.alias("partial"))
        )
        late = F.coalesce(F.col("span.end") <= passed, F.lit(False))
        told = counted.select("span.start", "span.end", late.alias("late"), "rows", "newest", "partial", F.lit(batch_id).cast("long").alias("batch_id"))
        told.write.mode("overwrite").parquet(f"{state}/{batch_id}")
        so_far = _batches(spark, state, batch_id)
        after = so_far.agg(F.max("newest")).first()[0]
        final = (F.col("end") <= _less(F.lit(after).cast("timestamp"), delay)) & ~F.coalesce(F.col("end") <= passed, F.lit(False))
        sums = so_far.where(~F.col("late") & final).groupBy("end").agg(*[F.sum(F.col("partial")[k]).alias(f"_m{k}") for k in range(len(metrics))])
        rows = [
            F.struct(F.lit(c).alias("column_name"), F.lit(m.name).alias("metric_name"), F.col(f"_m{k}").alias("value"))
            for k, (m, c) in enumerate(metrics)
        ]
        values = sums.select("end", F.inline(F.array(*rows)))
        # a window's measurement is of its end, whenever it was taken
        stamped = quality.measurements(values, table_name, F.col("end"), batch_id)
        quality.record_metrics(stamped, results, table_name, run, batch_id)

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(fold)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.trigger(**trigger).start()


def partials_folder(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-windows"


def _less(time: Column, delay: str) -> Column:
    return time - F.expr(f"interval {delay}")


def _batches(spark: SparkSession, state: str, last: int) -> DataFrame:
    """The partial aggregates of the batches up to ``last``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(state)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], PARTIALS)
    every = spark.read.schema(PARTIALS).option("recursiveFileLookup", "true").parquet(state)
    return every.where(F.col("batch_id") <= last)


def late_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``start, end, rows``: how many rows came too late for each window."""
    told = _batches(spark, partials_folder(checkpoint), 2**62)
    return told.where("late").groupBy("start", "end").agg(F.sum("rows").alias("rows"))


def counted_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``start, end, rows`` of every window that any row was counted in, final or not."""
    told = _batches(spark, partials_folder(checkpoint), 2**62)
    return told.where("NOT late").groupBy("start", "end").agg(F.sum("rows").alias("rows"))
