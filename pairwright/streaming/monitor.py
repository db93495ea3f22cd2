"""Repeated measurement of a growing table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pairwright.operators import quality
from pairwright.operators.quality import Metric


def monitor(
    stream: DataFrame,
    metrics: Sequence[tuple[Metric, str]],
    table_name: str,
    results: str,
    checkpoint: str,
    every: str | None = "5 minutes",
) -> StreamingQuery:
    """Measure the whole table so far at every trigger and record it.

    The metrics are running aggregates of the stream, so each firing reads
    only what arrived since the last one and yet reports on everything.  A
    batch is written under its id, so a replay after a failure replaces it; the
    run's own id is kept beside the checkpoint, so a stream that starts anew with
    another checkpoint leaves the earlier results alone.  A period in which
    nothing arrived writes nothing, as nothing can have changed; a table that loses or
    rewrites rows is for :mod:`pairwright.streaming.changes`.  ``every=None``
    measures what is there now and stops.
    """
    values = quality.evaluate(stream, metrics)
    run = run_id(stream.sparkSession, checkpoint)

    def record(batch: DataFrame, batch_id: int) -> None:
        stamped = quality.measurements(batch, table_name, batch_id=batch_id)
        quality.record_metrics(stamped, results, table_name, run, batch_id)

    writer = (
        values.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(record)
    )
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.trigger(**trigger).start()


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id kept beside a checkpoint, made on first use.

    It is a small table in the same store, so that any driver finds it.
    """
    place = f"{checkpoint.rstrip('/')}-run"
    spark.createDataFrame([(uuid.uuid4().hex,)], "run string").coalesce(1).write.mode("ignore").parquet(place)
    return spark.read.schema("run string").parquet(place).first()["run"]
