"""When bound metrics are to be measured again.

A binding's period is a text such as ``5 minutes``.  It is due when it was never
measured, or when its period has passed since its latest measurement.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.operators import quality
from pairwright.operators.quality import BINDINGS, SERIES, Metric

# Seconds of the units that a period may be given in.
UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
PERIOD = r"(?i)^\s*(\d+)\s*(second|minute|hour|day|week)s?\s*$"


def period_seconds(schedule: Column) -> Column:
    """The period's length; null for a text that is none, or a period of nothing."""
    amount = F.regexp_extract(schedule, PERIOD, 1).try_cast("long")
    unit = F.lower(F.regexp_extract(schedule, PERIOD, 2))
    size = F.lit(None).cast("long")
    for name, seconds in UNITS.items():
        size = F.when(unit == name, F.lit(seconds).cast("long")).otherwise(size)
    return F.nullif(amount * size, F.lit(0).cast("long"))


def due(bindings: DataFrame, results: DataFrame, now: datetime) -> DataFrame:
    """The bindings to be measured at ``now``, with ``latest``, ``due_at`` and ``missed``.

    ``missed`` counts the whole periods that went by without a measurement before
    the one that is due.  A binding without a readable period is due only while
    it has no measurement.
    """
    latest = results.groupBy(*SERIES).agg(F.max("measurement_time").alias("latest"))
    moment = F.lit(now).cast("timestamp")
    seconds = period_seconds(F.col("schedule"))
    due_at = F.timestamp_seconds(F.unix_micros("latest") / F.lit(1e6) + seconds)
    passed = (F.unix_micros(moment) - F.unix_micros("latest")) / (seconds * 1_000_000)
    timed = bindings.join(latest, list(SERIES), "left").withColumns(
        {"due_at": F.coalesce(F.when(F.col("latest").isNotNull(), due_at), F.when(F.col("latest").isNull(), moment))}
    )
    missed = F.greatest(F.floor(passed).cast("long") - F.lit(1), F.lit(0).cast("long"))
    return timed.where(F.col("due_at") <= moment).withColumn("missed", F.coalesce(missed, F.lit(0).cast("long")))


def measure_due(
    tables: Mapping[str, DataFrame],
    bindings: DataFrame,
    results: DataFrame,
    known: Sequence[Metric],
    now: datetime,
    batch_id: int = 0,
) -> DataFrame:
    """Measurements of what is due; tables with nothing due are not read."""
    wanted = due(bindings, results, now).select(*BINDINGS.names)
    return quality.measure(tables, wanted, known, now, batch_id)
