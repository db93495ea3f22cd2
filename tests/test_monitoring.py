"""Periods, changing tables and event-time windows."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pairwright.operators import periods, quality
from pairwright.streaming import changes, windows

START = datetime(2025, 1, 1)
METRICS = [(quality.ROW_COUNT, "id"), (quality.NULL_COUNT, "v")]


@pytest.mark.parametrize(
    "text, seconds",
    [("5 minutes", 300), ("5 MINUTE", 300), (" 1440 minutes ", 86400), ("1 hour", 3600), ("2 days", 172800), ("30 seconds", 30), ("1 week", 604800), ("0 minutes", None), ("soon", None), ("", None), (None, None), ("5", None)],
)
def test_periods_are_read(spark, text, seconds):
    frame = spark.createDataFrame([(text,)], "p string")
    assert frame.select(periods.period_seconds(F.col("p"))).first()[0] == seconds


def test_what_is_due(spark):
    bound = quality.bindings_df(spark, [("a", "x", "M", "10 minutes"), ("b", "x", "M", "5 minutes"), ("c", "x", "M", "1 hour"), ("d", "x", "M", "soon"), ("e", "x", "M", "soon")])
    results = spark.createDataFrame(
        [(START, "a", "x", "M", 1.0, 0), (START, "b", "x", "M", 1.0, 0), (START + timedelta(minutes=5), "b", "x", "M", 1.0, 1), (START, "d", "x", "M", 1.0, 0)], quality.RESULTS
    )

    def told(minutes):
        found = periods.due(bound, results, START + timedelta(minutes=minutes)).collect()
        return {(r["table_name"], r["missed"]) for r in found}

    # c and e were never measured; d was, and has no period
    assert told(9) == {("c", 0), ("e", 0)}
    assert told(10) == {("a", 0), ("b", 0), ("c", 0), ("e", 0)}
    assert told(25) == {("a", 1), ("b", 3), ("c", 0), ("e", 0)}
    at = periods.due(bound, results, START + timedelta(minutes=25)).where("table_name = 'a'").first()
    assert at["due_at"] == START + timedelta(minutes=10) and at["latest"] == START


def test_only_what_is_due_is_read(spark, tmp_path):
    """A table whose files are gone is not touched while it is not due."""
    spark.range(3).write.parquet(f"{tmp_path}/gone")
    gone = spark.read.parquet(f"{tmp_path}/gone")
    for name in os.listdir(f"{tmp_path}/gone"):
        os.remove(f"{tmp_path}/gone/{name}")
    bound = quality.bindings_df(spark, [("gone", "id", "ROW_COUNT", "1 hour"), ("here", "id", "ROW_COUNT", "1 minute")])
    before = spark.createDataFrame([(START, "gone", "id", "ROW_COUNT", 3.0, 0)], quality.RESULTS)
    found = periods.measure_due({"gone": gone, "here": spark.range(2)}, bound, before, [quality.ROW_COUNT], START + timedelta(minutes=5), 4)
    assert [(r["table_name"], r["value"], r["batch_id"]) for r in found.collect()] == [("here", 2.0, 4)]


def test_a_table_that_changes_any_way(spark, tmp_path):
    table, results, state = (f"{tmp_path}/{n}" for n in ("t able", "results", "state"))
    schema = spark.createDataFrame([], "id long, v string").schema

    def rows(first, count, step):
        made = spark.range(first, first + count).selectExpr("id", f"IF(id % {step} = 0, null, 'x') AS v")
        return made.coalesce(1)

    def measured(at):
        read = changes.measure_changes(spark, table, schema, METRICS, "t", results, state, at=START + timedelta(minutes=at))
        recorded = quality.read_results(spark, results).where(F.col("measurement_time") == START + timedelta(minutes=at))
        whole = quality.evaluate(spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(table), METRICS)
        key = lambda frame: sorted((r["metric_name"], r["value"]) for r in frame.collect())
        assert key(recorded) == key(whole)
        return read

    rows(0, 10, 2).write.parquet(f"{table}/a")
    rows(10, 10, 3).write.parquet(f"{table}/b")
    assert measured(0) == 2
    assert measured(5) == 0  # nothing happened, and it is recorded
    rows(20, 5, 2).write.mode("append").parquet(f"{table}/a")
    assert measured(10) == 1
    rows(0, 30, 5).write.mode("overwrite").parquet(f"{table}/b")
    assert measured(15) == 1
    for name in os.listdir(f"{table}/a"):
        os.remove(f"{table}/a/{name}")
    assert measured(20) == 0
    rows(5, 0, 2).write.mode("overwrite").parquet(f"{table}/b")
    measured(25)
    history = quality.history(quality.read_results(spark, results), "ROW_COUNT").collect()
    assert [r["value"] for r in history] == [20.0, 20.0, 25.0, 45.0, 30.0, 0.0]


def test_a_file_written_again_in_place_counts_anew(spark, tmp_path):
    table, results, state = (f"{tmp_path}/{n}" for n in ("table", "results", "state"))
    schema = spark.createDataFrame([], "id long, v string").schema
    for count in (4, 9):
        made = spark.range(count).selectExpr("id", "'x' AS v").coalesce(1)
        made.write.mode("overwrite").parquet(f"{tmp_path}/made")
        part = next(n for n in os.listdir(f"{tmp_path}/made") if n.endswith(".parquet"))
        os.makedirs(table, exist_ok=True)
        with open(f"{tmp_path}/made/{part}", "rb") as source, open(f"{table}/one.parquet", "wb") as target:
            target.write(source.read())
        assert changes.measure_changes(spark, table, schema, METRICS, "t", results, state) == 1
    values = quality.latest_metric(quality.read_results(spark, results)).where("metric_name = 'ROW_COUNT'").first()
    assert values["value"] == 9.0


def events(minutes, first=0):
    return [(first + k, START + timedelta(minutes=m) if m is not None else None, None if k % 3 == 0 else "x") for k, m in enumerate(minutes)]


def run_windows(spark, source, results, marks, batch, number):
    spark.createDataFrame(batch, "id long, ts timestamp, v string").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("id long, ts timestamp, v string").parquet(source)
    windows.monitor_windowed(stream, METRICS, "ts", "t", results, marks, every=None).awaitTermination()


def test_windows_are_final_once_and_late_rows_are_counted(spark, tmp_path):
    source, results, marks = (f"{tmp_path}/{n}" for n in ("in", "out", "marks"))
    # delay 10: after the first batch the watermark is at minute 12
    batches = [[0, 1, 6, 22, None], [2, 11, 13, 24], [40, 39, 12], [8, 26, 55], [56]]
    for number, batch in enumerate(batches):
        run_windows(spark, source, results, marks, events(batch, 100 * number), number)
    recorded = quality.read_results(spark, results)
    counted = {
        int((r["measurement_time"] - START).total_seconds() // 60): (r["value"], r["batch_id"])
        for r in recorded.where("metric_name = 'ROW_COUNT'").collect()
    }
    # by hand: minute 2 comes when the watermark is at 12, minute 12 when it is at 14, 8 and 26 when it is at 30
    assert counted == {5: (2.0, 0), 10: (1.0, 0), 15: (3.0, 2), 25: (2.0, 2), 40: (1.0, 3), 45: (1.0, 3)}
    late = {int((r["start"] - START).total_seconds() // 60): r["rows"] for r in windows.late_rows(spark, marks).collect()}
    assert late == {0: 1, 5: 1, 25: 1}
    # every row with a time is in a window or late
    assert windows.counted_windows(spark, marks).agg(F.sum("rows")).first()[0] + sum(late.values()) == sum(m is not None for b in batches for m in b)


def test_windows_equal_a_batch_where_nothing_is_late(spark, tmp_path):
    source, results, marks = (f"{tmp_path}/{n}" for n in ("in", "out", "marks"))
    rows = events([m / 3 for m in range(200)] + [500])
    for number in range(3):
        run_windows(spark, source, results, marks, rows[number * 67 : (number + 1) * 67], number)
    plain = spark.createDataFrame(rows, "id long, ts timestamp, v string").groupBy(F.window("ts", "5 minutes").alias("w"))
    plain = plain.agg(F.count("*").alias("n"), F.count_if(F.col("v").isNull()).alias("missing")).where(F.col("w.end") <= F.lit(START + timedelta(minutes=490)))
    want = {(r["w"]["end"], m, float(v)) for r in plain.collect() for m, v in (("ROW_COUNT", r["n"]), ("NULL_COUNT", r["missing"]))}
    recorded = quality.read_results(spark, results).collect()
    assert {(r["measurement_time"], r["metric_name"], r["value"]) for r in recorded} == want and len(recorded) == len(want)
