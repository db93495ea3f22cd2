"""Identifier checks, metrics, bindings and history."""

from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairwright.functions import identifiers
from pairwright.operators import quality
from pairwright.streaming.monitor import monitor


def test_checksum_and_format(spark):
    cases = {
        "44051401359": (True, False),
        "44051401350": (False, False),
        "00000000000": (True, True),
        "44051401359\n": (False, True),
        "4405140135": (False, True),
        "٤٤٠٥١٤٠١٣٥٩": (False, True),
        "abc": (False, True),
        "": (False, True),
        None: (False, True),
    }
    df = spark.createDataFrame([(k,) for k in cases], "p string").coalesce(1)
    got = df.select(
        identifiers.is_valid_pesel(F.col("p")), identifiers.is_invalid_pesel_format(F.col("p"))
    ).collect()
    assert [tuple(r) for r in got] == list(cases.values())


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("0123456789", min_size=11, max_size=11), min_size=1, max_size=60))
def test_checksum_against_arithmetic(spark, values):
    def plain(v):
        total = sum(int(d) * w for d, w in zip(v, (1, 3, 7, 9, 1, 3, 7, 9, 1, 3)))
        return (10 - total % 10) % 10 == int(v[10])

    df = spark.createDataFrame([(v,) for v in values], "p string").coalesce(1)
    assert [r[0] for r in df.select(identifiers.is_valid_pesel(F.col("p"))).collect()] == [plain(v) for v in values]


def test_all_metrics_in_one_scan(spark, rows):
    df = spark.createDataFrame([("44051401359",), (None,), ("x",)], "p string")
    metrics = [(quality.INVALID_PESEL_COUNT, "p"), (quality.NULL_COUNT, "p"), (quality.ROW_COUNT, "p")]
    assert rows(quality.evaluate(df, metrics)) == [
        ("p", "INVALID_PESEL_COUNT", 2.0),
        ("p", "NULL_COUNT", 1.0),
        ("p", "ROW_COUNT", 3.0),
    ]
    assert rows(quality.audit_summary(df, "p")) == [(3, 1, 2)]


def test_recorded_batches_replace_themselves(spark, tmp_path, rows):
    folder = str(tmp_path / "results")
    df = spark.createDataFrame([("x",)], "p string")
    values = quality.evaluate(df, [(quality.INVALID_PESEL_COUNT, "p")])
    for batch, hour in ((0, 1), (1, 2), (1, 2)):
        stamped = quality.measurements(values, "web", datetime(2025, 1, 1, hour), batch)
        quality.record_metrics(stamped, folder, "web", "run", batch)
    results = quality.read_results(spark, folder)
    assert results.count() == 2
    assert quality.results_for(results, "other").count() == 0
    assert [r.batch_id for r in quality.results_for(results, "web").orderBy("batch_id").collect()] == [0, 1]


def test_tables_and_runs_do_not_overwrite_each_other(spark, tmp_path, rows):
    folder = str(tmp_path / "results")
    df = spark.createDataFrame([("x", None)], "p string, q string")
    values = quality.evaluate(df, [(quality.NULL_COUNT, "p"), (quality.NULL_COUNT, "q")])
    for hour, (table, run) in enumerate([("web", "a"), ("main", "a"), ("web/1", "a"), ("web", "b")]):
        stamped = quality.measurements(values, table, datetime(2025, 1, 1, hour), 0)
        quality.record_metrics(stamped, folder, table, run, 0)
    results = quality.read_results(spark, folder)
    assert results.count() == 8
    latest = quality.latest_metric(quality.results_for(results, "web"))
    assert rows(latest, "column_name", "metric_name", "value") == [("p", "NULL_COUNT", 0.0), ("q", "NULL_COUNT", 1.0)]


def test_a_new_checkpoint_keeps_earlier_results(spark, tmp_path, rows):
    source, results = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(3).write.parquet(source)
    for marks in ("one", "two"):
        stream = spark.readStream.schema("id long").parquet(source)
        monitor(stream, [(quality.ROW_COUNT, "id")], "t", results, str(tmp_path / marks), every=None).awaitTermination()
    assert rows(quality.read_results(spark, results), "batch_id", "value") == [(0, 3.0), (0, 3.0)]


def test_measuring_what_is_bound(spark, rows):
    tables = {
        "web": spark.createDataFrame([("x",), (None,)], "p string"),
        "main": spark.createDataFrame([(1, None)], "a int, b string"),
        "idle": spark.range(1),
    }
    bound = quality.bindings_df(spark)
    for table, column, metric in (("web", "p", "NULL_COUNT"), ("web", "p", "ROW_COUNT"), ("main", "b", "NULL_COUNT"), ("gone", "x", "NULL_COUNT")):
        bound = quality.attach(bound, table, column, metric)
    known = [quality.NULL_COUNT, quality.ROW_COUNT]
    measured = quality.measure(tables, bound, known, datetime(2025, 1, 1))
    assert rows(measured, *quality.SERIES, "value") == [
        ("main", "b", "NULL_COUNT", 1.0), ("web", "p", "NULL_COUNT", 1.0), ("web", "p", "ROW_COUNT", 2.0)]
    assert quality.measure(tables, quality.bindings_df(spark), known).count() == 0


def test_history_and_latest(spark, rows):
    results = spark.createDataFrame(
        [
            (datetime(2025, 1, 2), "t", "c", "A", 2.0, 1),
            (datetime(2025, 1, 1), "t", "c", "A", 1.0, 0),
            (datetime(2025, 1, 2), "t", "c", "A", 9.0, 2),
            (datetime(2025, 1, 1), "t", "c", "B", 5.0, 0),
        ],
        quality.RESULTS,
    )
    assert [r.value for r in quality.history(results, "A").collect()][0] == 1.0
    assert quality.history(results, newest_first=True).first().measurement_time == datetime(2025, 1, 2)
    assert rows(quality.latest_metric(results), "metric_name", "value") == [("A", 9.0), ("B", 5.0)]
    assert rows(quality.metric_names(results)) == [("A",), ("B",)]


def test_bindings(spark, rows):
    empty = quality.bindings_df(spark)
    one = quality.attach(empty, "web", "PESEL", "INVALID_PESEL_COUNT")
    twice = quality.attach(one, "web", "PESEL", "INVALID_PESEL_COUNT", "10 minutes")
    assert rows(twice) == [("web", "PESEL", "INVALID_PESEL_COUNT", "10 minutes")]
    daily = quality.set_schedule(twice, "web", "1440 minutes")
    assert rows(quality.bindings_for(daily, "web"), "schedule") == [("1440 minutes",)]
    attached = quality.attached_metrics(daily, "web", [quality.ROW_COUNT, quality.INVALID_PESEL_COUNT])
    assert attached == [(quality.INVALID_PESEL_COUNT, "PESEL")]
    assert rows(quality.detach(daily, "web", "PESEL", "INVALID_PESEL_COUNT")) == []


def test_metric_listing(spark, rows):
    listing = quality.metrics_df(spark, [quality.INVALID_PESEL_COUNT, quality.ROW_COUNT])
    assert rows(quality.outside_core(listing), "metric_name") == [("INVALID_PESEL_COUNT",)]
    assert rows(quality.matching_names(listing, "metric_name", "ROW%"), "metric_name") == [("ROW_COUNT",)]
