"""Every catalog query against its SQL twin, the entry point, streaming, plans."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
from pairwright.operators import quality
from pairwright.plans import catalog, oracles, stand_ins
from pairwright.streaming.monitor import monitor

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the shared test tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def in_order(columns, rows):
    picked = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(r[i]) for i in picked) for r in rows)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) & set(oracles.ORACLES)))
def test_query_equals_its_sql_twin(spark, sql, name):
    frame = spark_entry.queries()[name](spark, FOLDER)
    found = sql.execute(spark_entry.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert sorted(frame.columns) == sorted(columns)
    expected = found.fetchall()
    assert in_order(frame.columns, frame.collect()) == in_order(columns, expected)
    assert expected or name == "score_minimum"


def test_duplicate_records_are_all_pairs_behind_the_links(spark):
    """As many as the links count, pairs of different brands among them."""
    frame = catalog.duplicate_records(spark, FOLDER)
    assert frame.where("lname1 <> lname2").count() > 0
    assert frame.count() == catalog.duplicate_links(spark, FOLDER).agg({"pairs": "sum"}).first()[0]


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 100


def test_stream_equals_batch_and_replays_safely(spark, tmp_path, rows):
    source, results, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    data = stand_ins.customer_identifiers(spark, FOLDER)
    metrics = [(quality.INVALID_PESEL_COUNT, "pesel"), (quality.ROW_COUNT, "c_custkey")]
    seen = None
    for part in range(2):
        piece = data.where(f"c_custkey % 2 = {part}")
        piece.write.mode("append").parquet(source)
        seen = piece if seen is None else seen.union(piece)
        stream = spark.readStream.schema(data.schema).parquet(source)
        monitor(stream, metrics, "customer", results, marks, every=None).awaitTermination()
        recorded = quality.read_results(spark, results)
        assert recorded.count() == 2 * (part + 1)
        latest = quality.latest_metric(recorded)
        assert rows(latest, "metric_name", "value") == rows(quality.evaluate(seen, metrics), "metric_name", "value")


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_plans_prune_and_push_down(spark):
    text = plan(catalog.pair_estimate(spark, FOLDER))
    assert "ReadSchema: struct<p_name:string>" in text and "CartesianProduct" not in text
    assert "PushedFilters: [IsNotNull(p_name)" in plan(catalog.duplicate_links(spark, FOLDER))
    narrow = plan(catalog.dictionary_tokens_embedded(spark, FOLDER))
    assert "Exchange" not in narrow and "BatchEvalPython" not in narrow


@pytest.mark.parametrize("name", ["candidate_pairs", "duplicate_links", "duplicate_listing", "pair_scores"])
def test_matching_never_loops_over_all_pairs(spark, name):
    text = plan(catalog.QUERIES[name](spark, FOLDER))
    assert "NestedLoop" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize("name", ["duplicate_links", "pair_scores"])
def test_profiles_are_made_once(spark, name):
    """Both sides of a pair and the block sizes come from one scan and shuffle."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(catalog.QUERIES[name](spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert text.count("FileScan") == 1 and "ReusedExchange" in text


def test_listing_of_both_files_holds_pairs_that_score(spark):
    """Ids are hashes, which SQL does not know; every listed pair is of one first name and comes twice."""
    listed = catalog.customer_file_listing(spark, FOLDER).collect()
    by_key = {}
    for row in listed:
        by_key.setdefault(row["pair_key"], []).append(row)
    assert len(listed) == 100 and all(len({r["IMIE"] for r in rows}) == 1 for rows in by_key.values())
    assert all(len(rows) == 2 for rows in by_key.values())


def test_neighbours_are_dealt_to_many_tasks(spark, tmp_path):
    """Few bytes, much work: adaptive coalescing would leave them to one task."""
    from pairwright.session import shuffle_partitions

    rows = spark.range(500).selectExpr("id AS p_partkey", "'small ring' AS p_name", "concat('B', id % 7) AS p_brand")
    rows.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    pairs = stand_ins.neighbour_pairs(spark, str(tmp_path))
    assert pairs.rdd.getNumPartitions() >= shuffle_partitions(spark) and pairs.count() == 499


def test_scores_are_rounded_once_a_link(spark):
    """Rounding every record pair took five times longer than spelling the pairs out."""
    text = plan(catalog.duplicate_records(spark, FOLDER))
    spelled = text.index("explode(_ids2")
    assert "round(" not in text[:spelled] and "round(" in text[spelled:]
