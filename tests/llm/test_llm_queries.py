import duckdb
import pytest

import __spark_entry__ as spark_entry
import corpus_pipeline
from pairwright.llm import catalog
from pairwright.llm.frames import landed

SMALL = "/root/testdata/sf0.001"


def test_every_operators_query_is_registered():
    names = spark_entry.queries()
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_sql_twins_agree(spark, name):
    database = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        database.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    want = database.sql(catalog.ORACLES[name]).df()
    columns = sorted(want.columns)
    got = catalog.QUERIES[name](spark, SMALL).toPandas()
    assert sorted(got.columns) == columns
    plain = lambda d: d[columns].astype(str).sort_values(columns).reset_index(drop=True)
    assert plain(got).equals(plain(want))


def test_stages_keep_the_columns_and_drop_what_they_should(spark, documents, edge_rows, tmp_path):
    labels = [(4, 1, 0), (6, 1, 1), (10, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = documents(rows=edge_rows)
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        kept = landed(stage(spark, docs, str(tmp_path)), "stage")
        assert kept.columns == docs.columns, name
        docs = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert packed.count() >= docs.count() > 0
    toxic = corpus_pipeline.drop_toxic(spark, documents(rows=edge_rows), str(tmp_path))
    assert toxic.columns == docs.columns


def test_pipeline_runs_over_a_whole_table(spark):
    got = corpus_pipeline.run(spark, SMALL)
    totals = got.groupBy("sequence_id").sum("length").toPandas()["sum(length)"]
    assert len(totals) and totals.max() <= 2048


def test_empty_documents_pass_through_the_pipeline(spark, documents, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    documents().write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
