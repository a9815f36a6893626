"""Registered corpus queries against SQL, and their schemas on whole small tables."""

import os

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from loglake.llm.queries import ORACLE_SQL, QUERIES

COLUMNS = {
    "op1_line_dedup": "doc_id n_gone text",
    "op2_minhash_near_dedup": "component_id doc_id kept n_shingles",
    "op3_best_fit_packing": "doc_id ids_crc32 length offset piece sequence_id start",
    "op4_benchmark_decontamination": "contaminated doc_id items_sha256 n_hit n_items n_words",
    "op5_license_scan": "coverage differences doc_id end license saved start template",
    "op6_html_extraction": "n_chars page_id text url",
    "op7_toxicity": "doc_id held_out predicted score",
    "op8_url_filter": "host page_id path rule verdict",
    "op9_secret_scan": "base_sha256 doc_id n_access n_assign n_hex spans",
    "op11_collocations": "a l lang n phrase r rank score",
    "op12_periodic_runs": "collapsed_sha256 doc_id exponent_milli length n_runs period runs_sha256 start",
    "op13_byte_bpe": "decoded_sha256 doc_id ids_sha256 n_tokens",
    "op10_document_fingerprints": "doc_id edited_fingerprint edited_sha256 fingerprint n_chars near_edited near_next",
}


@pytest.fixture
def duck(sf_dir):
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
    return connection


def rows_of(frame: pd.DataFrame) -> list:
    columns = sorted(frame.columns)
    values = frame[columns].astype(object).where(frame[columns].notna(), None).values.tolist()
    whole = lambda x: int(x) if isinstance(x, float) and x.is_integer() else x  # noqa: E731  columns with nulls
    return sorted(tuple(str(whole(x)) for x in r) for r in values)


def test_all_are_registered():
    assert set(QUERIES) == set(COLUMNS)


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, duck, name):
    result = QUERIES[name](spark, sf_dir)
    assert " ".join(sorted(result.columns)) == COLUMNS[name]
    assert rows_of(result.toPandas()) == rows_of(duck.execute(ORACLE_SQL[name]).fetch_df())


@pytest.mark.parametrize("name", ["op5_license_scan", "op7_toxicity", "op9_secret_scan"])
def test_query_has_its_columns(spark, sf_dir, name):
    assert " ".join(sorted(QUERIES[name](spark, sf_dir).columns)) == COLUMNS[name]


@pytest.mark.parametrize("name", ["op8_url_filter", "op9_secret_scan", "op10_document_fingerprints"])
def test_native_queries_run_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Pandas", "Arrow", "CartesianProduct"):
        assert node not in plan


def test_pipeline_stages_keep_the_columns_and_act(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before, folder = docs.columns, spark.conf.get("spark.checkpoint.dir")
    sizes = [docs.count()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = f"{folder}/stage-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
        sizes.append(docs.count())
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == before
            assert docs.where("length(text) <> n_chars").count() == 0
    assert sizes[0] > sizes[1] >= sizes[2] > sizes[3] >= sizes[4] > 0
    assert docs.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 1024").count() == 0


@pytest.mark.parametrize("which", range(len(corpus_pipeline.STAGES)))
def test_stages_take_odd_and_empty_tables(spark, sf_dir, odd_docs, no_docs, which):
    _, stage = corpus_pipeline.STAGES[which]
    assert stage(spark, no_docs, sf_dir).count() == 0
    kept = stage(spark, odd_docs, sf_dir)
    assert kept.count() > 0
