"""The registered queries over a whole table: SQL, held-out rows, the pipeline."""

import pytest

import corpus_pipeline
from compare import duckdb_over, duckdb_result, spark_result
from encore.llm.oracle import ORACLE_SQL
from encore.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    types, rows = spark_result(QUERIES[name](spark, SF_DIR))
    sql_types, sql_rows = duckdb_result(duckdb_over(SF_DIR), ORACLE_SQL[name])
    assert types == sql_types and rows == sql_rows and rows


@pytest.mark.parametrize("name, label, least", [("op3_toxicity", "toxic", 0.95), ("op5_byte_cnn", "quality", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = [r for r in QUERIES[name](spark, SF_DIR).collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in rows) >= least * len(rows)


def test_pipeline_packs_what_the_stages_keep(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    good = {r.id for r in _sql(ORACLE_SQL["op10_quality_rules"]) if r.kept}
    pieces = corpus_pipeline.run(spark, SF_DIR).collect()
    packed = {p.doc_id for p in pieces}
    assert packed <= good and len(packed) > 0.8 * len(good)
    texts = {r.doc_id: "".join((r.text or "").split()) for r in docs.where(docs.doc_id.isin(*packed)).collect()}
    assert len(set(texts.values())) == len(packed)
    at = sorted((p.sequence_id * 2048 + p.offset, p.length) for p in pieces)
    end = 0
    for begin, length in at:
        assert begin == end
        end += length


def _sql(sql):
    from collections import namedtuple

    row = namedtuple("row", "id kept")
    found = duckdb_over(SF_DIR).execute(f"SELECT doc_id, kept FROM ({sql})").fetchall()
    return [row(*r) for r in found]
