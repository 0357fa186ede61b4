"""Registered queries against their SQL and the pipeline against its stages, on the smallest supplied tables."""

import duckdb
import pytest

import corpus_pipeline
from fleetspark.llm import queries
from tools.check_oracle import TABLES, canon


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_oracle(spark, sf_small, con, name):
    df = queries.queries()[name](spark, sf_small)
    rel = con.sql(queries.oracle_sql()[name])
    order = sorted(df.columns)
    assert order == sorted(rel.columns)
    at = [rel.columns.index(c) for c in order]
    assert canon([tuple(r[c] for c in order) for r in df.collect()]) == canon([tuple(r[k] for k in at) for r in rel.fetchall()])


def test_pipeline_stages_take_effect(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    ids = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_small)
        assert out.columns == list(corpus_pipeline.COLUMNS), name
        kept = {r.doc_id for r in out.collect()}
        assert kept <= ids
        ids, docs = kept, out
    packed = corpus_pipeline.packing_stage(spark, docs, sf_small)
    assert {r.doc_id for r in packed.collect()} == ids == {r.doc_id for r in corpus_pipeline.run(spark, sf_small).collect()}
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_small).count() == 0


def test_pipeline_keeps_clean_documents_without_an_id(spark, sf_small):
    """NULL ids, sources and langs, NULL and empty texts: what the rules allow goes through all filtering stages."""
    words = [f"clean{i}" for i in range(120)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept_id string"
    rows = [(None, " ".join(words), None, None, None, "x"), (None, " ".join(reversed(words)), "en", "a", 1, None), (7, " ".join(f"own{w}" for w in words), None, None, 0, "x"),
            (8, " ".join(f"own{w}" for w in words), None, None, 0, "x"), (1, None, "en", "a", 0, "x"), (2, "", "en", "a", 0, "x")]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_small)
    assert sorted(docs.select("doc_id", "text").collect(), key=repr) == sorted([(None, rows[0][1]), (None, rows[1][1]), (7, rows[2][1])], key=repr)
    packed = corpus_pipeline.packing_stage(spark, docs, sf_small)
    assert packed.count() == 3
