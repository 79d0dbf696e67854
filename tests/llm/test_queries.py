"""Registered queries on the smallest tables: DuckDB where SQL can say it, and the pipeline."""

import pytest

import corpus_pipeline
from lodgeflow.llm import registry
from lodgeflow.llm.common import table
from tests.llm.fixtures import awkward, nothing
from tests.oracle_compare import canon, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(registry.oracle_sql()))
def test_matches_duckdb(spark, key):
    df = registry.queries()[key](spark, SF)
    cur = duck(SF).execute(registry.oracle_sql()[key])
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon([d[0] for d in cur.description], cur.fetchall())


def test_thirteen_queries_and_five_stages():
    assert sorted(int(k[2:].split("_")[0]) for k in registry.queries()) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "near_dedup", "mix_sources", "pack_sequences"]


def test_pipeline_is_its_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        if name != "pack_sequences":
            assert docs.columns == columns
            ids = lambda d: {r[0] for r in d.select("doc_id").collect()}
            assert ids(docs) <= ids(before)
    whole = corpus_pipeline.run(spark, SF)
    assert whole.columns == docs.columns
    assert whole.agg({"length": "sum"}).first() == docs.agg({"length": "sum"}).first()


def test_stages_stand_awkward_and_empty_documents(spark):
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, nothing(spark), SF).count() == 0, name
        assert stage(spark, awkward(spark, extra=False), SF).count() > 0, name
