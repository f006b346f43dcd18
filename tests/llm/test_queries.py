"""The registered queries: SQL twins where there are any, and the pipeline stage by stage."""

import pathlib

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from textmill.llm import decontaminate, mixing, pii
from textmill.llm.oracles import ORACLES
from textmill.llm.queries import QUERIES
from tools.compare_oracles import rows

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).exists(), reason="no test tables")
NO_TWIN = {"op3_lm_scoring", "op8_suffix_array", "op9_pii", "op10_quality_classifier"}


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) - set(ORACLES) == NO_TWIN


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_twin(spark, name):
    db = duckdb.connect()
    for path in pathlib.Path(SF_DIR).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    got, want = QUERIES[name](spark, SF_DIR).toPandas(), db.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(NO_TWIN))
def test_query_has_a_row_per_document(spark, name):
    got = QUERIES[name](spark, SF_DIR)
    assert got.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, seen = docs.columns, []
    texts = {r.doc_id: r.text for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        assert out.columns[: len(columns)] == columns and (k == 4 or out.columns == columns)
        docs = spark.createDataFrame(out.collect(), out.schema)
        seen.append({r.doc_id: r for r in docs.collect()})
    rated = {r.doc_id: r.kept for r in QUERIES["op1_quality_rules"](spark, SF_DIR).collect()}
    assert set(seen[0]) == {i for i, kept in rated.items() if kept}
    assert set(seen[1]) <= set(seen[0]) and set(seen[4]) <= set(seen[3])
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    third = spark.createDataFrame([(i, r.text) for i, r in seen[2].items()], "doc_id long, text string")
    assert not decontaminate.find(third, benchmark).filter("contaminated").count()
    assert all(not pii.base_spans(r.text) for r in seen[3].values())
    clean = [i for i, r in seen[3].items() if r.text == texts[i]]
    assert len(clean) > len(seen[3]) / 2
    total = sum(len(r.text.split()) for r in seen[3].values())
    mixed = docs.select(F.sum(F.size(F.split(F.trim("text"), r"\s+")))).first()[0]
    assert 0.7 * total < mixed < 1.3 * total
    assert mixing.MAX_COPIES >= docs.agg(F.max("copy")).first()[0]


def test_pipeline_runs_whole(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
