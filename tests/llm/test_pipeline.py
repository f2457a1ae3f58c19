"""The registered queries and the pipeline on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from lodestar.llm import jaccard_join, quality_rules, toxicity
from lodestar.llm.catalog import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_returns_a_row_for_each_input_row(spark, name):
    rows = QUERIES[name](spark, SMALL).collect()
    n = spark.read.parquet(f"{SMALL}/{'pages' if name.startswith(('op4_', 'op9_')) else 'documents'}.parquet").count()
    if name.startswith("op11_"):   # a row for each piece: together they hold every document
        assert len({r["doc_id"] for r in rows}) == n
    else:
        assert len(rows) == n or name.startswith("op10_") and rows


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, SMALL)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())


def test_pipeline_agrees_with_its_operators(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        ids = {r["doc_id"] for r in docs.collect()}
        if name == "toxicity":
            model = toxicity.fit(before, spark.read.parquet(f"{SMALL}/labels.parquet"))
            assert ids == {r["doc_id"] for r in toxicity.score(before, model).collect() if not r["predicted"]}
        if name == "quality_rules":
            assert ids == {r["doc_id"] for r in quality_rules.quality_rules(before).collect() if r["kept"]}
        if name == "jaccard_join":
            assert ids == {r["component_id"] for r in jaccard_join.similar_documents(before).collect()}
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == DOCUMENTS
        seen.append(ids)
    assert all(b <= a for a, b in zip(seen, seen[1:])) and seen[-1]
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SMALL).collect()} == seen[-1]
