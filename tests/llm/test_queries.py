"""The registered text queries against their SQL, and the pipeline against its stages' rules."""

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from linetally.llm.queries import ORACLES, QUERIES
from tools.compare import compare

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def test_all_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert {*QUERIES, "pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    ok, note = compare(spark, con, name, SF)
    assert ok, note


@pytest.mark.parametrize("name", ["op2_crf_language", "op8_pu_quality"])
def test_held_out_rows(spark, name):
    """Right on rows that nothing was learned from."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = QUERIES[name](spark, SF).where("held_out")
    if name.startswith("op2"):
        rows = got.join(docs, "doc_id").where("lang is not null").collect()
        right = [r["lang"] == r["lang_pred"] for r in rows]
    else:
        right = [r["quality"] == r["predicted"] for r in got.join(labels, "doc_id").collect()]
    assert len(right) > 10 and sum(right) / len(right) > 0.9


def test_pipeline(spark):
    from tests.llm.test_jaccard_join import brute_force

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == columns
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    quality, exact, near, clean = kept
    poor = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()
    all_docs = {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    good = {r["doc_id"] for r in poor} & all_docs
    assert len(good & set(quality)) / len(good) > 0.97 and len(quality) < len(all_docs)
    texts = {}
    for i, t in quality.items():
        texts[t] = max(i, texts.get(t, i))
    assert set(exact) == set(texts.values())
    assert set(near) == {i for i, _, c in brute_force(list(exact.items())) if i == c}
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    holds = {i for i, t in near.items() if any(b in t for b in bench)}
    assert not holds & set(clean) and len(near) - len(clean) <= len(holds) + 2
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in pieces} == set(clean)
