"""The registered corpus queries and the pipeline over the smallest tables."""

import os

import pytest

import corpus_pipeline
from freshet.llm.queries import QUERIES, SQL

from . import brute

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    import duckdb

    from tools.check import TABLES, compare

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    problem, count = compare(QUERIES[name](spark, DATA), SQL[name], con)
    assert problem is None and count > 0


def test_jaccard_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op10_jaccard_join"](spark, DATA).select("doc_id", "n_shingles", "component_id").collect()), key=str)
    assert got == brute.jaccard_components(rows)


def test_pii_query(spark):
    import hashlib

    rows = {r[0]: r[1] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}
    for r in QUERIES["op6_pii"](spark, DATA).collect():
        assert r["base_sha256"] == hashlib.sha256(brute.base_spans(rows[r["doc_id"]]).encode()).hexdigest()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op2_language_id"](spark, DATA).where("held_out").join(docs, "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.95 * len(found)
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "quality")
    scored = QUERIES["op3_quality_classifier"](spark, DATA).where("held_out").join(labels, "doc_id").collect()
    assert sum(r["quality"] == r["predicted"] for r in scored) >= 0.85 * len(scored)


def test_round_trip(spark):
    assert QUERIES["op5_sentencepiece"](spark, DATA).where("NOT round_trip").isEmpty()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    ids = {r[0] for r in docs.select("doc_id").collect()}
    out = corpus_pipeline.run(spark, DATA)
    rows = out.collect()
    assert {r["doc_id"] for r in rows} < ids and set(docs.columns) < set(out.columns)
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    assert not brute.contained([(r["doc_id"], r["text"]) for r in rows], items)
    assert all(d == c for d, _, c in brute.jaccard_components([(r["doc_id"], r["text"]) for r in rows]))
    assert all(len(r["token_ids"]) == r["n_tokens"] > 0 for r in rows)
