"""The registered queries of the package at the smallest scale, against SQL or a plain version."""

import duckdb
import pytest
from brute import similar_components
from harness import compare, duck

import corpus_pipeline
from salescope.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, name):
    assert compare(QUERIES[name](spark, sf), duck(sf), SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_a_row_for_each_input_row(spark, sf, name):
    table = {"op1_url_rules": "pages", "op6_role_repair": "conversations"}.get(name, "documents")
    assert QUERIES[name](spark, sf).count() == spark.read.parquet(f"{sf}/{table}.parquet").count()


def test_near_duplicates_match_all_pairs(spark, sf):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op7_count_rtree"](spark, sf).collect()}
    assert got == similar_components(rows)


def test_pipeline_keeps_columns_and_only_drops(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ids, columns = {r.doc_id for r in docs.select("doc_id").collect()}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        now = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(now) == len(set(now)) and set(now) <= ids, name
        ids = set(now)
        assert docs.columns == columns + (["block", "slot", "place"] if name == "mixing" else [])
    assert len(ids) > 100
