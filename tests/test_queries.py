"""A sample of the registered queries against their SQL (check.py runs them all)."""

import pytest

import __spark_entry__ as entry
from check import compare, connect
from rankspark.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"
SAMPLE = (
    "tokenize", "token_positions", "postings", "doc_length", "field_stats", "index_create",
    "index_upsert", "index_compact", "partial_merge",
    "best_terms_text", "similar_docs_tf", "similar_terms_tfxidf", "search_tfidf", "search_dir",
    "run_listing", "recall_at_n", "feedback_residual", "tune_dir", "paired_t_test",
    "wilcoxon_normal", "record_scan", "qrels_scan",
)


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, db, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert compare(got, db.execute(entry.oracle_sql()[name]).df()).startswith("ok")


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(REGISTRY) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["topic_id", "P"] and df.count() == 40
