"""The registered operator queries: SQL where there is some, whole tables everywhere."""

import pytest

import __spark_entry__ as entry
from check import compare, connect

SF = "/root/testdata/sf0.001"
WITH_SQL = (
    "op5_block_nearest",
    "op7_warc_dictionary",
    "op9_jaccard_join",
    "op12_threshold_centroids",
    "op13_filter_audit",
)
COLUMNS = {
    "op1_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op2_language_filters": "doc_id held_out lang_pred score",
    "op3_toxic_lexicon": "doc_id held_out score predicted n_hits n_quoted",
    "op4_greedy_token_counts": "doc_id n_words n_tokens",
    "op6_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op11_token_store": "doc_id start n_tokens ids_crc32",
}


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_sql(spark, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert compare(got, connect(SF).execute(entry.oracle_sql()[name]).df()).startswith("ok")


@pytest.mark.parametrize("name", COLUMNS)
def test_query_covers_all_documents(spark, name):
    got = entry.queries()[name](spark, SF).toPandas()
    every = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert list(got.columns) == COLUMNS[name].split() and set(got.doc_id) == every


def test_one_query_for_each_operator():
    numbers = [name.split("_")[0] for name in entry.queries() if name.startswith("op")]
    assert sorted(numbers) == sorted(f"op{n}" for n in range(1, 14)) and "pipeline" in entry.queries()
