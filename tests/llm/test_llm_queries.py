"""The registered corpus queries: their columns, and their SQL where there is some."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from barloom.llm.oracle import ORACLE
from barloom.llm.queries import QUERIES
from compare import compare, connect

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_quality_rules": {
        "doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint",
        "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean",
        "kept": "boolean"},
    "op2_quality_classifier": {
        "doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op3_toxicity": {
        "doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op4_language_id": {
        "doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op5_exact_dedup": {
        "doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean",
        "text_sha256": "string"},
    "op6_chat_format": {"conv_id": "bigint", "position": "bigint", "piece": "string"},
    "op7_length_packing": {"doc_id": "bigint", "bucket": "bigint", "batch": "bigint"},
    "op8_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op9_entropy_mixing": {
        "doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double",
        "taken": "bigint"},
    "op10_token_scan": {"doc_id": "bigint", "n_tokens": "bigint"},
    "op11_centroids": {
        "vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint",
        "inertia": "bigint", "centroid_sha256": "string"},
    "op12_filter_audit": {
        "part": "string", "filter_order": "string", "step": "int", "kept": "bigint",
        "removed": "bigint", "redundant": "bigint", "unique_fails": "bigint", "good_lost": "bigint",
        "toxic_lost": "bigint", "shapley": "bigint"},
    "op13_byte_bpe": {
        "doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
}


def test_all_are_registered():
    assert list(QUERIES) == list(COLUMNS)
    assert {*QUERIES, "pipeline"} <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql()) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, name):
    result = QUERIES[name](spark, SF)
    types = dict(result.dtypes)
    assert COLUMNS[name].items() <= types.items()
    if name in ORACLE:
        assert compare(result, connect(SF), ORACLE[name]) == []
    if name.startswith("op12"):
        return
    source = {"op6": "conversations", "op11": "embeddings"}.get(name.split("_")[0], "documents")
    rows = spark.read.parquet(f"{SF}/{source}.parquet").count()
    n = result.count()
    assert n >= rows if name.startswith("op7") else n == rows
