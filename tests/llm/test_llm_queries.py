"""Registered queries: their SQL, their columns, and what they read."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import DATA
from viaduct.llm.oracles import ORACLES
from viaduct.llm.queries import QUERIES

TABLES = "documents pages labels benchmark conversations embeddings".split()
COLUMNS = {
    "op1_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op2_personal_data": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    "op3_token_counts": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
    "op4_url_filter": {"page_id", "host", "path", "rule", "verdict"},
    "op5_quality_rules": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                          "base_failed", "kept"},
    "op6_html_text": {"page_id", "url", "text", "n_chars"},
    "op7_exact_dedup": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    "op8_near_dedup": {"doc_id", "n_shingles", "component_id", "kept"},
    "op9_sentencepiece": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op10_source_mixing": {"doc_id", "size", "source_size", "target", "taken"},
    "op11_spelling_variants": {"word", "form", "root", "n", "n_near", "form_n"},
    "op12_embedding_dedup": {"vec_id", "n_links", "component_id", "kept"},
    "op13_vector_codes": {"vec_id", "code", "error", "label_error", "codebooks_sha256"},
}


def test_one_query_for_each_operator():
    assert set(QUERIES) == set(COLUMNS)
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_what_its_sql_gives(spark, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    expected = connection.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    found = QUERIES[name](spark, DATA)
    assert COLUMNS[name] <= set(found.columns) and sorted(found.columns) == sorted(columns)
    assert (sorted((tuple(r) for r in found.select(*columns).collect()), key=repr)
            == sorted(expected.fetchall(), key=repr))


@pytest.mark.parametrize("name", ["op2_personal_data", "op3_token_counts", "op6_html_text", "op9_sentencepiece"])
def test_row_for_every_row(spark, name):
    found = QUERIES[name](spark, DATA)
    assert COLUMNS[name] <= set(found.columns)
    source = "pages" if name == "op6_html_text" else "documents"
    assert found.count() == spark.read.parquet(os.path.join(DATA, f"{source}.parquet")).count()
