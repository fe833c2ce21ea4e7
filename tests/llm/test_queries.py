"""Registered queries: names, SQL where there is some, and one row per row of the table."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from tariffa.llm import queries

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_language_id": "doc_id held_out lang_pred score",
    "op2_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op3_mixing": "doc_id size source_size target taken",
    "op4_lm_scoring": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op5_sentencepiece": "doc_id n_tokens token_ids round_trip parity",
    "op6_license_scan": "doc_id text_digest license_id",
    "op7_toxicity": "doc_id held_out score predicted",
    "op8_topk": "query_id rank vec_id score",
    "op9_simhash": "doc_id fingerprint component_id",
    "op11_vector_codes": "vec_id code error label_error codebooks_sha256",
    "op12_merkle": "doc_id leaf subroot root proof_sha256 folded_root verified",
    "op13_quality": "doc_id held_out score predicted",
    "op10_warc": "page_id payload_bytes payload_digest record_type refers_to",
}


def test_all_are_registered():
    assert set(queries.queries()) == set(COLUMNS)
    assert {*COLUMNS, "pipeline"} <= set(contract.queries())
    assert set(queries.oracle_sql()) <= set(contract.oracle_sql())


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in ("documents", "pages", "embeddings"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", COLUMNS)
def test_query(spark, con, name):
    df = queries.queries()[name](spark, FOLDER)
    assert df.columns == COLUMNS[name].split()
    rows = df.collect()
    if name in queries.oracle_sql():
        found = con.execute(queries.oracle_sql()[name])
        order = [[c[0] for c in found.description].index(c) for c in df.columns]
        assert sorted(map(str, map(tuple, rows))) == sorted(str(tuple(r[i] for i in order)) for r in found.fetchall())
    if name not in ("op8_topk", "op11_vector_codes"):
        table = "pages" if name == "op10_warc" else "documents"
        assert len(rows) == con.execute(f"SELECT count(*) FROM {table}").fetchone()[0]
