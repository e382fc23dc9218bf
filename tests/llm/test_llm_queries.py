"""Registered queries: contract, columns, and SQL where there is some."""

import duckdb
import pytest

import __spark_entry__ as entry
from murmur.llm import workload

COLUMNS = {
    "op1_neighbours": ["query_id", "rank", "vec_id", "score"],
    "op2_chat_formatting": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op3_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op4_products": ["query_id", "rank", "vec_id", "score"],
    "op5_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op6_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op7_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op8_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op9_simhash": ["doc_id", "fingerprint", "component_id"],
    "op10_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op11_sentencepiece": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op12_collocations": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
    "op13_spelling": ["word", "form", "root", "n", "n_near", "form_n"],
}


def test_all_are_registered(spark):
    assert set(COLUMNS) | {"pipeline"} <= set(entry.queries())
    assert set(workload.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns_and_rows(spark, sf_dir, name):
    found = workload.QUERIES[name](spark, sf_dir)
    assert set(COLUMNS[name]) <= set(found.columns)
    rows = found.collect()
    assert rows
    if "doc_id" in COLUMNS[name] and name != "op3_packing":
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())


@pytest.mark.parametrize("name", list(workload.ORACLE))
def test_sql_agrees(spark, sf_dir, name):
    db = duckdb.connect()
    for t in ("conversations", "documents", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = db.execute(workload.ORACLE[name])
    columns = [d[0] for d in want.description]
    got = workload.QUERIES[name](spark, sf_dir).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
