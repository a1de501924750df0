"""Every registered query against its SQL, and the contract's columns."""

import duckdb
import pytest

from tillflow.llm import queries

DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")
COLUMNS = {
    "op1": {"doc_id", "expected_grade", "kept"},
    "op2": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op3": {"doc_id", "n_shingles", "component_id", "kept"},
    "op4": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op5": {"query_id", "rank", "vec_id", "score"},
    "op6": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op7": {"doc_id", "held_out", "score", "predicted"},
    "op8": {"doc_id", "size", "source_size", "target", "taken"},
    "op9": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op10": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op11": {"doc_id", "fingerprint", "component_id"},
    "op12": {"vec_id", "code", "error", "label_error", "codebooks_sha256"},
    "op13": {"part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"},
}


def test_one_query_each():
    assert sorted(q.split("_")[0] for q in queries.QUERIES) == sorted(COLUMNS)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_columns_and_rows(spark, name):
    df = queries.QUERIES[name](spark, DIR)
    assert COLUMNS[name.split("_")[0]] <= set(df.columns)
    rows = [tuple(r) for r in df.select(sorted(df.columns)).collect()]
    if name not in queries.ORACLE:
        table = "pages" if name.startswith("op10") else "documents"
        assert len(rows) == spark.read.parquet(f"{DIR}/{table}.parquet").count()
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    cols = ", ".join(sorted(df.columns))
    want = con.execute(f"SELECT {cols} FROM ({queries.ORACLE[name]})").fetchall()
    assert sorted(rows, key=str) == sorted(want, key=str)
