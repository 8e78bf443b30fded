"""Registered queries: columns of the contracts, SQL oracles, and no Python in the native ones."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerline.llm.queries import ORACLES, QUERIES
from ledgerline.session import TABLES

sys.path.insert(0, os.path.join(os.path.dirname(entry.__file__), "scripts"))
from oracle_check import rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
NATIVE = {"op1", "op5", "op7", "op8", "op9"}
COLUMNS = {
    "op2": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    "op3": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op4": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op5": {"page_id", "host", "path", "rule", "verdict"},
    "op6": {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
    "op7": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    "op8": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op10": {"doc_id", "fingerprint", "component_id"},
    "op11": {"word", "form", "root", "n", "n_near", "form_n"},
    "op12": {"doc_id", "n_shingles", "component_id"},
    "op13": {"vec_id", "code", "error", "label_error", "codebooks_sha256"},
}


def test_one_query_per_operator():
    numbers = [n.split("_")[0] for n in QUERIES]
    assert sorted(numbers, key=lambda n: int(n[2:])) == [f"op{k}" for k in range(1, 14)]
    assert set(QUERIES) < set(entry.queries()) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    number = name.split("_")[0]
    assert COLUMNS.get(number, set()) <= set(df.columns)
    assert not any(dict(df.dtypes)[c] == "int" for c in df.columns)      # counts are long
    plan = df._jdf.queryExecution().executedPlan().toString()
    if number in NATIVE:
        assert not any(w in plan for w in ("Python", "Pandas", "MapInArrow", "ArrowEval"))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
    rows = [tuple(r) for r in df.collect()]
    source = {"op5": "pages", "op9": None, "op11": None, "op13": "embeddings"}.get(number, "documents")
    if source:
        assert len(rows) == spark.read.parquet(f"{SF}/{source}.parquet").count()
    if name in ORACLES:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
        rel = con.sql(ORACLES[name])
        assert sorted(df.columns) == sorted(rel.columns)
        assert rows_of(df.columns, rows) == rows_of(rel.columns, rel.fetchall())
