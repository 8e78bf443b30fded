"""Every registered query: runs on sf0.001, matches its SQL oracle on DuckDB,
and plans without Python UDFs, Cartesian products or nested-loop joins."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import rows_of  # noqa: E402

from ledgerline.catalog import ORACLES, QUERIES, load_all  # noqa: E402
from ledgerline.session import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
load_all()
BAD_NODES = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")

_SPARK_FAMILY = [("bigint", "int64"), ("int", "int32"), ("double", "float64"), ("float", "float32"),
                 ("string", "string"), ("boolean", "bool"), ("timestamp", "timestamp"), ("date", "date")]
_DUCK_FAMILY = {"BIGINT": "int64", "INTEGER": "int32", "DOUBLE": "float64", "FLOAT": "float32",
                "VARCHAR": "string", "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "timestamp"}


def spark_family(t):
    s = t.simpleString()
    if s.startswith("decimal"):
        return s
    return next((v for k, v in _SPARK_FAMILY if s.startswith(k)), s)


def duck_family(t):
    s = str(t)
    return s.lower().replace(" ", "") if s.startswith("DECIMAL") else _DUCK_FAMILY.get(s, s)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    first = df.schema
    assert df.count() > 0
    assert entry.entry(spark).schema == first


def test_every_query_has_an_oracle_or_is_listed():
    missing = sorted(set(QUERIES) - set(ORACLES))
    assert missing == [], f"queries without oracle: {missing}"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in BAD_NODES:
        assert node not in plan, f"{name}: {node} in plan"
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        return
    rel = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert {f.name: spark_family(f.dataType) for f in df.schema.fields} == \
        {c: duck_family(t) for c, t in zip(rel.columns, rel.types)}
    assert rows_of(df.columns, rows) == rows_of(rel.columns, rel.fetchall())
