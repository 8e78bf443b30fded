"""Stable ids and fingerprints: known answers and the properties the ids must have.

The known answers are SHA-256 sums of the joined texts named beside them, taken
with a command-line tool.
"""

import hashlib
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions import keys as K

ACME_12 = "77c0eec9-f9a3-d5c2-ae60-9827db7b7a40"        # 12,acme
BCA = "243005be-5136-de0b-f7b2-5cca1a272b63"            # b,c,a
OBRIEN = "e4e6cb04-0c1e-581e-f6c0-69e18ab39e2f"         # 7,ünïcode,o'brien
ACME = "822b33ad-87c1-48a0-a20a-5ba7cd5ebcaa"           # acme
AMOUNT_X = "c73e75c7-3b60-46e9-5b5b-93455174454e"       # 12.500000,x
AMOUNT_Y = "28862e40-f39d-95d6-e551-b58be5f25019"       # 0.123457,y
ONLY_Z = "594e519a-e499-312b-2943-3b7dd8a97ff0"         # z


def ids_of(spark, rows, schema, columns, **options):
    df = spark.createDataFrame(rows, schema)
    return [r.u for r in df.select(K.stable_uuid(columns, **options).alias("u")).collect()]


def test_known_ids(spark):
    rows = [("Acme ", " 12", None), ("\tACME\n", "12", ""), ("\u00a0Acme\u3000", "\x1c12\x85", None),
            ("O'Brien", "7", "Ünïcode"), ("a", "b", "c"), ("nan", "NULL", " none "), ("NaT", None, ""), (None, None, None)]
    got = ids_of(spark, rows, "name string, code string, extra string", ["name", "code", "extra"])
    assert got == [ACME_12, ACME_12, ACME_12, OBRIEN, BCA, None, None, None]


def test_known_ids_with_decimals(spark):
    rows = [(Decimal("12.5"), "x"), (Decimal("0.1234567"), "y"), (None, "z")]
    got = ids_of(spark, rows, "amount decimal(20,7), tag string", ["amount", "tag"], decimals=["amount"])
    assert got == [AMOUNT_X, AMOUNT_Y, ONLY_Z]


VALUE = st.text(alphabet="abcXYZ019'ü", min_size=1, max_size=6).map(lambda v: "v" + v)
BLANK = st.sampled_from(["", " ", "\t", "\n ", "\u00a0"])
NOTHING = st.sampled_from([None, "", "  ", "nan", "NaN", "NULL", "none ", " NaT"])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(VALUE, VALUE, BLANK, BLANK, NOTHING), min_size=1, max_size=6))
def test_ids_ignore_case_blanks_column_order_and_empty_values(spark, rows):
    plain = ids_of(spark, [(a, b, None) for a, b, *_ in rows], "a string, b string, c string", ["a", "b", "c"])
    loud = ids_of(spark, [(x + a.upper() + y, y + b + x, n) for a, b, x, y, n in rows],
                  "a string, b string, c string", ["c", "b", "a"])
    low = ids_of(spark, [(a.lower(), b.lower(), None) for a, b, *_ in rows], "a string, b string, c string", ["b", "a", "c"])
    upper = [("ü" not in a + b) for a, b, *_ in rows]
    assert plain == low
    assert [p for p, u in zip(plain, upper) if u] == [p for p, u in zip(loud, upper) if u]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(VALUE, VALUE), min_size=2, max_size=8, unique_by=lambda r: (r[0].lower(), r[1].lower())))
def test_different_values_have_different_ids(spark, rows):
    got = ids_of(spark, rows, "a string, b string", ["a", "b"])
    assert len(set(got)) == len(rows) and None not in got
    assert all(len(u) == 36 and u.count("-") == 4 for u in got)


def test_null_skipping_collides_on_purpose(spark):
    df = spark.createDataFrame([(None, "x"), ("x", None)], "a string, b string")
    ids = [r.u for r in df.select(K.stable_uuid(["a", "b"]).alias("u")).collect()]
    assert ids[0] == ids[1]


def test_md5_sorted_values_rule(spark):
    df = spark.createDataFrame([("b", "A"), ("a", "B")], "x string, y string")
    ids = [r.u for r in df.select(K.stable_uuid(["x", "y"], algo="md5", sort_values=True).alias("u")).collect()]
    assert ids[0] == ids[1]
    assert ids[0].replace("-", "") == hashlib.md5(b"a,b").hexdigest()


def test_row_key_business_key_change_hash(spark):
    df = spark.createDataFrame([("S", 1, None)], "src string, a int, b string")
    r = df.select(K.business_key(["src", "a", "b"]).alias("bk"), K.row_key(["src", "a", "b"]).alias("rk"),
                  K.change_hash(["a", "b"]).alias("h")).first()
    assert r.bk == "S-1-"
    assert r.rk == hashlib.sha256(b"S-1-").hexdigest()
    assert r.h == hashlib.md5(b"1-*~+").hexdigest()


def test_entity_and_firm_ids(spark):
    df = spark.createDataFrame([("42", "Acme"), (" none ", "Acme"), (None, "Acme")], "id string, name string")
    out = df.select(K.entity_id("id", "name").alias("e"), K.entity_id("id", "name", usable_only=True).alias("u"),
                    K.firm_id("FIRM", client_id=F.col("id")).alias("f")).collect()
    assert out[0].e == out[0].u == "42"
    assert out[1].e == " none "                       # reference: only NULL counts as absent
    assert out[1].u == out[2].u == out[2].e == ACME
    assert [r.f for r in out] == ["FIRM", "FIRM", None]


def test_no_python_udf_in_plan(spark):
    df = spark.range(5).select(F.col("id").cast("string").alias("a"))
    plan = df.select(K.stable_uuid(["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_sixteen_bytes_are_the_id(spark):
    rows = [("12", "Acme"), (None, " nan "), ("x", None), ("", "null")]
    df = spark.createDataFrame(rows, "a string, b string").select(
        K.stable_uuid(["a", "b"]).alias("u"), K.stable_bytes(["a", "b"]).alias("x"))
    got = [(r.u, r.v) for r in df.select("u", K.uuid_of(F.col("x")).alias("v"), "x").collect()]
    assert got[0][0] == ACME_12 and all(u == v or (u is None and v == "") for u, v in got)
    assert [r.x is None for r in df.collect()] == [False, True, False, True]
