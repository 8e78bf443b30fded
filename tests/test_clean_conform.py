"""Cleaning, predicates, conformance and melt on small invented frames."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.functions import scalar as X
from ledgerline.operators import clean, conform, reshape


def test_clean_blanks_only_strings(spark):
    df = spark.createDataFrame([(" ", "NaN", 1), ("x", None, 2), ("nan ", "ok", 3)], "a string, b string, n int")
    out = clean.clean_blanks(df).orderBy("n").collect()
    assert [(r.a, r.b) for r in out] == [(None, None), ("x", None), (None, "ok")]
    assert clean.clean_blanks(df).schema == df.schema


def test_predicates(spark):
    df = spark.createDataFrame([(None,), ("",), ("[]",), ("{}",), ("null",), ('{"a":1}',)], "j string")
    assert [r.e for r in df.select(X.is_empty("j").alias("e")).collect()] == [True] * 5 + [False]
    names = spark.createDataFrame([("none",), ("None",), ("  ",), (None,), ("O'Brien",)], "n string")
    r = names.select(X.valid_name("n").alias("p"), X.valid_name("n", True).alias("a")).collect()
    assert [x.p for x in r] == [False, True, False, False, True]
    assert [x.a for x in r] == [False, False, False, False, True]
    ids = spark.createDataFrame([(" NULL",), ("None",), ("",), ("17",), (None,)], "i string")
    assert [x.v for x in ids.select(X.valid_id("i").alias("v")).collect()] == [False, False, False, True, False]


def test_any_meaningful_and_all_null(spark):
    df = spark.createDataFrame([(None, "null", 1), ("", None, 2), ("x", None, 3), (None, None, 4)],
                               "a string, b string, n int")
    assert [r.n for r in clean.keep_meaningful(df, ["a", "b"]).collect()] == [3]
    assert sorted(r.n for r in clean.drop_all_null(df, ["a", "b"]).collect()) == [1, 2, 3]


def test_yes_no_three_valued(spark):
    df = spark.createDataFrame([("Yes",), (" no",), ("maybe",), (None,)], "t string")
    assert [r.b for r in df.select(X.yes_no("t").alias("b")).collect()] == [True, False, None, None]


def test_prefilter_null_safe_and_none(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, None), (3, "none"), (4, "b")], "id int, k string")
    keys = spark.createDataFrame([("a",), (None,)], "k string")
    assert sorted(r.id for r in clean.prefilter(tgt, keys, ["k"]).collect()) == [1, 2]
    assert sorted(r.id for r in clean.prefilter(tgt, keys, ["k"], none_as_null=True).collect()) == [1, 2, 3]


def test_mapping_is_explicit_per_target(spark):
    rows = [dict(source_table="l", source_column=" Vendor_Name_Cleaned", target_table="details",
                 target_column="business_entity_name"),
            dict(source_table="l", source_column="vendor_name_cleaned", target_table="contacts",
                 target_column="contact_name"),
            dict(source_table="l", source_column="junk", target_table="details", target_column="nomapping")]
    assert conform.mapping_dict(rows, "details") == {"vendor_name_cleaned": "business_entity_name"}
    assert conform.mapping_dict(rows, "contacts") == {"vendor_name_cleaned": "contact_name"}
    df = spark.createDataFrame([("x", "y")], "VENDOR_NAME_CLEANED string, junk string")
    out = conform.apply_mapping(df, conform.mapping_dict(rows, "details"))
    assert out.columns == ["business_entity_name", "junk"]


def test_ensure_columns_typed_nulls(spark):
    df = spark.createDataFrame([("a",)], "x string")
    out = conform.ensure_columns(df, ["x", "start_date", "card_amount", "note"])
    types = {f.name: f.dataType.simpleString() for f in out.schema.fields}
    assert types == {"x": "string", "start_date": "date", "card_amount": "double", "note": "string"}


def test_fix_void_and_project(spark):
    df = spark.range(2).select(F.lit(None).alias("v"), F.col("id"))
    assert conform.fix_void(df).schema["v"].dataType == StringType()
    spec = conform.OutputSpec("t", {"k": "CAST(id AS STRING)", "half": "CAST(id / 2 AS DECIMAL(38,6))"}, keys=("k",))
    out = conform.project(spark.createDataFrame([(1,), (1,), (None,)], "id long"), spec, "me",
                          as_of=F.lit("2024-01-01").cast("timestamp"))
    rows = out.collect()
    assert len(rows) == 1 and rows[0].created_by == "me" and rows[0].is_active is True


def test_suffix_and_valid_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, "U")], "a int, b_stg int, c int, load_flag string")
    assert conform.suffix(df).columns == ["a_stg", "b_stg", "c_stg", "load_flag_stg"]
    assert conform.valid_columns(df, ["a"], keys=["c"], flag="load_flag").columns == ["a", "c", "load_flag"]
    other = spark.createDataFrame([(1,)], "A int")
    assert conform.common_columns(df, other) == ["a"]


def test_melt_single_scan_drops_nulls(spark):
    df = spark.createDataFrame([("e1", "x@y", None), ("e1", "x@y", "w"), ("e2", None, None)],
                               "id string, email string, website string")
    out = reshape.melt(df, "id", ["email", "website"], ("t", "v"))
    plan = out._jdf.queryExecution().executedPlan().toString()   # before execution: one plan only
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") <= 1
    assert "Expand" in plan
    assert sorted(tuple(r) for r in out.collect()) == [("e1", "email", "x@y"), ("e1", "website", "w")]
    renamed = out.select(reshape.rename_types("t").alias("t")).distinct().collect()
    assert sorted(r.t for r in renamed) == ["primary", "website"]


def test_class_of(spark):
    df = spark.createDataFrame([("level-1",), ("naics",)], "t string")
    assert [r.c for r in df.select(reshape.class_of("t").alias("c")).collect()] == ["bloomberg", "internal"]


def test_empty_like_and_validate(spark):
    from ledgerline.operators import quality
    schema = StructType([StructField("a", StringType())])
    e = clean.empty_like(spark, schema)
    assert e.schema == schema
    with pytest.raises(ValueError):
        quality.validate(e, ["a"])
    with pytest.raises(ValueError):
        quality.validate(spark.range(1), ["missing"])


def test_dates_and_numbers(spark):
    df = spark.createDataFrame([("20240229", 124060), ("2024-02-30", 0), ("bad", None)], "t string, j int")
    r = df.select(X.parse_date("t").alias("d"), X.julian_to_text("j").alias("y")).collect()
    assert str(r[0].d) == "2024-02-29" and r[1].d is None and r[2].d is None
    assert [x.y for x in r] == ["20240229", None, None]
    s = spark.createDataFrame([(125000,)], "q long").select(X.scaled_decimal("q").alias("v")).first().v
    assert str(s) == "12.50000"


def test_merge_lists(spark):
    df = spark.createDataFrame([("a;b", "b;c"), (None, None), ("x", None)], "a string, b string")
    out = [r.m for r in df.select(X.merge_lists("a", "b").alias("m")).collect()]
    assert out == ["a;b;c", None, "x"]
