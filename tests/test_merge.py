"""Upsert by load flag, SCD1 merge, update-only merge, hard delete."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import merge

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 2, 1)
T2 = dt.datetime(2024, 3, 1)


def _as_of():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")

SRC_SCHEMA = ("card_association_id string, association_name string, matched_level_2 boolean, "
              "is_active boolean, created_by string, created_date timestamp, load_flag string")
TGT_SCHEMA = ("card_association_id string, association_name string, matched_level_2 boolean, "
              "is_active boolean, created_by string, created_date timestamp, last_updated_by string, "
              "last_updated_date timestamp")


@pytest.fixture
def pair(spark):
    target = spark.createDataFrame([
        ("k1", "old", True, True, "seed", T0, "seed", T0),
        ("k2", "old", True, True, "seed", T0, "seed", T0),
        ("k4", "old", False, True, "seed", T0, "seed", T0),
        (None, "nullkey", True, True, "seed", T0, "seed", T0),
        ("k9", "keep", True, True, "seed", T0, "seed", T0),
        ("k6", "old", True, True, "seed", T0, "seed", T0),
    ], TGT_SCHEMA)
    source = spark.createDataFrame([
        ("k1", "new", None, True, "loader", T1, "U"),        # U matched, NULL boolean over true
        ("k3", "new", True, True, "loader", T1, "U"),        # U unmatched → reject
        ("k5", "new", False, None, "loader", T1, "I"),       # I unmatched → insert
        ("k2", "new", True, True, "loader", T1, "I"),        # I matched → reject
        ("k4", "new", True, True, "loader", T1, None),       # NULL flag → reject
        ("k7", "new", True, True, "loader", T1, "x"),        # unknown flag → reject
        ("k6", "low", True, True, "loader", T1, "u"),        # lower-case u → update
        (None, "nullkey2", False, True, "loader", T1, "U"),  # NULL key on both sides → update
        ("k1", "newer", True, True, "loader", T2, "U"),      # duplicate source key: latest wins
    ], SRC_SCHEMA)
    return source, target


def test_upsert_outcomes(pair):
    source, target = pair
    res = merge.upsert(source, target, ["card_association_id"], as_of=_as_of(), order=["created_date"])
    t = {r.card_association_id: r for r in res.target.collect()}
    assert set(t) == {"k1", "k2", "k4", None, "k9", "k6", "k5"}
    assert t["k1"].association_name == "newer" and t["k1"].last_updated_by == "loader"
    assert t["k1"].created_by == "seed" and t["k1"].last_updated_date == dt.datetime(2024, 6, 1)
    assert t["k2"].association_name == "old" and t["k4"].association_name == "old"
    assert t["k6"].association_name == "low"
    assert t[None].association_name == "nullkey2" and t[None].matched_level_2 is False
    assert t["k5"].is_active is None and t["k5"].last_updated_by == "loader"
    assert t["k9"].association_name == "keep"
    rej = {r.card_association_id: r.reject_reason for r in res.rejects.collect()}
    assert rej == {"k3": "reject_update_unmatched", "k2": "reject_insert_matched", "k4": "reject_unknown_flag",
                   "k7": "reject_unknown_flag"}
    rep = {r.outcome: r.n for r in res.report.collect()}
    assert sum(rep.values()) == source.count() == 9   # every source row has one outcome
    assert rep["update"] == 3 and rep["insert"] == 1 and rep["superseded"] == 1


def test_upsert_null_boolean_overwrites(pair, spark):
    source, target = pair
    src = source.filter(F.col("card_association_id") == "k1").filter(F.col("created_date") == T1)
    res = merge.upsert(src, target, ["card_association_id"], as_of=_as_of(), on_duplicates="keep")
    k1 = [r for r in res.target.collect() if r.card_association_id == "k1"][0]
    assert k1.matched_level_2 is None


def test_upsert_twice_is_idempotent_on_values(pair):
    source, target = pair
    once = merge.upsert(source, target, ["card_association_id"], as_of=_as_of()).target
    twice = merge.upsert(source.filter(F.upper(F.trim("load_flag")) == "U"), once,
                         ["card_association_id"], as_of=_as_of()).target
    cols = [c for c in once.columns if c != "last_updated_date"]
    assert sorted(map(tuple, once.select(cols).collect()), key=str) == \
        sorted(map(tuple, twice.select(cols).collect()), key=str)


def test_upsert_key_mapping(spark):
    tgt = spark.createDataFrame([("e1", "a")], "business_entity_id string, name string")
    src = spark.createDataFrame([("e1", "b", "U")], "stg_business_entity_id string, name string, load_flag string")
    res = merge.upsert(src, tgt, ["business_entity_id"], mapping={"stg_business_entity_id": "business_entity_id"},
                       as_of=_as_of(), on_duplicates="keep")
    assert [tuple(r) for r in res.target.collect()] == [("e1", "b")]


def test_upsert_raise_on_duplicates(pair):
    source, target = pair
    with pytest.raises(ValueError):
        merge.upsert(source, target, ["card_association_id"], on_duplicates="raise")


def test_scd1_merge(spark):
    tgt = spark.createDataFrame([(1, "a", "h1", T0, None), (2, "b", "h2", T0, None), (3, "c", "h3", T0, None)],
                                "k int, v string, h string, ld timestamp, upd timestamp")
    src = spark.createDataFrame([(1, "a", "h1"), (2, "B", "hX"), (4, "d", "h4"), (4, "d2", "h4b")],
                                "k int, v string, h string")
    src = src.withColumn("ld", F.lit(None).cast("timestamp")).withColumn("upd", F.lit(None).cast("timestamp"))
    res = merge.scd1_merge(src, tgt, ["k"], "h", upd_col="upd", ld_col="ld", as_of=_as_of(),
                           order=[F.col("v")])
    out = {r.k: r for r in res.target.collect()}
    assert out[1].v == "a" and out[1].upd is None
    assert out[2].v == "B" and out[2].upd == dt.datetime(2024, 6, 1) and out[2].ld == T0
    assert out[3].v == "c"
    assert out[4].v == "d2" and out[4].ld == dt.datetime(2024, 6, 1)
    rep = {r.outcome: r.n for r in res.report.collect()}
    assert rep == {"unchanged": 1, "update": 1, "insert": 1, "superseded": 1}


def test_scd1_late_change_ignored(spark):
    tgt = spark.createDataFrame([(1, "new", "h2", T2)], "k int, v string, h string, t timestamp")
    src = spark.createDataFrame([(1, "old", "h1", T1)], "k int, v string, h string, t timestamp")
    res = merge.scd1_merge(src, tgt, ["k"], "h", ignore_older=True, guard_col="t", on_duplicates="keep")
    assert [r.v for r in res.target.collect()] == ["new"]


def test_scd1_guard_moves_on_with_an_equal_hash(spark):
    schema = "k int, v string, h string, t int"
    target = spark.createDataFrame([(1, "A", "a", 1)], schema)
    for change in [(1, "A", "a", 3), (1, "B", "b", 2)]:         # A again at 3, then B of 2 arrives late
        target = merge.scd1_merge(spark.createDataFrame([change], schema), target, ["k"], "h", ignore_older=True,
                                  guard_col="t", on_duplicates="keep").target
    assert [tuple(r) for r in target.collect()] == [(1, "A", "a", 3)]


def test_merge_leaves_rows_out_of_scope_unshuffled(spark):
    tgt = spark.range(100).selectExpr("id k", "'h' h", "id % 2 site")
    src = spark.range(10).selectExpr("id k", "'x' h", "id % 2 site")
    res = merge.scd1_merge(src, tgt, ["k"], "h", tgt_filter="site = 0", on_duplicates="keep")
    plan = res.target._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "FullOuter" not in plan
    assert res.target.count() == 100 + 5


def test_scd1_target_filter_scope(spark):
    tgt = spark.createDataFrame([(1, "x", "h", "A"), (2, "y", "h", "B")], "k int, v string, h string, site string")
    src = spark.createDataFrame([(1, "x2", "h9", "A"), (2, "y2", "h9", "B")], "k int, v string, h string, site string")
    res = merge.scd1_merge(src, tgt, ["k"], "h", tgt_filter="site = 'A'", on_duplicates="keep")
    rows = sorted((r.k, r.v) for r in res.target.collect())
    # out-of-scope target row stays; its source twin does not match and is inserted (MERGE semantics)
    assert rows == [(1, "x2"), (2, "y"), (2, "y2")]


def test_merge_update_only(spark):
    tgt = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, name string, price int")
    src = spark.createDataFrame([(1, 11, "Y"), (3, 33, "Y"), (2, 22, "N")], "k int, price int, active string")
    out = merge.merge_update(src, tgt, ["k"], ["price"], source_filter="active = 'Y'")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", 11), (2, "b", 20)]


def test_hard_delete_scope_and_default(spark):
    tgt = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B"), (None, "A")], "k int, site string")
    src = spark.createDataFrame([(1,), (None,)], "k int")
    out = merge.hard_delete(src, tgt, ["k"], scope="site = 'A'")
    assert sorted((r.k or 0, r.site) for r in out.collect()) == [(0, "A"), (1, "A"), (3, "B")]
    out2 = merge.hard_delete(src, tgt, ["k"], default="-1")
    assert sorted(r.k or 0 for r in out2.collect()) == [0, 1]


def test_inactive_to_null(spark):
    df = spark.createDataFrame([("v", "Y"), ("v", "N")], "x string, a string")
    assert [r.o for r in df.select(merge.inactive_to_null("x", "a", replacement="-1").alias("o")).collect()] == \
        ["v", "-1"]


def test_update_keeps_target_only_columns(spark):
    tgt = spark.createDataFrame([(1, "a", 7, "h1"), (2, "b", 8, "h2")], "k int, v string, x int, h string")
    src = spark.createDataFrame([(1, "B", "new", "h9"), (3, "c", "new", "h3")], "K int, V string, extra string, H string")
    res = merge.scd1_merge(src, tgt, ["k"], "h")
    assert sorted(res.target.collect()) == [(1, "B", 7, "h9"), (2, "b", 8, "h2"), (3, "c", None, "h3")]
    wide = merge.scd1_merge(src, tgt, ["k"], "h", evolve="extra string, other int").target
    assert wide.columns == ["k", "v", "x", "h", "extra", "other"]
    assert sorted(wide.collect())[0] == (1, "B", 7, "h9", "new", None)
    assert sorted(wide.collect())[1] == (2, "b", 8, "h2", None, None)
    with pytest.raises(ValueError, match="lacks"):
        merge.scd1_merge(src.drop("H"), tgt, ["k"], "h")


def test_scd1_without_times_takes_the_greatest_row(spark):
    tgt = spark.createDataFrame([(1, "a", "h1")], "k int, v string, h string")
    src = spark.createDataFrame([(1, "x", "hx"), (1, "y", "hy"), (2, "z", "hz")], "k int, v string, h string")
    for df in (src, src.orderBy("v", ascending=False)):
        res = merge.scd1_merge(df, tgt, ["k"], "h", upd_col="AUD_UPD_DTS", ld_col="AUD_LD_DTS")
        assert sorted(res.target.collect()) == [(1, "y", "hy"), (2, "z", "hz")]
        assert {r["outcome"]: r["n"] for r in res.report.collect()} == {"update": 1, "insert": 1, "superseded": 1}
    first = merge.scd1_merge(src, tgt, ["k"], "h", order=[F.col("v") == "x"])
    assert sorted(first.target.collect())[0] == (1, "x", "hx")


def test_align(spark):
    from ledgerline.operators.conform import align
    tgt = spark.createDataFrame([(1, "a", 2)], "Key long, Name string, Only int")
    src = spark.createDataFrame([("5", "b", 1.5, True)], "NAME string, key string, price double, junk boolean")
    s, t, plan = align(src.select("NAME", F.lit("9").alias("key"), "price", "junk"), tgt, {"price": "decimal(9,2)"})
    assert s.columns == ["Key", "Name", "price"] and t.columns == ["Key", "Name", "Only", "price"]
    assert plan.common == ("Key", "Name", "price") and plan.target_only == ("Only",) and plan.added == ("price",)
    assert [f.dataType.simpleString() for f in s.schema] == ["bigint", "string", "decimal(9,2)"]
    with pytest.raises(ValueError, match="letter case"):
        align(src.selectExpr("key AS a", "key AS A"), tgt)
