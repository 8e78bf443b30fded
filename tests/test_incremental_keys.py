"""Delta-key increments, ordered carries in any order, and hot or NULL lookup keys."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators import incremental as inc
from ledgerline.operators import joins, windows


def _tables(spark, seed):
    rng = random.Random(seed)
    day = lambda: None if rng.random() < 0.3 else f"2024-0{rng.randint(1, 9)}-10 0{rng.randint(0, 9)}:00:00"
    facts = [(k, rng.choice([None, 1, 2, 3, 4, 99]), rng.choice([None, "a", "b"]), day(), day()) for k in range(80)]
    one = [(k, day(), day()) for k in (1, 2, 3, 4, 4)]
    two = [(k, day(), day()) for k in ("a", "b", None)]
    stamp = lambda rows, key: spark.createDataFrame(rows, f"{key}, upd string, ld string").withColumns(
        {c: F.col(c).cast("timestamp") for c in ("upd", "ld")})
    return stamp(facts, "id int, k1 int, k2 string"), stamp(one, "d1 int"), stamp(two, "d2 string")


@pytest.mark.parametrize("mark", ["1900-01-01 00:00:00", "2024-03-10 04:00:00", "2024-09-11 00:00:00"])
def test_delta_keys_equal_the_filtered_join(spark, mark):
    f, a, b = _tables(spark, 3)
    m = inc.mark_of(spark, F.lit(mark).cast("timestamp"))
    got = inc.changed_facts(f, ("upd", "ld"), [inc.Dimension(a, "d1", "k1", ("upd", "ld")),
                                               inc.Dimension(b, "d2", "k2", ("upd", "ld"))], m)
    assert got.columns == f.columns
    j = (f.join(a.select("d1", F.col("upd").alias("u1"), F.col("ld").alias("l1")), F.col("k1") == F.col("d1"), "left")
         .join(b.select("d2", F.col("upd").alias("u2"), F.col("ld").alias("l2")), F.col("k2") == F.col("d2"), "left"))
    want = inc.changed_since(j, [("upd", "ld"), ("u1", "l1"), ("u2", "l2")], F.lit(mark).cast("timestamp"))
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in want.select("id").distinct().collect())


def test_time_filters_reach_the_scans(spark, tmp_shared):
    d = "/root/testdata/sf0.001"
    o = spark.read.parquet(f"{d}/orders.parquet")
    m = inc.mark_of(spark, F.lit("1998-01-01 10:00:00").cast("timestamp"))
    assert m.day == "1998-01-02"
    plan = o.filter(inc.at_or_after(o, ("o_orderdate", "o_orderdate"), m))._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):].split("\n")[0]
    assert "GreaterThanOrEqual(o_orderdate" in pushed


@pytest.mark.parametrize("chunks", [1, 3, 8])
@pytest.mark.parametrize("order", ["t ASC, id ASC", "t DESC, id DESC", "t ASC NULLS LAST, id DESC", "t DESC NULLS FIRST, id"])
def test_previous_value_in_any_order(spark, chunks, order):
    def column(text):
        name, *rest = text.split()
        way = "_".join(rest).lower() or "asc"
        return getattr(F.col(name), way)()
    order = [column(t) for t in order.split(", ")]
    rng = random.Random(5)
    rows = [(k, rng.choice([0, 0, 1, None]), rng.choice([None, *range(20)]), rng.choice([None, "a", "b"])) for k in range(90)]
    df = spark.createDataFrame(rows, "id int, k int, t int, v string").repartition(3)
    want = df.withColumn("x", F.lag("v").over(Window.partitionBy("k").orderBy(*order)))
    got = windows.previous_value(df, ["k"], order, "v", "x", chunks=chunks)
    assert {r["id"]: r["x"] for r in got.collect()} == {r["id"]: r["x"] for r in want.collect()}


def test_lookups_with_hot_and_null_keys(spark):
    fact = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 7)
                                    .otherwise(F.col("id")).alias("k"))
    dim = spark.createDataFrame([(7, "b"), (7, "a"), (8, "c"), (None, "n")], "d long, code string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = joins.resolve_keys(fact, [(dim, "k", "d", "code", "x"), (dim, "k", "d", "code", "y")])
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert out.columns == ["id", "k", "x", "y"] and len(rows) == 3000
    for r in rows:
        want = {7: "a", 8: "c"}.get(r["k"], "-1")
        assert (r["x"], r["y"]) == (want, want)
    assert "Aggregate" not in plan and plan.count("SortMergeJoin") >= 2      # every side of a join has its own exchange
