"""Spend rows: made distinct after they are distributed, so a task that widens links holds none of them."""

from pyspark.sql import functions as F

from ledgerline.operators.dedupe import distinct_wide
from ledgerline.plans import staging as S

NAN = float("nan")


def test_distinct_wide_equals_distinct(spark):
    rows = [("a", 1, 0.0), ("a", 1, -0.0), ("a", 1, NAN), ("a", 1, NAN), (None, 1, 0.5), (None, 1, 0.5), (None, None, None),
            (None, None, None), ("b", 2, 0.5), ("b", 2, 0.25), ("", None, None)]
    df = spark.createDataFrame(rows, "`a.b` string, n int, x double").withColumn("same", F.lit("USD"))
    want, got = (sorted(map(str, d.collect())) for d in (df.distinct(), distinct_wide(df, ["n"])))
    assert [g.replace("-0.0", "0.0") for g in got] == [w.replace("-0.0", "0.0") for w in want] and len(got) == 7


def test_spend_rows_are_held_after_their_one_exchange(spark):
    df = spark.range(1000).selectExpr("concat('b', id % 10) payor", "concat('v', id % 20) payee", "'20240101' d", "'USD' ccy")
    out = S.build_spend(df, "payor", "payee", {"period_start_date": "d"}, {"payment_ccy": F.col("ccy")})
    lines = out._jdf.queryExecution().executedPlan().toString().split("\n")
    exchange = [i for i, x in enumerate(lines) if "Exchange" in x]
    assert len(exchange) == 1
    assert not any(op in x for x in lines[exchange[0]:] for op in ("Aggregate", "Sort", "Window")), lines
    assert out.count() == 20
