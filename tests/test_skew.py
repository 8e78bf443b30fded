"""Hot keys: one key holding a third of all rows is split across tasks and
still gives exact results."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import merge, windows
from ledgerline.operators.dedupe import latest


def _hot(spark, n=3000):
    # key 0 holds a third of the rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("t"), (F.col("id") % 7).alias("v"))


def test_hot_key_is_split_into_chunks(spark):
    df = _hot(spark)
    ranged = windows._ranged(df, ["k"], [F.col("t")], chunks=8)
    chunks = ranged.filter("k = 0").select("_chunk").distinct().count()
    assert chunks >= 3


def test_hot_key_running_sum_exact(spark):
    df = _hot(spark)
    out = windows.running_sum(df, ["k"], ["t"], "v", "run", chunks=8)
    hot = [r.run for r in out.filter("k = 0").orderBy("t").collect()]
    vals = [r.v for r in df.filter("k = 0").orderBy("t").collect()]
    acc, want = 0, []
    for v in vals:
        acc += v
        want.append(acc)
    assert hot == want


def test_hot_duplicate_key_upsert_keeps_one_row(spark):
    src = _hot(spark).select(F.col("k").cast("string").alias("k"), F.col("t").cast("timestamp").alias("created_date"),
                             F.col("v").cast("string").alias("val"), F.lit("I").alias("load_flag"))
    tgt = spark.createDataFrame([], "k string, created_date timestamp, val string")
    res = merge.upsert(src, tgt, ["k"], as_of=F.lit("2024-01-01").cast("timestamp"))
    rows = res.target.filter("k = '0'").collect()
    assert len(rows) == 1 and rows[0].val == str(2997 % 7)
    assert res.target.count() == res.target.select("k").distinct().count()


def test_latest_hot_key_pre_aggregates(spark):
    out = latest(_hot(spark), ["k"], ["t"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    aggs = [i for i, line in enumerate(lines) if "Aggregate(" in line]
    exch = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    # final aggregate above the shuffle and a partial one below it: the hot key ships one row per task
    assert len(exch) == 1 and len(aggs) == 2 and aggs[0] < exch[0] < aggs[1]
    assert out.filter("k = 0").first().t == 2997


@pytest.mark.parametrize("chunks", [1, 2, 4, 9])
def test_windows_keep_null_keys_and_null_values(spark, chunks):
    rows = [(None if i % 3 == 0 else i % 2, i, None if i % 20 < 11 else i) for i in range(120)]
    df = spark.createDataFrame(rows, "k int, t int, v int")
    run = {r.t: r.x for r in windows.running_sum(df, ["k"], ["t"], "v", "x", chunks=chunks).collect()}
    lag = {r.t: r.x for r in windows.previous_value(df, ["k"], ["t"], "v", "x", chunks=chunks).collect()}
    total, before = {}, {}
    for k, t, v in rows:
        if v is not None:
            total[k] = total.get(k, 0) + v
        assert run[t] == total.get(k) and lag[t] == before.get(k)
        before[k] = v
    assert len(run) == len(lag) == len(rows)


def test_missing_checkpoint_folder_raises_unless_local(spark, monkeypatch):
    from ledgerline import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())
