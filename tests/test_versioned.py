"""Bucketed copy-on-write, whole sets of tables, streams from a version, many files in one scan."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import merge
from ledgerline.sources import versioned as V


def _hub(spark, root, n=2000, **options):
    df = spark.range(n).select(F.col("id").alias("k"), F.lit("a").alias("v"), F.col("id").alias("own"), F.lit("h").alias("h"))
    hub = V.BucketedTable(root, ["k"], df.schema, **options)
    hub.store(df)
    return hub


def test_a_small_source_rewrites_its_buckets_only(spark, tmp_shared):
    hub = _hub(spark, f"{tmp_shared}/hub", buckets=64)
    source = spark.createDataFrame([(k, "b", "g") for k in (5, 6, 9000)] + [(5, "a", "g")], "k long, v string, h string")
    commit, n = hub.scd1(source, "h")
    touched = {r[0] for r in source.select(hub.bucket()).distinct().collect()}
    assert {b for b, v in commit.versions.items() if v == commit.number} == touched and len(commit.versions) == 64
    assert (n["source"], n["update"], n["insert"]) == (4, 2, 1) and n["untouched"] < 2000 / 8
    want = {k: ("b" if k in (5, 6) else "a", k) for k in range(2000)} | {9000: ("b", None)}
    assert {r["k"]: (r["v"], r["own"]) for r in hub.read(spark).collect()} == want
    assert {r["v"] for r in hub.read(spark, 0).collect()} == {"a"}


def test_a_crash_before_the_commit_leaves_the_old_version(spark, tmp_shared):
    hub = _hub(spark, f"{tmp_shared}/hub", 50, buckets=4)
    source = spark.createDataFrame([(k, "b", "g") for k in range(50)], "k long, v string, h string")

    def broken(s, t):
        res = merge.scd1_merge(s, t, ["k"], "h")
        bad = F.when(F.col("t_k") == 49, F.raise_error(F.lit("lost"))).otherwise(F.lit("b"))
        return merge.MergeResult(res.classified, res.target, res.rejects, res.report, [bad.alias("v"), *res.columns[:1],
                                                                                       *res.columns[2:]])
    with pytest.raises(Exception, match="lost"):
        hub.merge(source, broken)
    assert hub.read(spark).filter("v = 'a'").count() == 50
    assert hub.scd1(source, "h")[1]["update"] == 50 and hub.read(spark).filter("v = 'b'").count() == 50


def test_deletes_upserts_and_old_versions(spark, tmp_shared):
    hub = _hub(spark, f"{tmp_shared}/hub", 200, buckets=16, keep=2)
    first = hub.hard_delete(spark.range(200).select(F.col("id").alias("k")).filter("k NOT IN (3, 4)"), "k < 100")
    assert len([b for b, v in first.versions.items() if v == 1]) <= 2
    assert sorted(set(range(200)) - {r["k"] for r in hub.read(spark).collect()}) == [3, 4]
    assert hub.hard_delete(spark.range(200).select(F.col("id").alias("k"))).number == 1       # nothing to delete
    flags = spark.createDataFrame([(3, "n", "I"), (5, "u", "U"), (6, "x", "I")], "k long, v string, load_flag string")
    _, n = hub.upsert(flags, on_duplicates="raise")
    assert (n["insert"], n["update"], n["rejected"]) == (1, 1, 1)
    assert {r["k"]: r["v"] for r in hub.read(spark).filter("k IN (3, 5, 6)").collect()} == {3: "n", 5: "u", 6: "a"}
    hub.hard_delete(spark.createDataFrame([], "k long"))
    assert hub.read(spark).count() == 0 and hub.read(spark, 2).count() == 199
    with pytest.raises(ValueError, match="not kept"):
        hub.read(spark, 0)
    assert len(os.listdir(f"{tmp_shared}/hub/_commits")) == 2
    with pytest.raises(ValueError, match="buckets"):
        V.BucketedTable(f"{tmp_shared}/hub", ["k"], hub.schema, buckets=5).scd1(flags, "v")


def test_a_set_is_published_whole_or_not_at_all(spark, tmp_shared):
    root = f"{tmp_shared}/sets"
    frames = {f"t{k}": spark.range(k + 1) for k in range(16)}
    assert V.publish_all(spark, frames, root) == 1
    worse = {n: df.select(F.raise_error(F.lit("bad")).alias("id")) if n == "t8" else df.union(df) for n, df in frames.items()}
    with pytest.raises(RuntimeError, match="t8"):
        V.publish_all(spark, worse, root)
    assert [V.read_published(spark, root, f"t{k}").count() for k in (0, 8, 15)] == [1, 9, 16]
    assert all(len(os.listdir(f"{root}/t{k}")) == 1 for k in range(16))
    for _ in range(3):
        V.publish_all(spark, {n: df.union(df) for n, df in frames.items()}, root)
    assert V.read_published(spark, root, "t15").count() == 32 and len(os.listdir(f"{root}/t15")) == 2
    with pytest.raises(ValueError, match="no published"):
        V.read_published(spark, root, "other")


def test_stream_starts_at_a_version(spark, tmp_shared):
    root, out, mark = (f"{tmp_shared}/{n}" for n in ("in", "out", "mark"))
    df = spark.range(10)
    for k in range(4):
        V.append_version(df.select((F.col("id") + 10 * k).alias("id")), root, k)

    def run(start):
        q = (V.stream_versions(spark, root, df.schema, start).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", mark).trigger(availableNow=True).start())
        assert q.awaitTermination(120)
        return sorted(r["id"] for r in spark.read.parquet(out).collect())
    assert run(2) == list(range(20, 40))
    V.append_version(df.select((F.col("id") + 40).alias("id")), root, 4)
    assert run(2) == list(range(20, 50))
    with pytest.raises(Exception, match="(?i)exist"):
        V.append_version(df, root, 4)


def test_many_files_in_one_scan(spark, tmp_shared):
    from pyspark.sql import types as T

    from ledgerline.plans import load
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    os.makedirs(f"{tmp_shared}/files")
    for k in range(1000):
        lines = ["k,v", f"{k},a", f"{k},b"] + {5: ["no number,x"], 50: ["1,2,3,4"], 500: ["1,a", "z,z"]}.get(k, [])
        with open(f"{tmp_shared}/files/f{k}.csv", "w") as f:
            f.write("" if k == 7 else "k,v\n" if k == 8 else "\n".join(lines))
    rows, log = load.scan_files(spark, f"{tmp_shared}/files", schema, options={"header": "true"})
    status = {int(r["file_name"].rsplit("f", 1)[1][:-4]): (r["status"], r["n_rows"], r["error"]) for r in log.collect()}
    assert {k for k, s in status.items() if s[0] == "failed"} == {5, 50, 500} and len(status) == 999
    assert 7 not in status and status[8] == ("completed", 0, "") and status[9] == ("completed", 2, "")
    assert status[5][1] == 0 and "1 records" in status[5][2] and "no number" in status[5][2]
    got = rows.select("k").distinct().collect()
    assert {r["k"] for r in got} == set(range(1000)) - {5, 50, 500, 7, 8} and rows.count() == 2 * 995
