"""Streaming SCD1 sink, config-driven loads, sources, and billing."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import billing
from ledgerline.plans import load
from ledgerline.sources import io
from ledgerline.streaming import cdc

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()),
                       T.StructField("t", T.TimestampType()), T.StructField("h", T.StringType())])


def _write_batch(spark, folder, rows, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(os.path.join(folder, name))


def test_stream_equals_batch_and_is_idempotent(spark, tmp_shared):
    src = os.path.join(tmp_shared, "in")
    t = dt.datetime
    _write_batch(spark, src, [(1, "a", t(2024, 1, 1), "ha"), (2, "b", t(2024, 1, 1), "hb")], "b1")
    _write_batch(spark, src, [(1, "a2", t(2024, 1, 3), "ha2"), (1, "a1", t(2024, 1, 2), "ha1")], "b2")
    _write_batch(spark, src, [(2, "late", t(2023, 12, 1), "hl"), (3, "c", t(2024, 1, 5), "hc")], "b3")
    sink = cdc.Scd1StreamSink(os.path.join(tmp_shared, "target"), ["k"], "h", SCHEMA, ["t"], guard_col="t")
    stream = cdc.stream_source(spark, f"{src}/*", SCHEMA, options={"maxFilesPerTrigger": "1"})
    q = cdc.run_scd1_stream(stream, sink, os.path.join(tmp_shared, "ckpt"), timeout_s=300)
    assert q.exception() is None
    got = sorted((r.k, r.v) for r in sink.current(spark).collect())
    assert got == [(1, "a2"), (2, "b"), (3, "c")]        # late change for key 2 ignored
    assert sink.committed(spark)[0] == 2                   # three micro-batches 0, 1, 2
    # replaying a committed batch changes nothing
    sink(spark.createDataFrame([(1, "zzz", t(2030, 1, 1), "hz")], SCHEMA), 1)
    assert sorted((r.k, r.v) for r in sink.current(spark).collect()) == got
    # a second stream with a checkpoint of its own must not pass for a replay
    with pytest.raises(Exception, match="checkpoint of its own"):
        cdc.run_scd1_stream(stream, sink, os.path.join(tmp_shared, "ckpt2"), timeout_s=300)


def test_stream_rewrites_touched_buckets_and_retires_old_versions(spark, tmp_shared):
    t = dt.datetime(2024, 1, 1)
    root = os.path.join(tmp_shared, "target")
    sink = cdc.Scd1StreamSink(root, ["k"], "h", SCHEMA, ["t"], guard_col="t", buckets=4)
    sink(spark.createDataFrame([(k, "a", t, "a") for k in range(40)], SCHEMA), 0)
    for i in range(1, 5):
        sink(spark.createDataFrame([(7, f"v{i}", t + dt.timedelta(days=i), f"v{i}")], SCHEMA), i)
    last, versions = sink.committed(spark)
    assert last == 4 and sorted(versions.values()) == [0, 0, 0, 4]
    rows = {r.k: r.v for r in sink.current(spark).collect()}
    assert rows == {**{k: "a" for k in range(40)}, 7: "v4"}
    left = {d: sorted(x for x in os.listdir(os.path.join(root, d)) if x.startswith("_bucket"))
            for d in os.listdir(root) if d.startswith("v")}
    assert sum(map(len, left.values())) == 5            # the current four and the one before
    with pytest.raises(ValueError, match="buckets"):
        cdc.Scd1StreamSink(root, ["k"], "h", SCHEMA, ["t"], buckets=8)(spark.createDataFrame([], SCHEMA), 5)


def test_stream_commit_that_cannot_be_read_raises(spark, tmp_shared):
    root = os.path.join(tmp_shared, "target")
    os.makedirs(os.path.join(root, "_commits", "batch=0"))
    with open(os.path.join(root, "_commits", "batch=0", "part-0.json.gz"), "wb") as f:
        f.write(b"no gzip at all")
    sink = cdc.Scd1StreamSink(root, ["k"], "h", SCHEMA, ["t"])
    with pytest.raises(Exception):
        sink.current(spark)


def test_load_config_validation():
    with pytest.raises(ValueError):
        load.LoadConfig("erp", "src", "", "scd1").validate()
    with pytest.raises(ValueError):
        load.LoadConfig("erp", "src", "tgt", "scd1", merge_keys=("k",)).validate()   # hash column missing
    cfg = load.LoadConfig("erp", "src", "tgt", "scd1", merge_keys=("k",), hash_col="h",
                          source_sql="FULL", incremental_sql="INC")
    assert load.source_query(cfg) == "INC"
    assert load.source_query(load.LoadConfig("e", "s", "t", "truncate", source_sql="FULL",
                                             incremental_sql="INC")) == "FULL"


def test_run_load_strategies_and_hooks(spark):
    tgt = spark.createDataFrame([(1, "a", "h1", None, None), (2, "b", "h2", None, None)],
                                "k int, v string, h string, AUD_LD_DTS timestamp, AUD_UPD_DTS timestamp")
    spark.createDataFrame([(1, "a", "h1"), (3, "c", "h3")], "k int, v string, h string") \
         .createOrReplaceTempView("hook_src")
    cfg = load.LoadConfig("erp", "hook_src", "hub", "SCD1", merge_keys=("k",), hash_col="h", hard_delete=True,
                          pre_sql=("CREATE OR REPLACE TEMP VIEW hook_src2 AS SELECT * FROM hook_src",),
                          source_sql="SELECT k, v, h, CAST(NULL AS TIMESTAMP) AS AUD_LD_DTS, "
                                     "CAST(NULL AS TIMESTAMP) AS AUD_UPD_DTS FROM hook_src2",
                          post_sql=("CREATE OR REPLACE TEMP VIEW hook_done AS SELECT 1 AS x",))
    with pytest.raises(ValueError, match="post_sql"):
        load.run_load(spark, cfg, tgt, batch_id=3)
    written, notes = [], []
    res = load.execute_load(spark, cfg, tgt, written.append, notes.append, batch_id=3)
    assert sorted(r.k for r in written[0].collect()) == [1, 3]     # 2 hard-deleted, 3 inserted
    assert [n.first().status for n in notes] == ["running", "completed"]
    a = res.audit.first()
    assert a.src_data_count == 2 and a.operation == "MERGE" and a.error is None
    assert spark.table("hook_done").count() == 1


HUB = "k int, v string, h string, AUD_LD_DTS timestamp, AUD_UPD_DTS timestamp"


def _hub(spark, rows):
    return spark.createDataFrame([(k, v, v, None, None) for k, v in rows], HUB)


def test_incremental_hard_delete_needs_the_keys_that_still_exist(spark):
    tgt, inc = _hub(spark, [(k, "a") for k in range(1, 6)]), _hub(spark, [(1, "b")])
    cfg = dict(src_system="e", src_tbl="s", tgt_tbl="t", load_strategy="SCD1", merge_keys=("k",), hash_col="h",
               hard_delete=True, source_sql="FULL", incremental_sql="INC")
    with pytest.raises(ValueError, match="delete_sql"):
        load.run_load(spark, load.LoadConfig(**cfg), tgt, inc)
    there = spark.createDataFrame([(1,), (2,), (4,)], "k int")
    res = load.run_load(spark, load.LoadConfig(**cfg, delete_sql="KEYS"), tgt, inc, delete_source=there)
    assert sorted((r.k, r.v) for r in res.target.collect()) == [(1, "b"), (2, "a"), (4, "a")]


def test_truncate_keeps_every_source_row(spark):
    tgt, src = _hub(spark, [(9, "old")]), _hub(spark, [(1, "a"), (1, "b"), (2, "c")])
    for keys in ((), ("k",)):
        cfg = load.LoadConfig("e", "s", "t", "truncate", merge_keys=keys)
        res = load.run_load(spark, cfg, tgt, src)
        assert sorted((r.k, r.v) for r in res.target.collect()) == [(1, "a"), (1, "b"), (2, "c")]
        assert res.audit.first().src_data_count == 3


def test_failed_load_is_audited_with_the_whole_error(spark):
    notes = []

    def write(df):
        raise RuntimeError("disk " + "x" * 500)

    with pytest.raises(RuntimeError):
        load.execute_load(spark, load.LoadConfig("e", "s", "t", "truncate"), _hub(spark, []), write, notes.append,
                          source=_hub(spark, [(1, "a")]))
    last = notes[-1].first()
    assert [n.first().status for n in notes] == ["running", "failed"] and last.error == "RuntimeError: disk " + "x" * 500


def test_config_from_row():
    row = {"src_system": "erp", "src_tbl": "lake.a", "tgt_tbl": "hub.a", "load_strategy": "scd1",
           "tgt_merge_col_nm": "K1, K2", "src_select_logic_sql": "FULL", "batch_sql_query": "INC",
           "src_delete_query": "KEYS", "tgt_delete_filter_condition": "TGT.site = 'A'", "hard_delete_required": "y",
           "tgt_merge_filter_condition": "tgt.site = 'A' and src.x = 1", "src_merge_filter_condition": " ",
           "post_sql_query": "SELECT ';'", "post_sql_flag": "Y", "pre_sql_query": "SELECT 1", "pre_sql_flag": "N"}
    cfg = load.config_from_row(row, hash_col="md5")
    assert cfg.merge_keys == ("K1", "K2") and cfg.source_sql == "FULL" and cfg.incremental and cfg.hard_delete
    assert cfg.delete_filter == "site = 'A'" and cfg.tgt_filter == "site = 'A' and x = 1" and cfg.src_filter is None
    assert cfg.post_sql == ("SELECT ';'",) and cfg.pre_sql == ()
    with pytest.raises(ValueError):
        load.config_from_row({**row, "tgt_tbl": ""}, hash_col="md5")


def test_load_files_isolates_failures():
    seen = []

    def one(f):
        if "bad" in f:
            raise RuntimeError("broken file")
        seen.append(f)

    out = load.load_files(["a.csv", "bad.csv", "c.csv"], one)
    assert [s for _, s, _ in out] == ["completed", "failed", "completed"] and seen == ["a.csv", "c.csv"]


def test_sources_roundtrip(spark, tmp_shared):
    path = os.path.join(tmp_shared, "mapping.csv")
    with open(path, "w") as f:
        f.write("source_table,source_column,target_table,target_column\nl,a,t,b\n")
    m = io.read_mapping(spark, path)
    assert [tuple(r) for r in m.collect()] == [("l", "a", "t", "b")]
    bad = os.path.join(tmp_shared, "bad.csv")
    with open(bad, "w") as f:
        f.write("source_table,source_column\nl,a\n")
    with pytest.raises(ValueError):
        io.read_mapping(spark, bad)
    turned = os.path.join(tmp_shared, "turned.csv")
    with open(turned, "w") as f:
        f.write("Target_Column, source_table,note,source_column,target_table\nb,l,x,a,t\n")
    assert [tuple(r) for r in io.read_mapping(spark, turned).collect()] == [("l", "a", "t", "b")]
    keys = spark.createDataFrame([("orders", "o_orderkey", "o_custkey")], "table_name string, pk string, eid string")
    assert io.table_keys(keys, " ORDERS")["pk"] == "o_orderkey"
    assert io.clamp_partitions(1) == 4 and io.clamp_partitions(50) == 20 and io.clamp_partitions(9) == 9


def test_jdbc_scan_in_ranges():
    src = io.Source("jdbc", "t", partition_column="id", lower=0, upper=1000, partitions=8)
    assert io.jdbc_ranges(src) == {"partitionColumn": "id", "lowerBound": "0", "upperBound": "1000",
                                   "numPartitions": "8"}
    assert io.jdbc_ranges(io.Source("jdbc", "t")) == {}
    with pytest.raises(ValueError):
        io.jdbc_ranges(io.Source("jdbc", "t", partition_column="id"))


def test_read_schema_lists_catalog_tables(spark):
    spark.range(3).createOrReplaceGlobalTempView("ll_schema_probe")
    frames = io.read_schema(spark, "global_temp")
    assert "ll_schema_probe" in frames and frames["ll_schema_probe"].count() == 3


def test_write_all_reports_failures(spark, tmp_shared):
    spark.range(1).write.parquet(os.path.join(tmp_shared, "exists"))
    frames = {"ok": spark.range(3), "dup": spark.range(2)}
    sinks = {"ok": io.Source("parquet", os.path.join(tmp_shared, "ok")),
             "dup": io.Source("parquet", os.path.join(tmp_shared, "exists"))}
    rep = io.write_all(frames, sinks, mode="errorifexists", raise_on_failure=False)
    assert len(rep.succeeded) == 1 and len(rep.failed) == 1
    with pytest.raises(RuntimeError):
        io.write_all({"x": spark.range(1)}, {"x": io.Source("parquet", os.path.join(tmp_shared, "ok"))},
                     mode="errorifexists")


def test_bill_cases(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = [
        (1, 1, 2, t0, t0 + dt.timedelta(minutes=30)),             # 0.5 h rounds to 0 (half-even)
        (2, 1, 3, t0, t0 + dt.timedelta(minutes=90)),             # 1.5 h → 2, 3 bikes → 30 % off
        (3, 1, 5, t0, t0 + dt.timedelta(hours=25)),               # 25 h: whole days ignored → 1 h
        (4, 2, 6, t0, t0 + dt.timedelta(days=3, hours=5)),        # 3 days, no discount
        (5, 3, 2, t0, t0 + dt.timedelta(days=11)),                # 11/7 → 2 weeks
        (6, 1, 2, None, t0),                                       # no start
        (7, 4, 2, t0, t0 + dt.timedelta(hours=2)),                 # unknown basis
        (8, 2, 0, t0, t0 + dt.timedelta(days=2)),                  # 0 bikes
    ]
    df = spark.createDataFrame(rows, "id int, basis int, bikes int, s timestamp, e timestamp")
    got = {r.id: r.b for r in df.select("id", billing.bill("s", "e", "basis", "bikes").alias("b")).collect()}
    assert got == {1: 0.0, 2: 2 * 5 * 3 * 0.7, 3: 1 * 5 * 5 * 0.7, 4: 3 * 20 * 6.0, 5: 2 * 60 * 2.0,
                   6: None, 7: None, 8: None}
    full = df.filter("id = 3").select(billing.bill("s", "e", "basis", "bikes", full_hours=True).alias("b")).first().b
    assert full == 25 * 5 * 5 * 0.7


def test_stock_ledger_flags_negative(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, 4, t0, t0 + dt.timedelta(hours=5)), (2, 3, t0 + dt.timedelta(hours=1), t0 + dt.timedelta(hours=2)),
            (3, -1, t0, None), (4, 2, t0 + dt.timedelta(hours=5), None)]
    df = spark.createDataFrame(rows, "rental_id int, bikes int, rented_at timestamp, returned_at timestamp")
    led = billing.stock_ledger(df, 5, chunks=3).orderBy("moved_at", "rental_id").collect()
    assert [(r.rental_id, r.movement, r.stock, r.below_zero) for r in led] == [
        (1, "rent", 1, False), (2, "rent", -2, True), (2, "return", 1, False),
        (1, "return", 5, False), (4, "rent", 3, False)]


def test_missing_parameters_reads_every_config_row(spark, tmp_path):
    from ledgerline.catalog import q_coverage as q
    spark.range(250).selectExpr("id AS n_nationkey", "concat('n', id) AS n_name", "id % 5 AS n_regionkey").write.parquet(
        str(tmp_path / "nation.parquet"))
    rows = q.quality_missing_parameters(spark, str(tmp_path)).collect()
    assert len(rows) == 250 and sum(r["accepted"] for r in rows) == 200


def test_loads_count_in_the_pass_that_writes(spark):
    """No second scan of the source, no copy of it, for the count of the audit."""
    source = spark.createDataFrame([(1, "a", "h1"), (1, "b", "h2"), (2, "c", "h3")], "k int, v string, h string")
    target = spark.createDataFrame([(1, "o", "h0", 5), (9, "o", "h0", 5)], "k int, v string, h string, own int")
    for strategy, want in (("SCD1", [(1, "b", "h2", 5), (2, "c", "h3", None)]), ("merge", None),
                           ("OVERWRITE", None), ("TRUNCATE", None)):
        read = spark.sparkContext.accumulator(0)

        def seen(it, read=read):
            for b in it:
                read.add(b.num_rows)
                yield b
        cfg = load.LoadConfig("s", "t", "u", strategy, merge_keys=("k",), hash_col="h", hard_delete=strategy == "SCD1")
        rows = source.mapInArrow(seen, source.schema)
        kept, notes = [], []
        res = load.execute_load(spark, cfg, target, lambda df: kept.extend(df.collect()), notes.append, source=rows)
        assert [n.first().src_data_count for n in notes] == [None, 3] and read.value == 3, strategy
        if want:
            assert sorted(kept) == want and res.counts["update"] == 1 and res.counts["insert"] == 1
        if strategy in ("OVERWRITE", "TRUNCATE"):
            assert sorted(kept) == [(1, "a", "h1", None), (1, "b", "h2", None), (2, "c", "h3", None)]


def test_config_frame_and_config_row_agree(spark):
    """What is missing by the expression is what a LoadConfig refuses."""
    import itertools
    columns = ["src_system", "tgt_tbl", "load_strategy", "tgt_merge_col_nm", "hard_delete_required", "src_incr_query",
               "src_delete_query"]
    choices = [["erp", " "], ["hub.t", None], ["scd1", "OVERWRITE", "merge", None], ["k", " , "], ["Y", "N"], ["SELECT 1", None],
               ["SELECT 2", ""]]
    rows = [dict(zip(columns, r), src_tbl="t") for r in itertools.product(*choices)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{c} string" for c in rows[0]))
    for hash_col, full in (("h", False), (None, False), ("h", True)):
        got = load.missing_parameters(df, hash_col, full).collect()
        for row, r in zip(rows, got):
            try:
                load.config_from_row(row, hash_col=hash_col, full_load=full)
                assert r["missing"] == [], (row, r["missing"])
            except ValueError as e:
                assert r["missing"] and (r["missing"] == ["delete_sql"] or all(m in str(e) for m in set(r["missing"]) - {"delete_sql"}))
