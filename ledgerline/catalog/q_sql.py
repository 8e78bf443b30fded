"""SQL surface (V1-V5) and config-driven loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.catalog import register
from ledgerline.functions.keys import change_hash
from ledgerline.plans import load
from ledgerline.session import scratch_path, table

AS_OF = "2024-06-01 00:00:00"


# --- V1-V3 --------------------------------------------------------------------------

@register("sql_temp_view_args", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""")
def sql_temp_view_args(spark, d):
    return spark.sql("SELECT o_orderkey, o_custkey FROM {orders} WHERE o_orderstatus = :status "
                     "AND o_orderpriority = :prio", args={"status": "F", "prio": "1-URGENT"},
                     orders=table(spark, d, "orders"))


@register("sql_cte_chain", """
WITH per_batch AS (
  SELECT user_id, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS batch_id,
         min(CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END) AS status
  FROM events GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY batch_id DESC) AS rn FROM per_batch),
last_two AS (SELECT * FROM ranked WHERE rn <= 2),
counted AS (SELECT user_id, SUM(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS n_failed FROM last_two GROUP BY user_id)
SELECT user_id, CAST(n_failed AS INTEGER) AS n_failed FROM counted""")
def sql_cte_chain(spark, d):
    return spark.sql("""
        WITH per_batch AS (
          SELECT user_id, CAST(date_format(ts, 'yyyyMMdd') AS BIGINT) AS batch_id,
                 min(CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END) AS status
          FROM {events} GROUP BY ALL),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY batch_id DESC) AS rn FROM per_batch),
        last_two AS (SELECT * FROM ranked WHERE rn <= 2),
        counted AS (SELECT user_id, SUM(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS n_failed
                    FROM last_two GROUP BY user_id)
        SELECT user_id, CAST(n_failed AS INT) AS n_failed FROM counted""", events=table(spark, d, "events"))


@register("sql_scalar_subquery", """
SELECT o_orderkey FROM orders
WHERE o_orderdate >= (SELECT max(o_orderdate) - INTERVAL 200 DAY FROM orders WHERE o_orderstatus = 'F')""")
def sql_scalar_subquery(spark, d):
    return spark.sql("""
        SELECT o_orderkey FROM {orders}
        WHERE o_orderdate >= (SELECT max(o_orderdate) - INTERVAL 200 DAYS FROM {orders} WHERE o_orderstatus = 'F')""",
                     orders=table(spark, d, "orders"))


# --- V5 / U12-U14: config-driven loads -----------------------------------------------------

def _hub_customer(spark, d):
    c = table(spark, d, "customer")
    key = F.when(F.col("c_mktsegment") == "HOUSEHOLD", -F.col("c_custkey")).otherwise(F.col("c_custkey"))
    return c.select(key.alias("c_custkey"), "c_name", "c_mktsegment",
                    change_hash(["c_name", "c_mktsegment"]).alias("md5_key"),
                    F.lit("2024-01-01 00:00:00").cast("timestamp").alias("AUD_LD_DTS"),
                    F.lit(None).cast("timestamp").alias("AUD_UPD_DTS"))


def _scd1_cfg(d):
    view = "lake_customer"
    return load.LoadConfig(
        src_system="erp", src_tbl=view, tgt_tbl="hub.customer", load_strategy="scd1",
        merge_keys=("c_custkey",), hash_col="md5_key", hard_delete=True, full_load=False,
        pre_sql=(f"CREATE OR REPLACE TEMP VIEW {view} AS SELECT * FROM parquet.`{d}/customer.parquet`",),
        source_sql=f"""SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN upper(c_name) ELSE c_name END AS c_name,
                         c_mktsegment,
                         md5(concat_ws('-', coalesce(CASE WHEN c_mktsegment = 'BUILDING' THEN upper(c_name) ELSE c_name END, '*~+'),
                                            coalesce(c_mktsegment, '*~+'))) AS md5_key,
                         CAST(NULL AS TIMESTAMP) AS AUD_LD_DTS, CAST(NULL AS TIMESTAMP) AS AUD_UPD_DTS
                       FROM {view} WHERE c_acctbal > -500""")


_SCD1_LOAD_SQL = f"""
tgt AS (SELECT CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN -c_custkey ELSE c_custkey END AS c_custkey, c_name, c_mktsegment,
          md5(concat_ws('-', COALESCE(c_name, '*~+'), COALESCE(c_mktsegment, '*~+'))) AS md5_key,
          TIMESTAMP '2024-01-01 00:00:00' AS ld, CAST(NULL AS TIMESTAMP) AS upd
        FROM customer),
src AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN upper(c_name) ELSE c_name END AS c_name, c_mktsegment
        FROM customer WHERE c_acctbal > -500),
src2 AS (SELECT *, md5(concat_ws('-', COALESCE(c_name, '*~+'), COALESCE(c_mktsegment, '*~+'))) AS md5_key FROM src),
j AS (SELECT s.c_custkey AS s_key, s.c_name AS s_name, s.c_mktsegment AS s_seg, s.md5_key AS s_md5,
        t.c_custkey AS t_key, t.c_name AS t_name, t.c_mktsegment AS t_seg, t.md5_key AS t_md5, t.ld, t.upd,
        s.c_custkey IS NOT NULL AS sp, t.c_custkey IS NOT NULL AS tp
      FROM src2 s FULL OUTER JOIN tgt t ON s.c_custkey IS NOT DISTINCT FROM t.c_custkey),
cls AS (SELECT *, CASE WHEN sp AND tp AND s_md5 IS DISTINCT FROM t_md5 THEN 'update' WHEN sp AND tp THEN 'unchanged'
                       WHEN sp THEN 'insert' ELSE 'untouched' END AS outcome FROM j),
merged AS (SELECT CASE WHEN outcome = 'insert' THEN s_key ELSE t_key END AS c_custkey,
             CASE WHEN outcome IN ('update', 'insert') THEN s_name ELSE t_name END AS c_name,
             CASE WHEN outcome IN ('update', 'insert') THEN s_seg ELSE t_seg END AS c_mktsegment,
             CASE WHEN outcome IN ('update', 'insert') THEN s_md5 ELSE t_md5 END AS md5_key,
             CASE WHEN outcome = 'insert' THEN TIMESTAMP '{AS_OF}' ELSE ld END AS aud_ld,
             CASE WHEN outcome = 'update' THEN TIMESTAMP '{AS_OF}' WHEN outcome = 'insert' THEN NULL ELSE upd END AS aud_upd
           FROM cls)"""


def _run_scd1(spark, d):
    return load.run_load(spark, _scd1_cfg(d), _hub_customer(spark, d), batch_id=7,
                         as_of=F.lit(AS_OF).cast("timestamp"))


@register("load_scd1_with_delete", f"""
WITH {_SCD1_LOAD_SQL}
SELECT c_custkey, c_name, c_mktsegment, md5_key, strftime(aud_ld, '%Y-%m-%d %H:%M:%S') AS aud_ld,
       strftime(aud_upd, '%Y-%m-%d %H:%M:%S') AS aud_upd
FROM merged WHERE c_custkey IN (SELECT c_custkey FROM src)""")
def load_scd1_with_delete(spark, d):
    t = _run_scd1(spark, d).target
    return t.select("c_custkey", "c_name", "c_mktsegment", "md5_key",
                    F.date_format("AUD_LD_DTS", "yyyy-MM-dd HH:mm:ss").alias("aud_ld"),
                    F.date_format("AUD_UPD_DTS", "yyyy-MM-dd HH:mm:ss").alias("aud_upd"))


@register("load_audit_row", f"""
SELECT CAST(7 AS BIGINT) AS batch_id, 'completed' AS status, 'erp' AS src_system, 'lake_customer' AS src_tbl_nm,
  'hub.customer' AS tgt_tbl_nm, 'MERGE' AS operation, COUNT(*) AS src_data_count,
  CAST(NULL AS VARCHAR) AS filter_condition, '{AS_OF}' AS audit_ts, CAST(NULL AS VARCHAR) AS error
FROM customer WHERE c_acctbal > -500""")
def load_audit_row(spark, d):
    a = _run_scd1(spark, d).audit
    return a.withColumn("audit_ts", F.date_format("audit_ts", "yyyy-MM-dd HH:mm:ss"))


def _hub_nation(spark, d):
    n = table(spark, d, "nation")
    return n.select("n_nationkey", "n_name", "n_regionkey",
                    F.lit("2024-01-01 00:00:00").cast("timestamp").alias("AUD_LD_DTS"),
                    F.lit(None).cast("timestamp").alias("AUD_UPD_DTS"))


@register("load_truncate", f"""
SELECT n_nationkey, n_name, n_regionkey, '2024-01-01 00:00:00' AS aud_ld FROM nation WHERE n_regionkey <> 1
UNION ALL
SELECT n_nationkey, upper(n_name), n_regionkey, '{AS_OF}' FROM nation WHERE n_regionkey = 1 AND n_nationkey <> 3""")
def load_truncate(spark, d):
    n = table(spark, d, "nation")
    src = n.filter((F.col("n_regionkey") == 1) & (F.col("n_nationkey") != 3)).select(
        "n_nationkey", F.upper("n_name").alias("n_name"), "n_regionkey",
        F.lit(None).cast("timestamp").alias("AUD_LD_DTS"), F.lit(None).cast("timestamp").alias("AUD_UPD_DTS"))
    cfg = load.LoadConfig(src_system="erp", src_tbl="nation", tgt_tbl="hub.nation", load_strategy="truncate",
                          merge_keys=("n_nationkey",), tgt_filter="n_regionkey = 1")
    res = load.run_load(spark, cfg, _hub_nation(spark, d), source=src, as_of=F.lit(AS_OF).cast("timestamp"))
    return res.target.select("n_nationkey", "n_name", "n_regionkey",
                             F.date_format("AUD_LD_DTS", "yyyy-MM-dd HH:mm:ss").alias("aud_ld"))


@register("load_overwrite_filtered", f"""
SELECT n_nationkey, n_name, n_regionkey, '2024-01-01 00:00:00' AS aud_ld FROM nation WHERE n_regionkey <> 2
UNION ALL
SELECT n_nationkey, lower(n_name), n_regionkey, '{AS_OF}' FROM nation WHERE n_regionkey = 2""")
def load_overwrite_filtered(spark, d):
    n = table(spark, d, "nation")
    src = n.filter(F.col("n_regionkey") == 2).select("n_nationkey", F.lower("n_name").alias("n_name"),
                                                      "n_regionkey")
    cfg = load.LoadConfig(src_system="erp", src_tbl="nation", tgt_tbl="hub.nation", load_strategy="overwrite",
                          tgt_filter="n_regionkey = 2")
    res = load.run_load(spark, cfg, _hub_nation(spark, d), source=src, as_of=F.lit(AS_OF).cast("timestamp"))
    return res.target.select("n_nationkey", "n_name", "n_regionkey",
                             F.date_format("AUD_LD_DTS", "yyyy-MM-dd HH:mm:ss").alias("aud_ld"))


# --- whole runs: delete source, duplicates, hooks after the write, audit, config rows -------------

def _hub_parts(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", "p_name", change_hash(["p_name"]).alias("md5_key"),
                    F.lit("2024-01-01 00:00:00").cast("timestamp").alias("AUD_LD_DTS"),
                    F.lit(None).cast("timestamp").alias("AUD_UPD_DTS"))


def _part_changes(spark, d):
    """Every part under a shifted key (half of the keys are new), with the name in capitals."""
    name = F.upper("p_name")
    return table(spark, d, "part").select(
        (F.col("p_partkey") * 2).alias("p_partkey"), name.alias("p_name"), change_hash([name]).alias("md5_key"),
        F.lit(None).cast("timestamp").alias("AUD_LD_DTS"), F.lit(None).cast("timestamp").alias("AUD_UPD_DTS"))


@register("load_incremental_hard_delete", """
WITH inc AS (SELECT p_partkey * 2 AS p_partkey, upper(p_name) AS p_name FROM part),
merged AS (SELECT COALESCE(i.p_partkey, p.p_partkey) AS p_partkey, COALESCE(i.p_name, p.p_name) AS p_name
           FROM part p FULL OUTER JOIN inc i ON p.p_partkey = i.p_partkey)
SELECT p_partkey, p_name FROM merged WHERE p_partkey IN (SELECT l_partkey FROM lineitem)""")
def load_incremental_hard_delete(spark, d):
    """The increment holds changed parts only; parts that no order line names any more are deleted."""
    cfg = load.LoadConfig(src_system="erp", src_tbl="part", tgt_tbl="hub.part", load_strategy="SCD1",
                          merge_keys=("p_partkey",), hash_col="md5_key", hard_delete=True,
                          source_sql="full", incremental_sql="changes", delete_sql="keys")
    there = table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    res = load.run_load(spark, cfg, _hub_parts(spark, d), source=_part_changes(spark, d), delete_source=there,
                        as_of=F.lit(AS_OF).cast("timestamp"))
    return res.target.select("p_partkey", "p_name")


@register("load_truncate_duplicates", f"""
SELECT l_orderkey, l_partkey, '{AS_OF}' AS aud_ld FROM lineitem""")
def load_truncate_duplicates(spark, d):
    """Truncate and load: every source row comes in, though many share an order key."""
    src = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    stamps = {c: F.lit(None).cast("timestamp") for c in ("AUD_LD_DTS", "AUD_UPD_DTS")}
    target = table(spark, d, "orders").select("o_orderkey", "o_custkey").toDF("l_orderkey", "l_partkey").withColumns(stamps)
    cfg = load.LoadConfig(src_system="erp", src_tbl="lineitem", tgt_tbl="hub.line", load_strategy="truncate",
                          merge_keys=("l_orderkey",))
    res = load.run_load(spark, cfg, target, source=src, as_of=F.lit(AS_OF).cast("timestamp"))
    return res.target.select("l_orderkey", "l_partkey",
                             F.date_format("AUD_LD_DTS", "yyyy-MM-dd HH:mm:ss").alias("aud_ld"))


def _written_run(spark, d, post_sql):
    path = scratch_path(spark, "load-supplier")
    src = table(spark, d, "supplier").select("s_suppkey", "s_name")
    target = src.withColumns({"AUD_LD_DTS": F.lit(None).cast("timestamp"),
                              "AUD_UPD_DTS": F.lit(None).cast("timestamp")})
    cfg = load.LoadConfig(src_system="erp", src_tbl="supplier", tgt_tbl="hub.supplier", load_strategy="truncate",
                          post_sql=tuple(s.format(path=path) for s in post_sql))
    notes = []
    try:
        load.execute_load(spark, cfg, target, lambda df: df.write.parquet(path), notes.append, source=src, batch_id=9,
                          as_of=F.lit(AS_OF).cast("timestamp"))
    except Exception:       # the audit holds it
        pass
    return notes


@register("load_post_sql_after_write", """
SELECT COUNT(*) AS n_written, MAX(s_suppkey) AS last_key FROM supplier""")
def load_post_sql_after_write(spark, d):
    _written_run(spark, d, ["CREATE OR REPLACE TEMP VIEW hub_supplier_written AS "
                            "SELECT COUNT(*) AS n_written, MAX(s_suppkey) AS last_key FROM parquet.`{path}`"])
    return spark.table("hub_supplier_written")


@register("load_failed_audit", """
SELECT CAST(9 AS BIGINT) AS batch_id, status, 'hub.supplier' AS tgt_tbl_nm, failed, n_suppliers
FROM (VALUES ('running', false), ('failed', true)) v(status, failed), (SELECT COUNT(*) AS n_suppliers FROM supplier)""")
def load_failed_audit(spark, d):
    notes = _written_run(spark, d, ["SELECT no_such_column FROM parquet.`{path}`"])
    rows = notes[0]
    for n in notes[1:]:
        rows = rows.unionByName(n)
    total = table(spark, d, "supplier").agg(F.count(F.lit(1))).scalar()
    return rows.select("batch_id", "status", "tgt_tbl_nm", F.col("error").isNotNull().alias("failed"),
                       total.alias("n_suppliers"))


@register("load_config_from_row", f"""
SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_regionkey <> 1
UNION ALL SELECT n_nationkey, upper(n_name), n_regionkey FROM nation WHERE n_regionkey = 1""")
def load_config_from_row(spark, d):
    row = {"src_system": "erp", "src_tbl": "nation", "tgt_tbl": "hub.nation", "load_strategy": "overwrite",
           "tgt_merge_col_nm": "N_NATIONKEY", "tgt_merge_filter_condition": "tgt.n_regionkey = 1",
           "src_merge_filter_condition": "src.n_regionkey = 1", "hard_delete_flag": "N", "post_sql_flag": "N",
           "src_truncate_query": f"SELECT n_nationkey, upper(n_name) AS n_name, n_regionkey "
                                 f"FROM parquet.`{d}/nation.parquet`"}
    res = load.run_load(spark, load.config_from_row(row), _hub_nation(spark, d))
    return res.target.select("n_nationkey", "n_name", "n_regionkey")
