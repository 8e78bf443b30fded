"""Upsert, SCD1 merge, update-only merge, hard delete and incremental loads
on the driver tables.  ``as_of`` is a fixed literal so results are stable."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.catalog import register
from ledgerline.functions.keys import change_hash
from ledgerline.operators import incremental, merge
from ledgerline.session import table

AS_OF = "2024-06-01 00:00:00"


def _as_of():
    return F.lit(AS_OF).cast("timestamp")


# --- U1-U6 load-flag upsert ---------------------------------------------------------

_UPSERT_SQL = f"""
tgt AS (
  SELECT CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN -c_custkey ELSE c_custkey END AS c_custkey, c_name, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment,
    CASE WHEN c_acctbal > 0 THEN true WHEN c_acctbal < -500 THEN NULL ELSE false END AS is_active,
    'seed' AS created_by, 'seed' AS last_updated_by,
    TIMESTAMP '2024-01-01 00:00:00' AS last_updated_date
  FROM customer),
src AS (
  SELECT c_custkey, upper(c_name) AS c_name, CAST(c_acctbal + 1 AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment,
    CASE WHEN c_acctbal > 9000 THEN NULL ELSE c_acctbal > 100 END AS is_active,
    'loader' AS created_by,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal >= 0 THEN 'I'
         WHEN c_mktsegment = 'HOUSEHOLD' THEN 'U'
         WHEN c_mktsegment = 'BUILDING' THEN 'i'
         WHEN c_mktsegment = 'MACHINERY' THEN 'U'
         WHEN c_mktsegment = 'AUTOMOBILE' THEN ' u'
         WHEN c_acctbal > 5000 THEN 'x' END AS load_flag
  FROM customer),
j AS (
  SELECT s.c_custkey AS s_key, s.c_name AS s_name, s.c_acctbal AS s_bal, s.c_mktsegment AS s_seg,
    s.is_active AS s_active, s.created_by AS s_by, s.load_flag,
    t.c_custkey AS t_key, t.c_name AS t_name, t.c_acctbal AS t_bal, t.c_mktsegment AS t_seg,
    t.is_active AS t_active, t.created_by AS t_by, t.last_updated_by AS t_lub, t.last_updated_date AS t_lud,
    s.c_custkey IS NOT NULL AS sp, t.c_custkey IS NOT NULL AS tp
  FROM src s FULL OUTER JOIN tgt t ON s.c_custkey IS NOT DISTINCT FROM t.c_custkey),
cls AS (
  SELECT *, CASE
      WHEN sp AND tp AND upper(trim(load_flag)) = 'U' THEN 'update'
      WHEN sp AND NOT tp AND upper(trim(load_flag)) = 'I' THEN 'insert'
      WHEN sp AND NOT tp AND upper(trim(load_flag)) = 'U' THEN 'reject_update_unmatched'
      WHEN sp AND tp AND upper(trim(load_flag)) = 'I' THEN 'reject_insert_matched'
      WHEN sp THEN 'reject_unknown_flag' ELSE 'untouched' END AS outcome
  FROM j)"""


def _upsert(spark, d):
    c = table(spark, d, "customer")
    # households are in the target under other keys, so their source rows find no partner
    key = F.when(F.col("c_mktsegment") == "HOUSEHOLD", -F.col("c_custkey")).otherwise(F.col("c_custkey"))
    tgt = c.select(
        key.alias("c_custkey"), "c_name", F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"), "c_mktsegment",
        F.when(F.col("c_acctbal") > 0, True).when(F.col("c_acctbal") < -500, None).otherwise(False)
         .alias("is_active"),
        F.lit("seed").alias("created_by"), F.lit("seed").alias("last_updated_by"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("last_updated_date"))
    seg, bal = F.col("c_mktsegment"), F.col("c_acctbal")
    flag = (F.when((seg == "HOUSEHOLD") & (bal >= 0), "I").when(seg == "HOUSEHOLD", "U")
            .when(seg == "BUILDING", "i").when(seg == "MACHINERY", "U").when(seg == "AUTOMOBILE", " u")
            .when(bal > 5000, "x"))
    src = c.select("c_custkey", F.upper("c_name").alias("c_name"),
                   (bal + 1).cast("decimal(18,2)").alias("c_acctbal"), "c_mktsegment",
                   F.when(bal > 9000, None).otherwise(bal > 100).alias("is_active"),
                   F.lit("loader").alias("created_by"), flag.alias("load_flag"))
    return merge.upsert(src, tgt, ["c_custkey"], as_of=_as_of(), on_duplicates="keep")


@register("merge_upsert", f"""
WITH {_UPSERT_SQL}
SELECT CASE WHEN outcome = 'insert' THEN s_key ELSE t_key END AS c_custkey,
  CASE WHEN outcome IN ('update', 'insert') THEN s_name ELSE t_name END AS c_name,
  CASE WHEN outcome IN ('update', 'insert') THEN s_bal ELSE t_bal END AS c_acctbal,
  CASE WHEN outcome IN ('update', 'insert') THEN s_seg ELSE t_seg END AS c_mktsegment,
  CASE WHEN outcome IN ('update', 'insert') THEN s_active ELSE t_active END AS is_active,
  CASE WHEN outcome = 'insert' THEN s_by ELSE t_by END AS created_by,
  CASE WHEN outcome IN ('update', 'insert') THEN s_by ELSE t_lub END AS last_updated_by,
  strftime(CASE WHEN outcome IN ('update', 'insert') THEN TIMESTAMP '{AS_OF}' ELSE t_lud END, '%Y-%m-%d %H:%M:%S') AS last_updated_date
FROM cls WHERE tp OR outcome = 'insert'""")
def merge_upsert(spark, d):
    out = _upsert(spark, d).target
    return out.withColumn("last_updated_date", F.date_format("last_updated_date", "yyyy-MM-dd HH:mm:ss"))


@register("merge_upsert_report", f"""
WITH {_UPSERT_SQL}
SELECT outcome, COUNT(*) AS n FROM cls WHERE sp GROUP BY outcome""")
def merge_upsert_report(spark, d):
    return _upsert(spark, d).report


@register("merge_upsert_rejects", f"""
WITH {_UPSERT_SQL}
SELECT s_key AS c_custkey, s_name AS c_name, s_bal AS c_acctbal, s_seg AS c_mktsegment, s_active AS is_active,
  s_by AS created_by, load_flag, outcome AS reject_reason
FROM cls WHERE outcome LIKE 'reject%'""")
def merge_upsert_rejects(spark, d):
    return _upsert(spark, d).rejects


# --- U7 SCD1 merge with fingerprint ------------------------------------------------------

_SCD_SQL = f"""
tgt AS (
  SELECT CASE WHEN o_orderpriority = '5-LOW' THEN -o_orderkey ELSE o_orderkey END AS o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS total,
    md5(concat_ws('-', COALESCE(o_orderstatus, '*~+'), COALESCE(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '*~+'))) AS md5_key,
    o_orderdate AS aud_ld_dts, CAST(NULL AS TIMESTAMP) AS aud_upd_dts
  FROM orders),
src0 AS (
  SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
    CAST(o_totalprice AS DECIMAL(18,2)) AS total, o_orderdate AS aud_ld_dts, CAST(NULL AS TIMESTAMP) AS aud_upd_dts
  FROM orders),
src AS (SELECT *, md5(concat_ws('-', COALESCE(o_orderstatus, '*~+'), COALESCE(CAST(total AS VARCHAR), '*~+'))) AS md5_key FROM src0),
t2 AS (SELECT *, COALESCE(aud_ld_dts >= TIMESTAMP '1995-01-01', false) AS scope FROM tgt),
j AS (
  SELECT s.o_orderkey AS s_key, s.o_orderstatus AS s_status, s.total AS s_total, s.md5_key AS s_md5,
    t.o_orderkey AS t_key, t.o_orderstatus AS t_status, t.total AS t_total, t.md5_key AS t_md5,
    t.aud_ld_dts AS t_ld, t.aud_upd_dts AS t_upd, s.o_orderkey IS NOT NULL AS sp, t.o_orderkey IS NOT NULL AS tp
  FROM src s FULL OUTER JOIN t2 t ON s.o_orderkey IS NOT DISTINCT FROM t.o_orderkey AND t.scope),
cls AS (SELECT *, CASE WHEN sp AND tp AND s_md5 IS DISTINCT FROM t_md5 THEN 'update'
                       WHEN sp AND tp THEN 'unchanged' WHEN sp THEN 'insert' ELSE 'untouched' END AS outcome FROM j)"""


def _scd(spark, d):
    o = table(spark, d, "orders")
    total = F.col("o_totalprice").cast("decimal(18,2)")
    key = F.when(F.col("o_orderpriority") == "5-LOW", -F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
    tgt = o.select(
        key.alias("o_orderkey"), "o_orderstatus", total.alias("total"),
        change_hash(["o_orderstatus", total]).alias("md5_key"),
        F.col("o_orderdate").cast("timestamp").alias("aud_ld_dts"),
        F.lit(None).cast("timestamp").alias("aud_upd_dts"))
    status = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("X")).otherwise(F.col("o_orderstatus"))
    src = o.select("o_orderkey", status.alias("o_orderstatus"), total.alias("total"),
                   F.col("o_orderdate").cast("timestamp").alias("aud_ld_dts"),
                   F.lit(None).cast("timestamp").alias("aud_upd_dts"))
    src = src.withColumn("md5_key", change_hash(["o_orderstatus", "total"]))
    return merge.scd1_merge(src, tgt, ["o_orderkey"], "md5_key",
                            tgt_filter=F.col("aud_ld_dts") >= F.lit("1995-01-01").cast("timestamp"),
                            upd_col="aud_upd_dts", ld_col="aud_ld_dts", as_of=_as_of(), on_duplicates="keep")


@register("merge_scd1", f"""
WITH {_SCD_SQL}
SELECT CASE WHEN outcome = 'insert' THEN s_key ELSE t_key END AS o_orderkey,
  CASE WHEN outcome IN ('update', 'insert') THEN s_status ELSE t_status END AS o_orderstatus,
  CASE WHEN outcome IN ('update', 'insert') THEN s_total ELSE t_total END AS total,
  CASE WHEN outcome IN ('update', 'insert') THEN s_md5 ELSE t_md5 END AS md5_key,
  strftime(CASE WHEN outcome = 'insert' THEN TIMESTAMP '{AS_OF}' ELSE t_ld END, '%Y-%m-%d %H:%M:%S') AS aud_ld_dts,
  strftime(CASE WHEN outcome = 'update' THEN TIMESTAMP '{AS_OF}' WHEN outcome = 'insert' THEN NULL ELSE t_upd END, '%Y-%m-%d %H:%M:%S') AS aud_upd_dts
FROM cls""")
def merge_scd1(spark, d):
    out = _scd(spark, d).target
    return out.select("o_orderkey", "o_orderstatus", "total", "md5_key",
                      F.date_format("aud_ld_dts", "yyyy-MM-dd HH:mm:ss").alias("aud_ld_dts"),
                      F.date_format("aud_upd_dts", "yyyy-MM-dd HH:mm:ss").alias("aud_upd_dts"))


@register("merge_scd1_report", f"""
WITH {_SCD_SQL}
SELECT outcome, COUNT(*) AS n FROM cls WHERE sp GROUP BY outcome""")
def merge_scd1_report(spark, d):
    return _scd(spark, d).report


# --- U8 update-only merge, U9 hard delete, U11 inactive rows --------------------------------

@register("merge_update_only", """
WITH s AS (SELECT p_partkey * 2 AS p_partkey, CAST(p_retailprice + 10 AS DECIMAL(18,2)) AS price FROM part
           WHERE p_brand <> 'Brand#1')
SELECT p.p_partkey, p.p_brand, COALESCE(s.price, CAST(p.p_retailprice AS DECIMAL(18,2))) AS price
FROM part p LEFT JOIN s ON p.p_partkey = s.p_partkey""")
def merge_update_only(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_size",
                                       F.col("p_retailprice").cast("decimal(18,2)").alias("price"))
    src = p.select((F.col("p_partkey") * 2).alias("p_partkey"), "p_brand",
                   (F.col("price") + 10).cast("decimal(18,2)").alias("price"))
    out = merge.merge_update(src, p, ["p_partkey"], ["price"],
                             source_filter=F.col("p_brand") != "Brand#1")
    return out.select("p_partkey", "p_brand", "price")


@register("merge_hard_delete", """
SELECT c_custkey, c_mktsegment FROM customer c
WHERE c_mktsegment <> 'BUILDING'
   OR EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey * 2 = c.c_custkey)""")
def merge_hard_delete(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    src = table(spark, d, "orders").select((F.col("o_custkey") * 2).alias("c_custkey"))
    return merge.hard_delete(src, c, ["c_custkey"], scope=F.col("c_mktsegment") == "BUILDING")


@register("merge_inactive_lookup", """
SELECT l.l_orderkey, l.l_linenumber,
  COALESCE(CASE WHEN s.active = 'Y' THEN CAST(s.s_suppkey AS VARCHAR) ELSE '-1' END, '-1') AS supplier_key,
  CASE WHEN s.active = 'Y' THEN s.s_name END AS supplier_name
FROM lineitem l LEFT JOIN (
  SELECT s_suppkey, s_name, CASE WHEN s_acctbal < 0 THEN 'N' ELSE 'Y' END AS active FROM supplier) s
ON l.l_suppkey = s.s_suppkey""")
def merge_inactive_lookup(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    s = table(spark, d, "supplier").select(
        "s_suppkey", "s_name", F.when(F.col("s_acctbal") < 0, "N").otherwise("Y").alias("active"))
    j = li.join(s, li.l_suppkey == s.s_suppkey, "left")
    return j.select("l_orderkey", "l_linenumber",
                    F.coalesce(merge.inactive_to_null(F.col("s_suppkey").cast("string"), "active", replacement="-1"),
                               F.lit("-1")).alias("supplier_key"),
                    merge.inactive_to_null("s_name", "active").alias("supplier_name"))


# --- I1 incremental by change time -------------------------------------------------------

@register("incremental_changed_since", """
WITH job_log AS (
  SELECT 'erp' AS src_system, 'orders' AS src_tbl, 'hub.orders' AS tgt_tbl,
         max(o_orderdate) - INTERVAL 400 DAY AS batch_last_run_time FROM orders),
mark AS (SELECT COALESCE((SELECT max(batch_last_run_time) FROM job_log
                          WHERE src_system = 'erp' AND src_tbl = 'orders' AND tgt_tbl = 'hub.orders'),
                         TIMESTAMP '1900-01-01 00:00:00') AS m),
j AS (SELECT o.o_orderkey, c.c_custkey,
        CASE WHEN o.o_orderstatus = 'F' THEN o.o_orderdate + INTERVAL 30 DAY END AS o_upd, o.o_orderdate AS o_ld,
        CASE WHEN c.c_acctbal > 9000 THEN TIMESTAMP '1998-12-01 00:00:00' END AS c_upd, CAST(NULL AS TIMESTAMP) AS c_ld
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT o_orderkey, c_custkey FROM j
WHERE greatest(COALESCE(o_upd, o_ld, TIMESTAMP '1900-01-01 00:00:00'),
               COALESCE(c_upd, c_ld, TIMESTAMP '1900-01-01 00:00:00')) >= (SELECT m FROM mark)""")
def incremental_changed_since(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    job_log = o.agg(F.lit("erp").alias("src_system"), F.lit("orders").alias("src_tbl"),
                    F.lit("hub.orders").alias("tgt_tbl"),
                    (F.max(F.col("o_orderdate").cast("timestamp")) - F.expr("INTERVAL 400 DAYS"))
                    .alias("batch_last_run_time"))
    mark = incremental.last_run(job_log, "erp", "orders", "hub.orders")
    j = o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", "c_custkey",
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS"))
         .cast("timestamp").alias("o_upd"),
        F.col("o_orderdate").cast("timestamp").alias("o_ld"),
        F.when(F.col("c_acctbal") > 9000, F.lit("1998-12-01 00:00:00").cast("timestamp")).alias("c_upd"),
        F.lit(None).cast("timestamp").alias("c_ld"))
    return incremental.changed_since(j, [("o_upd", "o_ld"), ("c_upd", "c_ld")], mark) \
                      .select("o_orderkey", "c_custkey")


# --- I2 advance the job-log mark after a successful load -------------------------------------

@register("incremental_advance_log", """
WITH job_log AS (
  SELECT 'erp' AS src_system, 'orders' AS src_tbl, 'hub.orders' AS tgt_tbl,
         max(o_orderdate) - INTERVAL 400 DAY AS batch_last_run_time FROM orders
  UNION ALL
  SELECT 'erp', 'lineitem', 'hub.lineitem', max(l_shipdate) FROM lineitem)
SELECT src_system, src_tbl, tgt_tbl, strftime(batch_last_run_time, '%Y-%m-%d %H:%M:%S') AS batch_last_run_time
FROM job_log WHERE NOT (src_system = 'erp' AND src_tbl = 'orders' AND tgt_tbl = 'hub.orders')
UNION ALL
SELECT 'erp', 'orders', 'hub.orders', strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') FROM orders""")
def incremental_advance_log(spark, d):
    o, li = table(spark, d, "orders"), table(spark, d, "lineitem")
    log = o.agg(F.lit("erp").alias("src_system"), F.lit("orders").alias("src_tbl"), F.lit("hub.orders").alias("tgt_tbl"),
                (F.max(F.col("o_orderdate").cast("timestamp")) - F.expr("INTERVAL 400 DAYS")).alias("batch_last_run_time"))
    log = log.unionByName(li.agg(F.lit("erp").alias("src_system"), F.lit("lineitem").alias("src_tbl"),
                                 F.lit("hub.lineitem").alias("tgt_tbl"),
                                 F.max(F.col("l_shipdate").cast("timestamp")).alias("batch_last_run_time")))
    new_mark = o.agg(F.max(F.col("o_orderdate").cast("timestamp"))).scalar()
    out = incremental.advance(log, "erp", "orders", "hub.orders", new_mark)
    return out.withColumn("batch_last_run_time", F.date_format("batch_last_run_time", "yyyy-MM-dd HH:mm:ss"))


# --- T3 late changes, U6 duplicate source keys ------------------------------------------------

@register("merge_scd1_late_change", """
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE upper(c_name) || '!' END AS c_name,
       CASE WHEN c_custkey % 2 = 0 THEN 3 ELSE 2 END AS changed_at FROM customer""")
def merge_scd1_late_change(spark, d):
    """A at 1; A again at 3 for even keys; then B of 2: late for even keys, newer for odd ones."""
    c = table(spark, d, "customer")

    def change(name, at):
        return c.select("c_custkey", name.alias("c_name"), change_hash([name]).alias("md5_key"), at.cast("int").alias("changed_at"))

    name = F.col("c_name")
    now = change(name, F.lit(1))
    again = change(name, F.when(F.col("c_custkey") % 2 == 0, 3).otherwise(1))
    late = change(F.concat(F.upper("c_name"), F.lit("!")), F.lit(2))
    for step in (again, late):
        now = merge.scd1_merge(step, now, ["c_custkey"], "md5_key", ignore_older=True, guard_col="changed_at",
                               on_duplicates="keep").target
    return now.select("c_custkey", "c_name", "changed_at")


@register("merge_upsert_duplicates", """
WITH s AS (SELECT o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'U' ELSE 'I' END AS flag,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS nth FROM orders),
k AS (SELECT s.flag, t.c_custkey IS NOT NULL AS there FROM s
      LEFT JOIN (SELECT c_custkey * 2 AS c_custkey FROM customer) t ON s.o_custkey = t.c_custkey WHERE nth = 1)
SELECT CASE WHEN flag = 'U' AND there THEN 'update' WHEN flag = 'I' AND NOT there THEN 'insert'
            WHEN flag = 'U' THEN 'reject_update_unmatched' ELSE 'reject_insert_matched' END AS outcome, COUNT(*) AS n
FROM k GROUP BY 1
UNION ALL SELECT 'superseded', COUNT(*) FROM s WHERE nth > 1""")
def merge_upsert_duplicates(spark, d):
    """Many source rows per key: the outcomes add up to all of them."""
    src = table(spark, d, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderdate",
        F.when(F.col("o_orderstatus") == "F", "U").otherwise("I").alias("load_flag"))
    tgt = table(spark, d, "customer").select((F.col("c_custkey") * 2).alias("c_custkey"),
                                             F.lit(None).cast("bigint").alias("o_orderkey"))
    return merge.upsert(src, tgt, ["c_custkey"], as_of=_as_of(), order=["o_orderdate", "o_orderkey"]).report
