"""Aggregation, windows, sort/limit, set operations and quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.catalog import register
from ledgerline.operators import dedupe, quality, windows
from ledgerline.session import table


@register("agg_distinct", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def agg_distinct(spark, d):
    return table(spark, d, "orders").select("o_custkey", "o_orderstatus").distinct()


@register("agg_duplicates", """
SELECT o_custkey, o_orderstatus, COUNT(*) AS n FROM orders GROUP BY o_custkey, o_orderstatus HAVING COUNT(*) > 1""")
def agg_duplicates(spark, d):
    return quality.duplicates(table(spark, d, "orders"), ["o_custkey", "o_orderstatus"])


@register("agg_profile", """
SELECT 'customer' AS table_name, COUNT(DISTINCT c_custkey) AS distinct_keys, COUNT(*) AS row_count FROM customer
UNION ALL
SELECT 'orders', COUNT(DISTINCT o_custkey), COUNT(*) FROM orders""")
def agg_profile(spark, d):
    return quality.profile({"customer": table(spark, d, "customer"), "orders": table(spark, d, "orders")},
                           {"customer": "c_custkey", "orders": "o_custkey"})


@register("agg_latest_per_key", """
SELECT o_custkey, o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS total FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1""")
def agg_latest_per_key(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate",
                                         F.col("o_totalprice").cast("decimal(18,2)").alias("total"))
    return dedupe.latest(o, ["o_custkey"], ["o_orderdate"], tiebreak=["o_orderkey"]).drop("o_orderdate")


@register("agg_latest_window", """
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY COALESCE(ts, TIMESTAMP '1900-01-01') DESC, event_id DESC) rn
  FROM events) WHERE rn = 1""")
def agg_latest_window(spark, d):
    e = table(spark, d, "events")
    order = [F.coalesce("ts", F.lit("1900-01-01").cast("timestamp")).desc(), F.col("event_id").desc()]
    return dedupe.latest_window(e, ["user_id"], order).select("user_id", "event_id", "event_type")


@register("window_running_value", """
SELECT event_id, user_id,
  CAST(SUM(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_cents
FROM events""")
def window_running_value(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts",
                                         F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    out = windows.running_sum(e, ["user_id"], ["ts", "event_id"], "cents", "running_cents")
    return out.select("event_id", "user_id", F.col("running_cents").cast("bigint").alias("running_cents"))


@register("window_lag", """
SELECT event_id, LAG(event_type, 1) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_type FROM events""")
def window_lag(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    return windows.previous_value(e, ["user_id"], ["ts", "event_id"], "event_type", "previous_type") \
                  .select("event_id", "previous_type")


_NULLS = """SELECT event_id, ts, CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id % 5 END AS k,
  CASE WHEN event_id % 4 < 2 OR user_id % 5 = 1 AND event_id < 400 THEN NULL
       ELSE CAST(round(value * 100) AS BIGINT) END AS cents FROM events"""


def _with_nulls(spark, d):
    u, i = F.col("user_id"), F.col("event_id")
    return table(spark, d, "events").select(
        "event_id", "ts", F.when(u % 3 != 0, u % 5).alias("k"),
        F.when(~((i % 4 < 2) | ((u % 5 == 1) & (i < 400))), F.round(F.col("value") * 100).cast("bigint")).alias("cents"))


@register("window_running_nulls", f"""
SELECT event_id, k, CAST(SUM(cents) OVER (PARTITION BY k ORDER BY ts, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_cents FROM ({_NULLS})""")
def window_running_nulls(spark, d):
    out = windows.running_sum(_with_nulls(spark, d), ["k"], ["ts", "event_id"], "cents", "running_cents")
    return out.select("event_id", "k", F.col("running_cents").cast("bigint").alias("running_cents"))


@register("window_lag_nulls", f"""
SELECT event_id, k, LAG(cents, 1) OVER (PARTITION BY k ORDER BY ts, event_id) AS previous_cents FROM ({_NULLS})""")
def window_lag_nulls(spark, d):
    return windows.previous_value(_with_nulls(spark, d), ["k"], ["ts", "event_id"], "cents", "previous_cents") \
                  .select("event_id", "k", "previous_cents")


_AUDIT_SQL = """
audit AS (SELECT 'hub.events' AS tgt_tbl_nm, 'lake.events' AS src_tbl_nm, CAST(user_id AS VARCHAR) AS src_system,
            CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS batch_id,
            CASE WHEN event_type IN ('error', 'signup') THEN 'failed' ELSE 'completed' END AS status
          FROM events)"""


def audit_from_events(spark, d):
    e = table(spark, d, "events")
    return e.select(F.lit("hub.events").alias("tgt_tbl_nm"), F.lit("lake.events").alias("src_tbl_nm"),
                    F.col("user_id").cast("string").alias("src_system"),
                    F.date_format("ts", "yyyyMMdd").cast("bigint").alias("batch_id"),
                    F.when(F.col("event_type").isin("error", "signup"), "failed").otherwise("completed")
                     .alias("status"))


@register("quality_failed_twice", f"""
WITH {_AUDIT_SQL},
b AS (SELECT tgt_tbl_nm, src_tbl_nm, src_system, batch_id, min(status) AS batch_status
      FROM audit GROUP BY ALL),
t AS (SELECT *, row_number() OVER (PARTITION BY tgt_tbl_nm, src_tbl_nm, src_system ORDER BY batch_id DESC) AS rn FROM b)
SELECT tgt_tbl_nm, src_tbl_nm, src_system,
  CAST(SUM(CASE WHEN batch_status = 'failed' THEN 1 ELSE 0 END) AS INTEGER) AS failed_in_last_two,
  max(batch_id) AS last_batch_id,
  SUM(CASE WHEN batch_status = 'failed' THEN 1 ELSE 0 END) = 2 AS failed_twice
FROM t WHERE rn <= 2 GROUP BY ALL""")
def quality_failed_twice(spark, d):
    return quality.failed_twice(audit_from_events(spark, d))


@register("quality_missing_keys", """
SELECT DISTINCT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey * 2 FROM orders)""")
def quality_missing_keys(spark, d):
    o = table(spark, d, "orders").select((F.col("o_custkey") * 2).alias("o_custkey"))
    return quality.missing_keys(table(spark, d, "customer"), o, "c_custkey", "o_custkey")


@register("quality_probe_names", """
SELECT c_name, CAST(length(c_name) AS INTEGER) AS name_length, ascii(substr(c_name, 1, 1)) AS first_char_code,
  lower(trim(c_name)) IN ('customer#000000001', 'customer#000000010') AS matches_list
FROM customer""")
def quality_probe_names(spark, d):
    return quality.probe_names(table(spark, d, "customer"), "c_name",
                               [" Customer#000000001", "CUSTOMER#000000010 "])


@register("sort_top_k", """
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS total FROM orders
ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 10""")
def sort_top_k(spark, d):
    o = table(spark, d, "orders")
    return o.orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey").desc()).limit(10) \
            .select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("total"))


@register("set_union_by_name", """
SELECT CAST(s_suppkey AS VARCHAR) AS entity_key, 'supplier' AS kind FROM supplier
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'customer' FROM customer
UNION ALL SELECT 'firm', 'firm'""")
def set_union_by_name(spark, d):
    s = table(spark, d, "supplier").select(F.lit("supplier").alias("kind"),
                                           F.col("s_suppkey").cast("string").alias("entity_key"))
    c = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("entity_key"),
                                           F.lit("customer").alias("kind"))
    firm = spark.range(1).select(F.lit("firm").alias("entity_key"), F.lit("firm").alias("kind"))
    return s.unionByName(c).unionByName(firm)


@register("set_union_missing_columns", """
SELECT CAST(s_suppkey AS VARCHAR) AS contact_key, s_name AS contact_name, CAST(NULL AS VARCHAR) AS contact_title FROM supplier
UNION ALL SELECT CAST(conv_id AS VARCHAR), role, CAST(turn AS VARCHAR) FROM conversations""")
def set_union_missing_columns(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("contact_key"),
                                           F.col("s_name").alias("contact_name"))
    c = table(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("contact_key"),
                                                F.col("role").alias("contact_name"),
                                                F.col("turn").cast("string").alias("contact_title"))
    return s.unionByName(c, allowMissingColumns=True)
