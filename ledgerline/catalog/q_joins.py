"""Join operators on the driver tables (J-1 … J-12, F13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.catalog import register
from ledgerline.operators import clean, joins, quality
from ledgerline.session import table


@register("join_inner", """
SELECT o.o_orderkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def join_inner(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select("o_orderkey", "c_name")


@register("join_left", """
SELECT s.s_suppkey, n.n_name FROM supplier s
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey + 3""")
def join_left(spark, d):
    s = table(spark, d, "supplier")
    n = table(spark, d, "nation")           # shifted keys: some suppliers find no nation
    return s.join(n, s.s_nationkey == n.n_nationkey + 3, "left").select("s_suppkey", "n_name")


@register("join_left_composite", """
SELECT l.l_orderkey, l.l_linenumber, p.n_lines
FROM lineitem l LEFT JOIN (
  SELECT l_partkey + 1 AS l_partkey, l_suppkey, COUNT(*) AS n_lines FROM lineitem GROUP BY l_partkey, l_suppkey) p
ON l.l_partkey = p.l_partkey AND l.l_suppkey = p.l_suppkey""")
def join_left_composite(spark, d):
    li = table(spark, d, "lineitem")
    ps = li.groupBy((F.col("l_partkey") + 1).alias("l_partkey"), "l_suppkey") \
           .agg(F.count(F.lit(1)).alias("n_lines"))
    return li.join(ps, ["l_partkey", "l_suppkey"], "left").select("l_orderkey", "l_linenumber", "n_lines")


@register("join_broadcast_dimension", """
SELECT o.o_orderkey, n.n_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def join_broadcast_dimension(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    n = table(spark, d, "nation")
    return o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey) \
            .select("o_orderkey", "n_name")


@register("join_anti", """
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey * 2 = c.c_custkey)""")
def join_anti(spark, d):
    c = table(spark, d, "customer")
    o = table(spark, d, "orders")
    return joins.anti(c, o.select((F.col("o_custkey") * 2).alias("c_custkey")), ["c_custkey"]) \
                .select("c_custkey", "c_name")


_EK = "CASE WHEN event_type = 'error' THEN NULL ELSE event_type END"


@register("join_null_safe", f"""
WITH e AS (SELECT event_id, {_EK} AS k FROM events),
g AS (SELECT k, COUNT(*) AS n_same FROM e GROUP BY k)
SELECT e.event_id, g.n_same FROM e JOIN g ON e.k IS NOT DISTINCT FROM g.k""")
def join_null_safe(spark, d):
    e = table(spark, d, "events").select("event_id", F.expr(_EK).alias("k"))
    g = e.groupBy("k").agg(F.count(F.lit(1)).alias("n_same"))
    return e.join(g, joins.null_safe_on(e, g, ["k"]), "inner").select("event_id", "n_same")


@register("join_case_insensitive", """
WITH b AS (SELECT upper(p_brand) AS brand_uc, COUNT(*) AS n_parts FROM part GROUP BY upper(p_brand))
SELECT p.p_partkey, b.n_parts FROM part p
JOIN b ON lower(p.p_brand) IS NOT DISTINCT FROM lower(b.brand_uc)""")
def join_case_insensitive(spark, d):
    p = table(spark, d, "part")
    b = p.groupBy(F.upper("p_brand").alias("p_brand")) \
         .agg(F.count(F.lit(1)).alias("n_parts"))
    return p.join(b, joins.null_safe_on(p, b, ["p_brand"], ci=True), "inner").select("p_partkey", "n_parts")


@register("join_trim_key", """
WITH r AS (SELECT '  ' || CAST(r_regionkey AS VARCHAR) || ' ' AS padded_key, r_name FROM region)
SELECT n.n_nationkey, r.r_name FROM nation n
LEFT JOIN r ON trim(CAST(n.n_regionkey AS VARCHAR)) = trim(r.padded_key)""")
def join_trim_key(spark, d):
    n = table(spark, d, "nation")
    r = table(spark, d, "region").select(
        F.concat(F.lit("  "), F.col("r_regionkey").cast("string"), F.lit(" ")).alias("padded_key"), "r_name")
    return joins.join_trim(n, r, "n_regionkey", "padded_key").select("n_nationkey", "r_name")


@register("join_reconcile", """
WITH a AS (SELECT DISTINCT c_custkey AS k FROM customer),
b AS (SELECT DISTINCT o_custkey * 2 AS k FROM orders)
SELECT COALESCE(a.k, b.k) AS c_custkey,
  CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN 'both' WHEN a.k IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS side
FROM a FULL OUTER JOIN b ON a.k = b.k""")
def join_reconcile(spark, d):
    c = table(spark, d, "customer")
    o = table(spark, d, "orders").select((F.col("o_custkey") * 2).alias("o_custkey"))
    return quality.reconcile(c, o, "c_custkey", "o_custkey")


@register("join_coalesce_default", """
SELECT o.o_orderkey, c.nation, c.n_customers FROM
  (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey % 30 END AS k FROM orders) o
JOIN (SELECT CASE WHEN c_nationkey = 4 THEN NULL ELSE c_nationkey END AS nation, COUNT(*) AS n_customers
      FROM customer GROUP BY 1) c
ON COALESCE(CAST(o.k AS VARCHAR), '-1') = COALESCE(CAST(c.nation AS VARCHAR), '-1')""")
def join_coalesce_default(spark, d):
    """NULL keys meet NULL keys; the right side has one row per key, so the result stays linear."""
    o = table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", (F.col("o_custkey") % 30).cast("int")).alias("k"))
    c = table(spark, d, "customer").groupBy(F.when(F.col("c_nationkey") != 4, F.col("c_nationkey")).alias("nation")) \
        .agg(F.count(F.lit(1)).alias("n_customers"))
    on = joins.null_safe_on(o, c, ["k"], mapping={"k": "nation"}, default="-1")
    return o.join(c, on).select("o_orderkey", "nation", "n_customers")


@register("join_resolve_keys", """
SELECT l.l_orderkey, l.l_linenumber,
  COALESCE(CAST(p.p_partkey AS VARCHAR), '-1') AS part_key,
  COALESCE(CAST(s.s_suppkey AS VARCHAR), '-1') AS supplier_key,
  COALESCE(CAST(o.o_orderkey AS VARCHAR), '-1') AS order_key
FROM lineitem l
LEFT JOIN (SELECT DISTINCT p_partkey FROM part) p ON l.l_partkey = p.p_partkey * 2
LEFT JOIN (SELECT DISTINCT s_suppkey FROM supplier) s ON l.l_suppkey = s.s_suppkey + 2
LEFT JOIN (SELECT DISTINCT o_orderkey FROM orders) o ON l.l_orderkey = o.o_orderkey * 3""")
def join_resolve_keys(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    p = table(spark, d, "part").select("p_partkey", (F.col("p_partkey") * 2).alias("code"))
    s = table(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") + 2).alias("code"))
    o = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") * 3).alias("code"))
    out = joins.resolve_keys(li, [(p, "l_partkey", "code", "p_partkey", "part_key"),
                                  (s, "l_suppkey", "code", "s_suppkey", "supplier_key"),
                                  (o, "l_orderkey", "code", "o_orderkey", "order_key")])
    return out.select("l_orderkey", "l_linenumber", "part_key", "supplier_key", "order_key")


@register("filter_prefilter_semi", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def filter_prefilter_semi(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    keys = table(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING") \
                                      .select(F.col("c_custkey").alias("o_custkey"))
    return clean.prefilter(o, keys, ["o_custkey"])
