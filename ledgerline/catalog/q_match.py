"""Fuzzy matching and routing (Z1-Z5) on the driver tables.

Profiles: entity = customer, three customers to a family; a family shares the
first thirteen letters of its (hashed) name and its tax id, so the pairs that
pass grow with the rows.  The source side has a typing error in every name.
The oracle scores every pair of each block by brute force.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.catalog import register
from ledgerline.operators import match
from ledgerline.session import table


def _profile(spark, d, key=None, typo=False):
    c = table(spark, d, "customer")
    family = F.floor(F.col("c_custkey") / 3).cast("bigint").cast("string")
    name = F.concat(F.substring(F.md5(family), 1, 13), (F.col("c_custkey") % 3).cast("string"))
    if typo:
        name = F.concat(F.substring(name, 1, 5), F.lit("~"), F.substring(name, 7, 8))
    return c.select((key if key is not None else F.col("c_custkey")).cast("string").alias("business_entity_id"),
                    name.alias("name"),
                    F.concat(F.lit("TAX-"), (F.floor(F.col("c_custkey") / 3).cast("bigint") % 25).cast("string"))
                    .alias("tax_id"),
                    F.col("c_mktsegment").alias("address"), F.col("c_nationkey").cast("string").alias("postal_code"))


def _profile_sql(key="c_custkey", typo=False):
    name = "substr(md5(CAST(CAST(floor(c_custkey / 3) AS BIGINT) AS VARCHAR)), 1, 13) || CAST(c_custkey % 3 AS VARCHAR)"
    if typo:
        name = f"substr({name}, 1, 5) || '~' || substr({name}, 7)"
    return f"""SELECT CAST({key} AS VARCHAR) AS k, {name} AS name,
      'TAX-' || CAST(CAST(floor(c_custkey / 3) AS BIGINT) % 25 AS VARCHAR) AS tax_id, c_mktsegment AS address,
      CAST(c_nationkey AS VARCHAR) AS pc FROM customer"""


@register("match_profile", """
WITH ids AS (SELECT CAST(s_suppkey AS VARCHAR) AS related_identifier, 'tax_id' AS identifier_type,
               CASE WHEN s_acctbal >= 0 THEN 'TAX-' || CAST(s_nationkey AS VARCHAR) END AS identifier_value FROM supplier
             UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'duns', 'D' || CAST(s_suppkey AS VARCHAR) FROM supplier),
addr AS (SELECT CAST(s.s_suppkey AS VARCHAR) AS related_identifier, 'Dock ' || CAST(s.s_suppkey AS VARCHAR) AS street_line_1,
               n.n_name AS city, CASE WHEN n.n_regionkey <> 1 THEN r.r_name END AS state_province,
               CAST(s.s_nationkey AS VARCHAR) AS postal_code
         FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT CAST(s.s_suppkey AS VARCHAR) AS business_entity_id, COALESCE(s.s_name, '') AS name,
  COALESCE(i.identifier_value, '') AS tax_id,
  COALESCE(concat_ws(':', COALESCE(a.street_line_1, ''), COALESCE(a.city, ''), COALESCE(a.state_province, '')), '') AS address,
  COALESCE(a.postal_code, '') AS postal_code
FROM supplier s
LEFT JOIN (SELECT DISTINCT related_identifier, identifier_value FROM ids WHERE identifier_type = 'tax_id') i
  ON CAST(s.s_suppkey AS VARCHAR) = i.related_identifier
LEFT JOIN addr a ON CAST(s.s_suppkey AS VARCHAR) = a.related_identifier""")
def match_profile(spark, d):
    s, n, r = table(spark, d, "supplier"), table(spark, d, "nation"), table(spark, d, "region")
    sid = F.col("s_suppkey").cast("string")
    details = s.select(sid.alias("business_entity_id"), F.col("s_name").alias("business_entity_name"))
    tax = s.select(sid.alias("related_identifier"), F.lit("tax_id").alias("identifier_type"),
                   F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("TAX-"), F.col("s_nationkey").cast("string")))
                   .alias("identifier_value"))
    duns = s.select(sid.alias("related_identifier"), F.lit("duns").alias("identifier_type"),
                    F.concat(F.lit("D"), sid).alias("identifier_value"))
    addr = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(
        sid.alias("related_identifier"), F.concat(F.lit("Dock "), sid).alias("street_line_1"),
        F.col("n_name").alias("city"),
        F.when(F.col("n_regionkey") != 1, F.col("r_name")).alias("state_province"),
        F.col("s_nationkey").cast("string").alias("postal_code"))
    return match.match_profile(details, tax.unionByName(duns), addr)


_SCORE = "1.0 - levenshtein(s.name, m.name) / length(s.name)"


@register("match_scores", f"""
WITH s AS ({_profile_sql(typo=True)}), m AS ({_profile_sql()})
SELECT s.k AS src_business_entity_id, m.k AS main_business_entity_id, s.tax_id, s.name AS src_name, m.name AS main_name,
  CAST(round({_SCORE}, 6) AS DECIMAL(10,6)) AS name_score, CAST(1.0 AS DOUBLE) AS tax_score,
  CAST(CASE WHEN s.pc = m.pc AND s.address = m.address THEN 1.0 ELSE 0.0 END AS DOUBLE) AS address_score
FROM s JOIN m ON s.tax_id = m.tax_id WHERE {_SCORE} >= 0.8""")
def match_scores(spark, d):
    s = match.match_scores(_profile(spark, d, typo=True), _profile(spark, d))
    return s.withColumn("name_score", F.round("name_score", 6).cast("decimal(10,6)"))


@register("match_flag_duplicates", f"""
WITH s AS ({_profile_sql(typo=True)}), m AS ({_profile_sql()})
SELECT s.k AS src_business_entity_id, COUNT(*) AS n_duplicates, CAST(round(max({_SCORE}), 6) AS DECIMAL(10,6)) AS best_score
FROM s JOIN m ON s.tax_id = m.tax_id WHERE {_SCORE} >= 0.9 GROUP BY s.k""")
def match_flag_duplicates(spark, d):
    scores = match.match_scores(_profile(spark, d, typo=True), _profile(spark, d), threshold=0.8)
    flagged = match.flag_duplicates(scores, 0.9).filter("is_duplicate")
    return flagged.groupBy("src_business_entity_id").agg(
        F.count(F.lit(1)).alias("n_duplicates"),
        F.round(F.max("name_score"), 6).cast("decimal(10,6)").alias("best_score"))


@register("match_drop_known", """
SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS business_entity_id FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey * 2 FROM customer)""")
def match_drop_known(spark, d):
    src = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("business_entity_id")).distinct()
    main = table(spark, d, "customer").select((F.col("c_custkey") * 2).cast("string").alias("business_entity_id"))
    return match.drop_known(src, main, "business_entity_id")


@register("match_route", f"""
WITH src AS ({_profile_sql(typo=True)}), main AS ({_profile_sql("c_custkey * 2")}),
known AS (SELECT k FROM src WHERE k IN (SELECT k FROM main)),
s AS (SELECT * FROM src WHERE k NOT IN (SELECT k FROM main) AND k NOT LIKE '%7'
      UNION ALL SELECT k, 'nobody ' || name, tax_id, address, pc FROM src WHERE k NOT IN (SELECT k FROM main) AND k LIKE '%7'),
sc AS (SELECT s.k, m.k AS mk, {_SCORE} AS ns, CASE WHEN s.pc = m.pc AND s.address = m.address THEN 1.0 ELSE 0.0 END AS ad
       FROM s JOIN main m ON s.tax_id = m.tax_id WHERE {_SCORE} >= 0.8),
best AS (SELECT k, mk, ns FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ns DESC, ad DESC, mk DESC) rn FROM sc)
         WHERE rn = 1)
SELECT k AS business_entity_id, 'update_known' AS route, k AS target_key, CAST(NULL AS DECIMAL(10,6)) AS name_score FROM known
UNION ALL
SELECT u.k, CASE WHEN b.mk IS NOT NULL THEN 'update_matched' ELSE 'insert' END, b.mk, CAST(round(b.ns, 6) AS DECIMAL(10,6))
FROM s u LEFT JOIN best b ON u.k = b.k""")
def match_route(spark, d):
    src = _profile(spark, d, typo=True)
    src = src.withColumn("name", F.when(F.col("business_entity_id").endswith("7"), F.concat(F.lit("nobody "), "name"))
                         .otherwise(F.col("name")))
    out = match.deduplicate(src, _profile(spark, d, key=F.col("c_custkey") * 2))
    return out.withColumn("name_score", F.round("name_score", 6).cast("decimal(10,6)"))


# --- names of one shared prefix (Customer#000000123), 25 blocks: most letters are the same in every name ---------

def _prefixed(spark, d, typo=False):
    c = table(spark, d, "customer")
    name = F.concat(F.col("c_name"), F.lit(" of "), F.substring(F.md5(F.col("c_custkey").cast("string")), 1, 16))
    if typo:
        name = F.concat(F.substring(name, 1, 24), F.lit("~"), F.substring(name, 26, 20))
    return c.select(F.col("c_custkey").cast("string").alias("business_entity_id"), name.alias("name"),
                    F.concat(F.lit("TAX-"), F.col("c_nationkey").cast("string")).alias("tax_id"),
                    F.col("c_mktsegment").alias("address"), F.lit("").alias("postal_code"))


_PREFIXED = """SELECT CAST(c_custkey AS VARCHAR) AS k, c_name || ' of ' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 16) AS name,
  'TAX-' || CAST(c_nationkey AS VARCHAR) AS tax_id FROM customer"""


@register("match_shared_prefix", f"""
WITH m AS ({_PREFIXED}), s AS (SELECT k, substr(name, 1, 24) || '~' || substr(name, 26) AS name, tax_id FROM m)
SELECT s.k AS src_business_entity_id, m.k AS main_business_entity_id, CAST(round({_SCORE}, 6) AS DECIMAL(10,6)) AS name_score
FROM s JOIN m ON s.tax_id = m.tax_id WHERE {_SCORE} >= 0.85""")
def match_shared_prefix(spark, d):
    """Names of one prefix and a tail of their own; what they share is not joined on."""
    s = match.match_scores(_prefixed(spark, d, typo=True), _prefixed(spark, d), threshold=0.85)
    return s.select("src_business_entity_id", "main_business_entity_id",
                    F.round("name_score", 6).cast("decimal(10,6)").alias("name_score"))


_SHORT = """SELECT CAST(c_custkey AS VARCHAR) AS k, c_name AS name,
  'TAX-' || CAST(c_custkey % (SELECT count(*) // 60 FROM customer) AS VARCHAR) AS tax_id FROM customer"""


@register("match_all_alike", f"""
WITH m AS ({_SHORT}), s AS (SELECT k, substr(name, 1, 5) || '~' || substr(name, 7) AS name, tax_id FROM m)
SELECT s.k AS src_business_entity_id, m.k AS main_business_entity_id, CAST(round({_SCORE}, 6) AS DECIMAL(10,6)) AS name_score
FROM s JOIN m ON s.tax_id = m.tax_id WHERE {_SCORE} >= 0.8""")
def match_all_alike(spark, d):
    """Names that are a shared prefix and a number: a large part of each block's pairs pass."""
    c = table(spark, d, "customer")
    blocks = c.agg(F.floor(F.count(F.lit(1)) / 60)).scalar()
    main = c.select(F.col("c_custkey").cast("string").alias("business_entity_id"), F.col("c_name").alias("name"),
                    F.concat(F.lit("TAX-"), (F.col("c_custkey") % blocks).cast("string")).alias("tax_id"),
                    F.lit("").alias("address"), F.lit("").alias("postal_code"))
    src = main.withColumn("name", F.concat(F.substring("name", 1, 5), F.lit("~"), F.substring("name", 7, 30)))
    s = match.match_scores(src, main)
    return s.select("src_business_entity_id", "main_business_entity_id",
                    F.round("name_score", 6).cast("decimal(10,6)").alias("name_score"))
