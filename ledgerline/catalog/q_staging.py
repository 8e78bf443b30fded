"""Staging tables E1-E16 built from the driver tables.

Roles: ``supplier`` = vendor, ``customer`` = client, ``lineitem`` ⋈ ``orders``
= the vendor × client links of the landing table.  Audit stamps (clock
columns) are left out so results are comparable with the oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.catalog import register
from ledgerline.functions.keys import sql_stable_uuid
from ledgerline.operators import nested
from ledgerline.operators.dedupe import distinct_wide
from ledgerline.operators.reshape import EXTERNAL_LEVELS
from ledgerline.plans import staging as S
from ledgerline.session import table

FIRM = S.StagingConfig().firm_uuid


def _u(cols, decimals=()):
    return sql_stable_uuid({c: c for c in cols}, decimals)


# --- landing ------------------------------------------------------------------

_LANDING_SQL = f"""
landing AS (
  SELECT
    CASE WHEN s.s_acctbal >= 0 THEN CAST(s.s_suppkey AS VARCHAR) END AS vendor_id,
    s.s_name AS vendor_name,
    CASE WHEN s.s_acctbal > 2000 THEN 'Contact ' || s.s_name WHEN s.s_acctbal > 1000 THEN 'none' END AS vendor_contact_name,
    CASE WHEN s.s_acctbal > 5000 THEN 'SE' || CAST(s.s_suppkey AS VARCHAR) END AS supplier_ecid,
    CASE WHEN s.s_acctbal > -500 THEN 'TAX-' || CAST(s.s_nationkey AS VARCHAR) END AS tax_id,
    CASE WHEN s.s_nationkey % 2 = 0 THEN 'Trade ' || s.s_name END AS dba,
    CASE WHEN s.s_nationkey % 3 <> 0 THEN 'CV' || CAST(s.s_suppkey AS VARCHAR) END AS client_vendor_id,
    'SITE' || CAST(s.s_nationkey AS VARCHAR) AS client_vendor_site_id,
    CASE WHEN c.c_mktsegment <> 'HOUSEHOLD' THEN CAST(c.c_custkey AS VARCHAR) END AS client_ecid,
    CASE WHEN c.c_mktsegment <> 'HOUSEHOLD' THEN CAST(c.c_custkey AS VARCHAR) END AS client_id,
    c.c_name AS client_name,
    CAST(NULL AS VARCHAR) AS company_structure,
    CAST(1900 + s.s_nationkey * 4 AS VARCHAR) AS year_incorporated,
    CAST(CAST(s.s_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS reported_annual_revenue
  FROM (SELECT DISTINCT l.l_suppkey, o.o_custkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey) k
  JOIN supplier s ON s.s_suppkey = k.l_suppkey
  JOIN customer c ON c.c_custkey = k.o_custkey),
ids AS (
  SELECT *,
    CASE WHEN vendor_id IS NOT NULL THEN vendor_id ELSE {sql_stable_uuid({'name': 'vendor_name'})} END AS vendor_entity_id,
    {sql_stable_uuid({'name': 'client_name'})} AS buyer_entity_id,
    CASE WHEN client_id IS NOT NULL THEN '{FIRM}' END AS firm_entity_id
  FROM landing)"""


def _links(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    links = li.join(o, li.l_orderkey == o.o_orderkey).select("l_suppkey", "o_custkey")
    return distinct_wide(links, ["o_custkey"])        # the clients are joined where the links lie


def _vendors(spark, d):
    s = table(spark, d, "supplier")
    return s.select(
        F.col("s_suppkey").alias("l_suppkey"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_suppkey").cast("string")).alias("vendor_id"),
        F.col("s_name").alias("vendor_name"),
        F.when(F.col("s_acctbal") > 2000, F.concat(F.lit("Contact "), F.col("s_name")))
         .when(F.col("s_acctbal") > 1000, F.lit("none")).alias("vendor_contact_name"),
        F.when(F.col("s_acctbal") > 5000, F.concat(F.lit("SE"), F.col("s_suppkey"))).alias("supplier_ecid"),
        F.when(F.col("s_acctbal") > -500, F.concat(F.lit("TAX-"), F.col("s_nationkey"))).alias("tax_id"),
        F.when(F.col("s_nationkey") % 2 == 0, F.concat(F.lit("Trade "), F.col("s_name"))).alias("dba"),
        F.when(F.col("s_nationkey") % 3 != 0, F.concat(F.lit("CV"), F.col("s_suppkey"))).alias("client_vendor_id"),
        F.concat(F.lit("SITE"), F.col("s_nationkey")).alias("client_vendor_site_id"),
        F.lit(None).cast("string").alias("company_structure"),
        (F.lit(1900) + F.col("s_nationkey") * 4).cast("string").alias("year_incorporated"),
        F.col("s_acctbal").cast("decimal(18,2)").cast("string").alias("reported_annual_revenue"))


def _clients(spark, d):
    c = table(spark, d, "customer")
    return c.select(
        F.col("c_custkey").alias("o_custkey"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_custkey").cast("string")).alias("client_id"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_custkey").cast("string")).alias("client_ecid"),
        F.col("c_name").alias("client_name"))


def landing(spark, d):
    """The wide landing form: one row per vendor × client link."""
    return _links(spark, d).join(_vendors(spark, d), "l_suppkey").join(_clients(spark, d), "o_custkey") \
                           .drop("l_suppkey", "o_custkey")


def ids(spark, d):
    # ids are hashed once per supplier / customer, then joined to the links
    return S.link_entity_ids(_links(spark, d), _vendors(spark, d), _clients(spark, d), "l_suppkey", "o_custkey")


# --- E1, E2 -------------------------------------------------------------------

@register("staging_entity", f"""
WITH {_LANDING_SQL}
SELECT DISTINCT stg_business_entity_id FROM (
  SELECT vendor_entity_id AS stg_business_entity_id FROM ids
  UNION ALL SELECT buyer_entity_id FROM ids UNION ALL SELECT firm_entity_id FROM ids)
WHERE stg_business_entity_id IS NOT NULL""")
def staging_entity(spark, d):
    return S.build_entity(ids(spark, d))


_DET = ["stg_business_entity_id", "business_entity_name", "company_structure", "year_incorporated",
        "reported_annual_revenue"]


@register("staging_details", f"""
WITH {_LANDING_SQL},
rows AS (
  SELECT DISTINCT * FROM (
    SELECT vendor_entity_id AS stg_business_entity_id, vendor_name AS business_entity_name,
           company_structure, year_incorporated, reported_annual_revenue FROM ids
    UNION ALL SELECT firm_entity_id, 'firm', NULL, NULL, NULL FROM ids WHERE firm_entity_id IS NOT NULL
    UNION ALL SELECT buyer_entity_id, client_name, NULL, NULL, NULL FROM ids)
  WHERE stg_business_entity_id IS NOT NULL)
SELECT {_u(_DET)} AS business_entity_details_id, * FROM rows""")
def staging_details(spark, d):
    return S.build_details(ids(spark, d))


# --- E3 contacts --------------------------------------------------------------

PEOPLE_SCHEMA = T.ArrayType(T.StructType([
    T.StructField("name", T.StringType()), T.StructField("titles", T.ArrayType(T.StringType()))]))

_CON = ["stg_business_entity_id", "contact_name", "contact_title"]


@register("staging_contacts", f"""
WITH people AS (
  SELECT CAST(conv_id AS VARCHAR) AS stg_business_entity_id, role AS contact_name,
         unnest(string_split(text, chr(10))) AS contact_title
  FROM conversations WHERE text IS NOT NULL),
vend AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS stg_business_entity_id,
         CASE WHEN s_acctbal > 2000 THEN 'Contact ' || s_name WHEN s_acctbal > 1000 THEN 'none' END AS contact_name,
         CAST(NULL AS VARCHAR) AS contact_title
  FROM supplier),
rows AS (
  SELECT DISTINCT * FROM (SELECT * FROM people UNION ALL SELECT * FROM vend)
  WHERE contact_name IS NOT NULL AND trim(contact_name) <> '' AND trim(contact_name) <> 'none'
    AND stg_business_entity_id IS NOT NULL)
SELECT {_u(_CON)} AS business_entity_contact_id, * FROM rows""")
def staging_contacts(spark, d):
    conv = table(spark, d, "conversations")
    # the landing carries people as JSON text, one document per conversation turn
    docs = conv.select("conv_id", F.to_json(F.array(F.struct(
        F.col("role").alias("name"), F.split(F.col("text"), "\n").alias("titles")))).alias("associated_people"))
    parsed = nested.parse_json(docs, "associated_people", PEOPLE_SCHEMA, "_p")
    people = nested.explode_nested(parsed, "_p", "titles", "associated_people", ["conv_id"]).select(
        F.col("conv_id").cast("string").alias("stg_business_entity_id"),
        F.col("associated_people__name").alias("contact_name"),
        F.col("associated_people__titles").alias("contact_title"))
    s = table(spark, d, "supplier")
    vend = s.select(F.col("s_suppkey").cast("string").alias("stg_business_entity_id"),
                    F.when(F.col("s_acctbal") > 2000, F.concat(F.lit("Contact "), F.col("s_name")))
                     .when(F.col("s_acctbal") > 1000, F.lit("none")).alias("contact_name"))
    return S.build_contacts(people, vend)


# --- E4, E5 card metrics from events -------------------------------------------

def _window_struct(days):
    return T.StructType([T.StructField("start_date", T.StringType()),
                         T.StructField("average_monthly_amount", T.DoubleType())])


REVENUE_SCHEMA = T.StructType([
    T.StructField("end_date", T.StringType()),
    T.StructField("1m", _window_struct(30)),
    T.StructField("3m", _window_struct(90)),
])

_REV_AMOUNTS = ["card_revenue__1m__average_monthly_amount", "card_revenue__3m__average_monthly_amount"]
_REV_DATES = ["card_revenue__end_date", "card_revenue__1m__start_date", "card_revenue__3m__start_date"]


def _revenue_json(e):
    """JSON text per purchase/view event: end date, 1m window (only for
    purchases), 3m window; values are from the event."""
    day = F.date_format("ts", "yyyy-MM-dd")
    w1 = F.when(F.col("event_type") == "purchase", F.struct(
        F.date_format(F.col("ts") - F.expr("INTERVAL 30 DAYS"), "yyyy-MM-dd").alias("start_date"),
        F.col("value").alias("average_monthly_amount")))
    w3 = F.struct(F.date_format(F.col("ts") - F.expr("INTERVAL 90 DAYS"), "yyyy-MM-dd").alias("start_date"),
                  (F.col("value") * 3).alias("average_monthly_amount"))
    doc = F.to_json(F.struct(day.alias("end_date"), w1.alias("1m"), w3.alias("3m")))
    return F.when(F.col("event_type").isin("purchase", "view"), doc) \
            .when(F.col("event_type") == "error", F.lit("{}")).otherwise(F.lit("not json"))


@register("staging_card_revenues", f"""
WITH flat AS (
  SELECT CAST(event_id AS VARCHAR) AS stg_business_entity_id,
    CAST(strftime(ts, '%Y-%m-%d') AS DATE) AS card_revenue__end_date,
    CASE WHEN event_type = 'purchase' THEN CAST(strftime(ts - INTERVAL 30 DAY, '%Y-%m-%d') AS DATE) END AS card_revenue__1m__start_date,
    CAST(strftime(ts - INTERVAL 90 DAY, '%Y-%m-%d') AS DATE) AS card_revenue__3m__start_date,
    CASE WHEN event_type = 'purchase' THEN CAST(round(CAST(value AS DECIMAL(38,6)), 2) AS DECIMAL(38,6)) END AS card_revenue__1m__average_monthly_amount,
    CAST(round(CAST(value * 3 AS DECIMAL(38,6)), 2) AS DECIMAL(38,6)) AS card_revenue__3m__average_monthly_amount
  FROM events WHERE event_type IN ('purchase', 'view')),
rows AS (SELECT DISTINCT * FROM flat)
SELECT {_u(['stg_business_entity_id'] + _REV_DATES + _REV_AMOUNTS, _REV_AMOUNTS)} AS revenue_id, * FROM rows""")
def staging_card_revenues(spark, d):
    e = table(spark, d, "events")
    src = e.select(F.col("event_id").cast("string").alias("stg_business_entity_id"),
                   _revenue_json(e).alias("card_revenue"))
    flat = nested.flatten(src, [nested.FlattenConfig("card_revenue", REVENUE_SCHEMA, "struct", "card_revenue")],
                          ["stg_business_entity_id"])["card_revenue"]
    return S.build_card_revenues(flat, _REV_AMOUNTS, _REV_DATES)


STABILITY_SCHEMA = T.StructType([
    T.StructField("end_date", T.StringType()),
    T.StructField("1m", T.StructType([T.StructField("days_present", T.IntegerType()),
                                      T.StructField("monthly_coverage_ratio", T.StringType())])),
])
_STAB = ["card_transactions_stability__1m__days_present", "card_transactions_stability__1m__monthly_coverage_ratio"]


@register("staging_card_stability", f"""
WITH flat AS (
  SELECT CAST(user_id AS VARCHAR) AS stg_business_entity_id,
    CAST(CASE WHEN k > 10 THEN k END AS VARCHAR) AS card_transactions_stability__1m__days_present,
    CASE WHEN k > 50 THEN CAST(k AS VARCHAR) WHEN k > 5 THEN '' END AS card_transactions_stability__1m__monthly_coverage_ratio
  FROM (SELECT user_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)),
rows AS (SELECT DISTINCT * FROM flat
         WHERE (card_transactions_stability__1m__days_present IS NOT NULL AND card_transactions_stability__1m__days_present NOT IN ('', 'null'))
            OR (card_transactions_stability__1m__monthly_coverage_ratio IS NOT NULL AND card_transactions_stability__1m__monthly_coverage_ratio NOT IN ('', 'null')))
SELECT {_u(['stg_business_entity_id'] + _STAB)} AS card_transactions_stability_id, * FROM rows""")
def staging_card_stability(spark, d):
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    doc = F.to_json(F.struct(F.lit(None).cast("string").alias("end_date"), F.struct(
        F.when(k > 10, k).alias("days_present"),
        F.when(k > 50, k.cast("string")).when(k > 5, F.lit("")).alias("monthly_coverage_ratio")).alias("1m")))
    src = e.select(F.col("user_id").cast("string").alias("stg_business_entity_id"),
                   doc.alias("card_transactions_stability"))
    parsed = nested.parse_json(src, "card_transactions_stability", STABILITY_SCHEMA, "_p", drop_failed=False)
    flat = nested.flatten_struct(parsed, "_p", "card_transactions_stability", ["stg_business_entity_id"])
    flat = flat.select("stg_business_entity_id", *[F.col(c).cast("string").alias(c) for c in _STAB])
    return S.build_card_stability(flat, _STAB)


# --- E6-E11 melted attribute tables -------------------------------------------

_TECH = "(VALUES ('Brand#1', 'gateway-a'), ('Brand#2', ''), ('Brand#3', 'gateway-c')) AS t(brand, vendor)"


@register("staging_receivables", f"""
WITH src AS (
  SELECT CAST(p.p_partkey AS VARCHAR) AS stg_business_entity_id, t.vendor AS technologies_vendor_name,
         p.p_type AS payment_type, CAST(p.p_size AS VARCHAR) AS payment_terms_days
  FROM part p LEFT JOIN {_TECH} ON p.p_brand = t.brand),
m AS (
  SELECT DISTINCT stg_business_entity_id,
    CASE k WHEN 'technologies_vendor_name' THEN 'payment_tech_used' ELSE k END AS receivables_attribute_type,
    v AS receivables_attribute_value FROM (
      SELECT stg_business_entity_id, 'technologies_vendor_name' AS k, technologies_vendor_name AS v FROM src
      UNION ALL SELECT stg_business_entity_id, 'payment_type', payment_type FROM src
      UNION ALL SELECT stg_business_entity_id, 'payment_terms_days', payment_terms_days FROM src)
  WHERE v IS NOT NULL AND v <> '')
SELECT {_u(['stg_business_entity_id', 'receivables_attribute_type', 'receivables_attribute_value'])} AS attribute_id, *
FROM m""")
def staging_receivables(spark, d):
    p = table(spark, d, "part")
    tech = spark.createDataFrame([("Brand#1", "gateway-a"), ("Brand#2", ""), ("Brand#3", "gateway-c")],
                                 "brand string, vendor string")
    src = p.join(F.broadcast(tech), p.p_brand == tech.brand, "left").select(
        F.col("p_partkey").cast("string").alias("pk"), F.col("vendor").alias("technologies_vendor_name"),
        F.col("p_type").alias("payment_type"), F.col("p_size").cast("string").alias("payment_terms_days"))
    return S.build_melted(src, "pk", ["technologies_vendor_name", "payment_type", "payment_terms_days"],
                          "receivables_attribute_type", "receivables_attribute_value", "attribute_id",
                          renames={"technologies_vendor_name": "payment_tech_used"}, drop_blank=True)


def _supplier_contacts(s):
    base = F.lower(F.replace(F.col("s_name"), F.lit("#"), F.lit(".")))
    return s.select(
        F.col("s_suppkey").cast("string").alias("sid"),
        F.concat(F.lit("+1-"), F.lpad(F.col("s_nationkey").cast("string"), 3, "0"), F.lit("-"),
                 F.col("s_suppkey").cast("string")).alias("primary_phone_number"),
        F.when(F.col("s_acctbal") > 3000, F.concat(F.lit("+44-"), F.col("s_suppkey").cast("string")))
         .alias("secondary_phone_number"),
        F.concat(base, F.lit("@mail.test")).alias("email"),
        F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("https://"), base, F.lit(".test"))).alias("website"))


_SUPP_CONTACTS_SQL = """
  SELECT CAST(s_suppkey AS VARCHAR) AS related_identifier,
    '+1-' || lpad(CAST(s_nationkey AS VARCHAR), 3, '0') || '-' || CAST(s_suppkey AS VARCHAR) AS primary_phone_number,
    CASE WHEN s_acctbal > 3000 THEN '+44-' || CAST(s_suppkey AS VARCHAR) END AS secondary_phone_number,
    lower(replace(s_name, '#', '.')) || '@mail.test' AS email,
    CASE WHEN s_acctbal >= 0 THEN 'https://' || lower(replace(s_name, '#', '.')) || '.test' END AS website
  FROM supplier"""


@register("staging_telecom_address", f"""
WITH src AS ({_SUPP_CONTACTS_SQL}),
m AS (SELECT DISTINCT related_identifier, 'business_entity' AS related_identifier_source,
        CASE k WHEN 'primary_phone_number' THEN 'primary' ELSE k END AS telecommunication_address_type, v AS phone_number
      FROM (SELECT related_identifier, 'primary_phone_number' AS k, primary_phone_number AS v FROM src
            UNION ALL SELECT related_identifier, 'secondary_phone_number', secondary_phone_number FROM src)
      WHERE v IS NOT NULL)
SELECT {_u(['related_identifier', 'related_identifier_source', 'telecommunication_address_type', 'phone_number'])}
  AS telecommunication_address_id, * FROM m""")
def staging_telecom_address(spark, d):
    src = _supplier_contacts(table(spark, d, "supplier"))
    return S.build_melted(src, "sid", ["primary_phone_number", "secondary_phone_number"],
                          "telecommunication_address_type", "phone_number", "telecommunication_address_id",
                          renames={"primary_phone_number": "primary"}, source_tag=S.SOURCE_ENTITY,
                          id_out="related_identifier")


@register("staging_electronic_address", f"""
WITH src AS ({_SUPP_CONTACTS_SQL}),
m AS (SELECT DISTINCT related_identifier, 'business_entity' AS related_identifier_source,
        CASE k WHEN 'email' THEN 'primary' ELSE k END AS electronic_address_type, v AS electronic_address
      FROM (SELECT related_identifier, 'email' AS k, email AS v FROM src
            UNION ALL SELECT related_identifier, 'website', website FROM src)
      WHERE v IS NOT NULL)
SELECT {_u(['related_identifier', 'related_identifier_source', 'electronic_address_type', 'electronic_address'])}
  AS electronic_address_id, * FROM m""")
def staging_electronic_address(spark, d):
    src = _supplier_contacts(table(spark, d, "supplier"))
    return S.build_melted(src, "sid", ["email", "website"], "electronic_address_type", "electronic_address",
                          "electronic_address_id", renames={"email": "primary"}, source_tag=S.SOURCE_ENTITY,
                          id_out="related_identifier")


@register("staging_restrictions", f"""
WITH m AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS related_identifier,
             'business_entity' AS related_identifier_source, 'do_not_campaign' AS restriction_type,
             CAST(c_acctbal < 0 AS VARCHAR) AS restriction_indicator
           FROM customer)
SELECT {_u(['related_identifier', 'related_identifier_source', 'restriction_type', 'restriction_indicator'])}
  AS restriction_id, related_identifier, related_identifier_source, restriction_type,
  CAST(restriction_indicator AS BOOLEAN) AS restriction_indicator FROM m""")
def staging_restrictions(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("cid"),
                                           (F.col("c_acctbal") < 0).alias("do_not_campaign"))
    out = S.build_melted(c, "cid", ["do_not_campaign"], "restriction_type", "restriction_indicator",
                         "restriction_id", source_tag=S.SOURCE_ENTITY, id_out="related_identifier")
    return out.withColumn("restriction_indicator", F.col("restriction_indicator").cast("boolean"))


@register("staging_industry", f"""
WITH src AS (SELECT CAST(p_partkey AS VARCHAR) AS stg_business_entity_id, p_brand AS l1, p_type AS l2,
               CAST(p_size AS VARCHAR) AS l3, CASE WHEN p_size > 25 THEN 'large' END AS internal_size FROM part),
m AS (SELECT DISTINCT stg_business_entity_id,
        CASE WHEN k IN ('level-1', 'level-2', 'level-3') THEN 'bloomberg' ELSE 'internal' END AS classification_type,
        k AS classification_code, v AS classification_description
      FROM (SELECT stg_business_entity_id, 'level-1' AS k, l1 AS v FROM src
            UNION ALL SELECT stg_business_entity_id, 'level-2', l2 FROM src
            UNION ALL SELECT stg_business_entity_id, 'level-3', l3 FROM src
            UNION ALL SELECT stg_business_entity_id, 'size_band', internal_size FROM src)
      WHERE v IS NOT NULL)
SELECT {_u(['stg_business_entity_id', 'classification_type', 'classification_code', 'classification_description'])}
  AS classification_id, * FROM m""")
def staging_industry(spark, d):
    p = table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("pk"), "p_brand", "p_type",
        F.col("p_size").cast("string").alias("p_size_text"),
        F.when(F.col("p_size") > 25, F.lit("large")).alias("internal_size"))
    levels = dict(zip(EXTERNAL_LEVELS, ["p_brand", "p_type", "p_size_text"]))
    levels["size_band"] = "internal_size"
    return S.build_industry(p, "pk", levels)


@register("staging_characteristics", f"""
WITH src AS (SELECT CAST(c_custkey AS VARCHAR) AS stg_business_entity_id,
               'sp' || ';' || c_mktsegment || ';' || CASE WHEN c_acctbal > 0 THEN '2024-01-' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') END AS credit_rating_sp,
               CASE WHEN c_acctbal > 8000 THEN 'preferred' END AS tier
             FROM customer),
m AS (SELECT DISTINCT stg_business_entity_id, k AS characteristic_type, v AS characteristic_value
      FROM (SELECT stg_business_entity_id, 'credit_rating_sp' AS k, credit_rating_sp AS v FROM src
            UNION ALL SELECT stg_business_entity_id, 'tier', tier FROM src) WHERE v IS NOT NULL)
SELECT {_u(['stg_business_entity_id', 'characteristic_type', 'characteristic_value'])} AS characteristics_id, * FROM m""")
def staging_characteristics(spark, d):
    c = table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("cid"), F.col("c_mktsegment").alias("seg"),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("2024-01-"),
               F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0"))).alias("seg_date"),
        F.when(F.col("c_acctbal") > 8000, F.lit("preferred")).alias("tier"))
    return S.build_characteristics(c, "cid", [("sp", "seg", "seg_date")], plain=["tier"])


# --- E12-E14 --------------------------------------------------------------------

_ADDR = ["related_identifier", "related_identifier_source", "physical_address_type", "street_line_1",
         "city", "state_province", "country", "postal_code"]


@register("staging_physical_address", f"""
WITH m AS (SELECT DISTINCT CAST(s.s_suppkey AS VARCHAR) AS related_identifier,
             'business_entity' AS related_identifier_source, 'billing' AS physical_address_type,
             'Dock ' || CAST(s.s_suppkey AS VARCHAR) AS street_line_1, n.n_name AS city,
             r.r_name AS state_province, n.n_name AS country,
             lpad(CAST(s.s_nationkey * 1000 + n.n_regionkey AS VARCHAR), 5, '0') AS postal_code
           FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
           LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT {_u(_ADDR)} AS physical_address_id, * FROM m""")
def staging_physical_address(spark, d):
    s, n, r = table(spark, d, "supplier"), table(spark, d, "nation"), table(spark, d, "region")
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey, "left")
    src = j.select(F.col("s_suppkey").cast("string").alias("sid"),
                   F.concat(F.lit("Dock "), F.col("s_suppkey").cast("string")).alias("addr1"),
                   "n_name", "r_name",
                   F.lpad((F.col("s_nationkey") * 1000 + F.col("n_regionkey")).cast("string"), 5, "0").alias("zip"))
    return S.build_physical_address(src, "sid", {"street_line_1": "addr1", "city": "n_name",
                                                 "state_province": "r_name", "country": "n_name",
                                                 "postal_code": "zip"})


_CARD = ["stg_business_entity_id", "matched_level_2", "matched_level_3_summary", "match_confidence"]


@register("staging_card_association", f"""
WITH src AS (SELECT CAST(o_custkey AS VARCHAR) AS cid,
        CASE o_orderstatus WHEN 'F' THEN 'Yes' WHEN 'O' THEN 'no' END AS card_match,
        CASE WHEN o_orderpriority LIKE '1%' THEN 'yes' WHEN o_orderpriority LIKE '5%' THEN 'NO' END AS lvl2,
        CASE WHEN o_totalprice > 200000 THEN 'yes' END AS lvl3,
        CASE WHEN o_orderpriority LIKE '3%' THEN 'high' END AS conf
      FROM orders),
kept AS (SELECT * FROM src WHERE (card_match IS NOT NULL AND card_match NOT IN ('', 'null'))
           OR (lvl2 IS NOT NULL AND lvl2 NOT IN ('', 'null')) OR (lvl3 IS NOT NULL AND lvl3 NOT IN ('', 'null'))
           OR (conf IS NOT NULL AND conf NOT IN ('', 'null'))),
m AS (SELECT DISTINCT cid AS stg_business_entity_id,
        CASE WHEN lower(trim(card_match)) = 'yes' THEN 'visa' ELSE '' END AS association_name,
        CASE WHEN lower(trim(lvl2)) = 'yes' THEN true WHEN lower(trim(lvl2)) = 'no' THEN false END AS matched_level_2,
        CASE WHEN lower(trim(lvl3)) = 'yes' THEN true WHEN lower(trim(lvl3)) = 'no' THEN false END AS matched_level_3_summary,
        conf AS match_confidence FROM kept)
SELECT {_u(_CARD)} AS card_association_id, * FROM m""")
def staging_card_association(spark, d):
    o = table(spark, d, "orders")
    src = o.select(
        F.col("o_custkey").cast("string").alias("cid"),
        F.when(F.col("o_orderstatus") == "F", "Yes").when(F.col("o_orderstatus") == "O", "no").alias("card_match"),
        F.when(F.col("o_orderpriority").startswith("1"), "yes")
         .when(F.col("o_orderpriority").startswith("5"), "NO").alias("lvl2"),
        F.when(F.col("o_totalprice") > 200000, "yes").alias("lvl3"),
        F.when(F.col("o_orderpriority").startswith("3"), "high").alias("conf"))
    return S.build_card_association(src, "cid", "card_match",
                                    {"matched_level_2": "lvl2", "matched_level_3_summary": "lvl3"},
                                    {"match_confidence": "conf"})


_SPEND = ["stg_payor_business_entity_id", "stg_payee_business_entity_id", "period_start_date",
          "period_end_date", "payment_ccy", "sum_of_payments"]


@register("staging_spend_analysis", f"""
WITH m AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS stg_payor_business_entity_id,
             CAST(o_orderkey AS VARCHAR) AS stg_payee_business_entity_id,
             CAST(try_strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') AS DATE) AS period_start_date,
             CAST(try_strptime(CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE strftime(o_orderdate + INTERVAL 30 DAY, '%Y%m%d') END, '%Y%m%d') AS DATE) AS period_end_date,
             'USD' AS payment_ccy, CAST(o_totalprice AS DECIMAL(38,6)) AS sum_of_payments
           FROM orders)
SELECT {_u(_SPEND, ['sum_of_payments'])} AS spend_analysis_id, * FROM m""")
def staging_spend_analysis(spark, d):
    o = table(spark, d, "orders")
    src = o.select(
        F.col("o_custkey").cast("string").alias("payor"), F.col("o_orderkey").cast("string").alias("payee"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("start_txt"),
        F.when(F.col("o_orderstatus") == "P", F.lit("n/a"))
         .otherwise(F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS"), "yyyyMMdd")).alias("end_txt"),
        F.col("o_totalprice").cast("decimal(38,6)").alias("amount"))
    out = S.build_spend(src, "payor", "payee", {"period_start_date": "start_txt", "period_end_date": "end_txt"},
                        {"payment_ccy": F.lit("USD"), "sum_of_payments": F.col("amount")})
    # amounts are decimals in the id rule
    return out.select(S.stable_uuid(_SPEND, decimals=["sum_of_payments"]).alias("spend_analysis_id"),
                      *[c for c in out.columns if c != "spend_analysis_id"])


# --- E15, E16 ---------------------------------------------------------------------

_REL = list(S.REL_COLUMNS)
_CONTACT_SQL = (f"CASE WHEN vendor_contact_name IS NOT NULL AND trim(vendor_contact_name) <> '' "
                f"AND trim(vendor_contact_name) <> 'none' THEN "
                f"{sql_stable_uuid({'stg_business_entity_id': 'vendor_entity_id', 'contact_name': 'vendor_contact_name'})} END")
_EDGES_SQL = f"""
edges AS (
  SELECT buyer_entity_id AS stg_business_entity_id, CAST(NULL AS VARCHAR) AS business_entity_contact_id,
         '{FIRM}' AS stg_related_business_entity_id, CAST(NULL AS VARCHAR) AS related_business_entity_contact_id,
         'client' AS business_entity_role, 'firm' AS related_business_entity_role,
         client_ecid, CAST(NULL AS VARCHAR) AS supplier_ecid,
         CAST(NULL AS VARCHAR) AS client_vendor_id, CAST(NULL AS VARCHAR) AS client_vendor_site_id
  FROM ids WHERE vendor_entity_id IS NOT NULL AND buyer_entity_id IS NOT NULL
  UNION
  SELECT vendor_entity_id, {_CONTACT_SQL}, buyer_entity_id, NULL, 'supplier', 'buyer', NULL, NULL,
         client_vendor_id, client_vendor_site_id
  FROM ids WHERE vendor_entity_id IS NOT NULL AND buyer_entity_id IS NOT NULL
  UNION
  SELECT vendor_entity_id, NULL, '{FIRM}', NULL, 'client', 'firm', NULL, supplier_ecid, NULL, NULL
  FROM ids WHERE supplier_ecid IS NOT NULL AND vendor_entity_id IS NOT NULL)"""


@register("staging_relationships", f"""
WITH {_LANDING_SQL}, {_EDGES_SQL},
rel AS (SELECT DISTINCT {', '.join(_REL)} FROM edges)
SELECT {_u(_REL)} AS business_entity_relationship_id, * FROM rel""")
def staging_relationships(spark, d):
    return S.build_relationships(ids(spark, d))


_IDN = ["related_identifier", "related_identifier_source", "identifier_type", "identifier_value"]


def _identifiers_sql(types, entity_scope=False):
    """Oracle of E16 over CTEs ``ids`` and ``edges``."""
    rel = ["client_ecid", "supplier_ecid", "client_vendor_id", "client_vendor_site_id"]
    same = "AND h.owner = v.owner" if entity_scope else ""
    return f"""
e2 AS (SELECT {_u(_REL)} AS rel_id, * FROM edges),
rel_ids AS ({' UNION '.join(
        f"SELECT rel_id AS related_identifier, stg_business_entity_id AS owner, '{t}' AS identifier_type, "
        f"{t} AS identifier_value FROM e2 WHERE {t} IS NOT NULL" for t in rel)}),
vend AS ({' UNION '.join(
        f"SELECT vendor_entity_id AS owner, '{t}' AS identifier_type, CAST({t} AS VARCHAR) AS identifier_value "
        f"FROM ids WHERE {t} IS NOT NULL AND vendor_entity_id IS NOT NULL" for t in types)}),
free AS (SELECT * FROM vend v WHERE NOT EXISTS (
  SELECT 1 FROM rel_ids h WHERE h.identifier_type = v.identifier_type AND h.identifier_value = v.identifier_value {same})),
m AS (SELECT DISTINCT related_identifier, related_identifier_source,
        CASE WHEN identifier_type IN ('client_ecid', 'supplier_ecid') THEN 'ecid' ELSE identifier_type END AS identifier_type,
        identifier_value
      FROM (SELECT related_identifier, 'relationship' AS related_identifier_source, identifier_type, identifier_value FROM rel_ids
            UNION ALL SELECT owner, 'business_entity', identifier_type, identifier_value FROM free))
SELECT {_u(_IDN)} AS identifier_id, * FROM m"""


@register("staging_identifiers", f"""
WITH {_LANDING_SQL}, {_EDGES_SQL}, {_identifiers_sql(S.IDENTIFIER_TYPES)}""")
def staging_identifiers(spark, d):
    return S.build_identifiers(ids(spark, d))


@register("staging_identifiers_entity_scope", f"""
WITH {_LANDING_SQL}, {_EDGES_SQL}, {_identifiers_sql(S.IDENTIFIER_TYPES, entity_scope=True)}""")
def staging_identifiers_entity_scope(spark, d):
    return S.build_identifiers(ids(spark, d), S.StagingConfig(identifier_scope="entity"))
