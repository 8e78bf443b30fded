"""The whole staging run (W1): one query per output table.

The landing extract is derived from the driver tables: one row per supplier ×
customer link (so several rows per vendor), all text, with blanks, employees,
JSON columns, a ``vendor_id`` of the client's own, and one column that only
the mapping makes an identifier.  Its SQL runs on Spark and DuckDB alike; the
oracles work from its columns and never from the Python builders.
"""

from __future__ import annotations

from ledgerline.catalog import register
from ledgerline.functions.keys import sql_stable_uuid
from ledgerline.operators import match
from ledgerline.plans import staging as S
from ledgerline.plans.staging_run import DEFAULT_MAPPING, SPECS, run_staging

TABLES = ("lineitem", "orders", "supplier", "customer", "nation")
MAPPING = (*DEFAULT_MAPPING, ("register_no", "business_entity_identifiers", "trade_register_id"))
FIRM = S.StagingConfig().firm_uuid

LANDING = """
SELECT s.s_suppkey AS k,
  CASE WHEN s.s_acctbal >= 0 THEN CAST(s.s_suppkey AS STRING) END AS sds_supplier_id,
  s.s_name AS vendor_name_cleaned, c.c_name AS client_name,
  'CV' || CAST(s.s_suppkey AS STRING) || '-' || CAST(c.c_nationkey AS STRING) AS vendor_id,
  CASE WHEN c.c_nationkey % 2 = 0 THEN 'SITE' || CAST(c.c_nationkey AS STRING) END AS site_id,
  CASE WHEN s.s_acctbal > 2000 THEN 'Contact ' || s.s_name WHEN s.s_acctbal > 1000 THEN 'none' END AS vendor_contact_name,
  CASE WHEN s.s_acctbal > 5000 THEN 'SE' || CAST(s.s_suppkey AS STRING) END AS supplier_ecid,
  CASE WHEN c.c_mktsegment <> 'HOUSEHOLD' THEN 'CE' || CAST(c.c_custkey AS STRING) END AS client_ecid,
  CASE WHEN c.c_custkey % 10 = 0 THEN 'Y' WHEN c.c_custkey % 11 <> 0 THEN 'N' END AS filter_employee,
  CASE WHEN s.s_suppkey % 7 = 0 THEN 'Y' ELSE 'N' END AS filter_individual,
  CASE WHEN s.s_acctbal > -500 THEN 'TAX-' || CAST(s.s_nationkey AS STRING) END AS vendor_government_id,
  CASE WHEN s.s_nationkey % 2 = 0 THEN 'Trade ' || s.s_name END AS vendor_alternate_name,
  'REG' || CAST(s.s_suppkey % 5 AS STRING) AS register_no,
  CAST(1900 + s.s_nationkey * 4 AS STRING) AS year_incorporated,
  CAST(CAST(s.s_acctbal AS DECIMAL(18,2)) AS STRING) AS vendor_annualrevenue,
  CASE WHEN s.s_nationkey % 3 = 0 THEN 'llc' END AS corporate_structures,
  CAST(s.s_suppkey AS STRING) || ' Dock Road' AS vendor_address_ln_1, n.n_name AS vendor_address_ln_3,
  'P' || CAST(s.s_nationkey AS STRING) AS vendor_postcode,
  '+1-555-' || CAST(s.s_suppkey AS STRING) AS vendor_phone_number,
  CASE WHEN s.s_suppkey % 2 = 0 THEN '+1-556-' || CAST(s.s_suppkey AS STRING) END AS vendor_phone_number_2,
  CASE WHEN s.s_suppkey % 3 = 0 THEN ' nan ' ELSE 'v' || CAST(s.s_suppkey AS STRING) || '@vendor.test' END AS vendor_email,
  CASE WHEN s.s_suppkey % 4 <> 0 THEN 'v' || CAST(s.s_suppkey AS STRING) || '.test' END AS vendor_website,
  CASE WHEN s.s_suppkey % 5 = 0 THEN 'true' WHEN s.s_suppkey % 5 = 1 THEN 'false' WHEN s.s_suppkey % 5 = 2 THEN '?' END
    AS filter_do_not_campaign,
  '20240131120000' AS file_uploaded_dt, 'UP1' AS sds_upload_id, 'T' || CAST(c.c_nationkey AS STRING) AS task_id,
  'final' AS analysis_type, '20240101' AS business_start_date,
  CASE WHEN c.c_custkey % 3 = 0 THEN '20241399' ELSE '20241231' END AS business_end_date,
  CAST(CAST(c.c_acctbal AS DECIMAL(18,2)) AS STRING) AS annual_spend_usd,
  CASE WHEN c.c_custkey % 2 = 0 THEN 'n/a' ELSE '12' END AS annual_invoice_count, 'USD' AS payment_currency,
  CAST(s.s_nationkey AS STRING) AS vendor_dso, CAST(c.c_nationkey % 3 AS STRING) AS vendor_dpo,
  'a;b' AS stp_partnershiplist, CASE WHEN s.s_suppkey % 2 = 0 THEN 'b;c' END AS stg_codelist,
  'Sector ' || CAST(s.s_nationkey AS STRING) AS vendor_industry_lvl_1,
  CASE WHEN s.s_suppkey % 6 = 0 THEN 'Y' END AS filter_trust, CASE WHEN s.s_suppkey % 2 = 0 THEN 'N' END AS filter_govt,
  CASE WHEN s.s_acctbal > 0 THEN 'Baa' END AS vendor_credit_rating_moody,
  CASE WHEN s.s_acctbal > 3000 THEN '2024-02-01' END AS vendor_credit_rating_moody_date,
  CAST(s.s_suppkey % 9 AS STRING) AS vendor_cogs,
  CASE WHEN s.s_suppkey % 4 = 0 THEN 'Yes' WHEN s.s_suppkey % 4 = 1 THEN 'No' END AS ind_card_match,
  CASE WHEN s.s_suppkey % 4 = 0 THEN 'yes' END AS visa_matched_level_ii,
  CASE WHEN s.s_suppkey % 8 = 0 THEN '5411' END AS visa_matched_mcc,
  CASE WHEN s.s_suppkey % 3 = 0 THEN '[]' ELSE '[''Agent ' || CAST(s.s_suppkey AS STRING) || ''', ''Agent B'']' END AS registered_agents,
  CASE WHEN s.s_suppkey % 2 = 0 THEN '[{"name": "Ann ' || CAST(s.s_suppkey AS STRING) || '", "titles": ["CEO", "CFO"]}]'
       WHEN s.s_suppkey % 5 = 0 THEN '{oops' END AS associated_people,
  '[{"classification_type": "naics", "classification_code": "' || CAST(s.s_nationkey AS STRING) || '", "classification_description": "D"}]' AS industries,
  CASE WHEN s.s_suppkey % 2 = 1 THEN '{"vendor_name": "Pay' || CAST(s.s_suppkey % 4 AS STRING) || '", "category": "ap"}' END AS technologies,
  CASE WHEN s.s_suppkey % 2 = 0 THEN '{"end_date": "2024-01-31", "1m": {"start_date": "2024-01-01", "average_monthly_amount": '
       || CAST(s.s_suppkey AS STRING) || '.5}}' END AS card_revenues,
  CASE WHEN s.s_suppkey % 3 <> 0 THEN '{"end_date": "2024-01-31 00:00:00", "3m": {"days_present": '
       || CAST(s.s_suppkey AS STRING) || ', "daily_coverage_ratio": 0.25}}' ELSE '{"1m": {"days_present": null}}' END AS card_transactions_stability
FROM (SELECT DISTINCT l.l_suppkey, o.o_custkey FROM @lineitem l JOIN @orders o ON l.l_orderkey = o.o_orderkey) x
JOIN @supplier s ON s.s_suppkey = x.l_suppkey JOIN @customer c ON c.c_custkey = x.o_custkey
JOIN @nation n ON n.n_nationkey = s.s_nationkey"""


def landing(spark, d):
    text = LANDING
    for t in TABLES:
        text = text.replace(f"@{t}", f"parquet.`{d}/{t}.parquet`")
    return spark.sql(text)


def _u(cols, decimals=()):
    return sql_stable_uuid({c: c for c in cols}, decimals)


def _duck():
    text = LANDING.replace("STRING", "VARCHAR")
    for t in TABLES:
        text = text.replace(f"@{t}", t)
    return text


_IDS = f"""
landing AS ({_duck()}),
ids AS (
  SELECT *, CASE WHEN sds_supplier_id IS NOT NULL THEN sds_supplier_id ELSE {sql_stable_uuid({'name': 'vendor_name_cleaned'})} END AS v,
    {sql_stable_uuid({'name': 'client_name'})} AS b, CASE WHEN client_ecid IS NOT NULL THEN '{FIRM}' END AS f,
    CASE WHEN trim(vendor_email) <> 'nan' THEN vendor_email END AS email
  FROM landing WHERE filter_employee = 'N')"""
_AUDIT = "true AS is_active, 'ledgerline' AS created_by"


def _sql(ctes, id_name, columns, decimals=(), typed=None):
    """Oracle of a table whose distinct rows are CTE ``r``: id over ``columns``, then types."""
    typed = typed or {}
    out = ", ".join(f"{typed[c]} AS {c}" if c in typed else f'"{c}"' for c in columns)
    ident = sql_stable_uuid({c: f'"{c}"' for c in columns}, decimals)
    return f"WITH {_IDS}, {ctes} SELECT {ident} AS {id_name}, {out}, {_AUDIT} FROM r"


def _union(selects):
    return " UNION ".join(selects)


def _melt(pairs, entity="stg_business_entity_id", fixed=""):
    """UNION (distinct) of (entity, fixed, type, value) over ``{type: expression}``."""
    return _union(f"SELECT DISTINCT v AS {entity}, {fixed} '{t}' AS t, CAST({e} AS VARCHAR) AS x FROM ids WHERE {e} IS NOT NULL"
                  for t, e in pairs.items())


def _melted(pairs, id_name, type_name, value_name, addressed=False, typed=None):
    entity = "related_identifier" if addressed else "stg_business_entity_id"
    fixed = "'business_entity' AS related_identifier_source," if addressed else ""
    cols = [entity] + (["related_identifier_source"] if addressed else []) + [type_name, value_name]
    source = "related_identifier_source, " if addressed else ""
    ctes = (f"m AS ({_melt(pairs, entity, fixed)}), "
            f"r AS (SELECT {entity}, {source} t AS {type_name}, x AS {value_name} FROM m)")
    return _sql(ctes, id_name, cols, typed=typed)


def _no_created(df):
    return df.drop("created_date")


def _run(spark, d, name):
    return _no_created(run_staging(landing(spark, d), tables=[name], mapping=MAPPING)[name])


_CONTACT = (f"CASE WHEN vendor_contact_name IS NOT NULL AND vendor_contact_name <> 'none' THEN "
            f"{sql_stable_uuid({'stg_business_entity_id': 'v', 'contact_name': 'vendor_contact_name'})} END")
_REL = list(S.REL_COLUMNS)
_EDGES = f"""
edges AS (
  SELECT b AS stg_business_entity_id, CAST(NULL AS VARCHAR) AS business_entity_contact_id, '{FIRM}' AS stg_related_business_entity_id,
    CAST(NULL AS VARCHAR) AS related_business_entity_contact_id, 'client' AS business_entity_role, 'firm' AS related_business_entity_role,
    client_ecid, CAST(NULL AS VARCHAR) AS supplier_ecid, CAST(NULL AS VARCHAR) AS client_vendor_id,
    CAST(NULL AS VARCHAR) AS client_vendor_site_id FROM ids
  UNION SELECT v, {_CONTACT}, b, NULL, 'supplier', 'buyer', NULL, NULL, vendor_id, site_id FROM ids
  UNION SELECT v, NULL, '{FIRM}', NULL, 'client', 'firm', NULL, supplier_ecid, NULL, NULL FROM ids WHERE supplier_ecid IS NOT NULL),
rel AS (SELECT *, {_u(_REL)} AS rel_id FROM edges)"""
_REL_TYPES = ("client_ecid", "supplier_ecid", "client_vendor_id", "client_vendor_site_id")
_ENTITY_TYPES = {"tax_id": "vendor_government_id", "dba": "vendor_alternate_name", "trade_register_id": "register_no",
                 "client_vendor_id": "vendor_id", "client_vendor_site_id": "site_id", "client_ecid": "client_ecid",
                 "supplier_ecid": "supplier_ecid"}
_REVENUE = ["card_revenue__1m__average_monthly_amount", "card_revenue__3m__average_monthly_amount",
            "card_revenue__12m__average_monthly_amount"]
_REV_DATES = ["end_date", "card_revenue__1m__start_date", "card_revenue__3m__start_date", "card_revenue__12m__start_date"]
_STAB = [c for c in SPECS["business_entity_card_transactions_stability"].columns
         if c not in ("card_transactions_stability_id", "stg_business_entity_id")]


def _stability_sql():
    def null_of(c):
        kind = "DATE" if c.endswith("start_date") else "VARCHAR" if c.endswith("present") else "DECIMAL(38,6)"
        return f"CAST(NULL AS {kind})"
    value = {"end_date": "TIMESTAMP '2024-01-31 00:00:00'",
             "card_transactions_stability__3m__days_present": "CAST(k AS VARCHAR)",
             "card_transactions_stability__3m__daily_coverage_ratio": "CAST(0.25 AS DECIMAL(38,6))"}
    cols = ", ".join(f'{value.get(c, null_of(c))} AS "{c}"' for c in _STAB)
    return _sql(f"r AS (SELECT DISTINCT v AS stg_business_entity_id, {cols} FROM ids WHERE k % 3 <> 0)",
                "card_transactions_stability_id", ["stg_business_entity_id", *_STAB])


def _revenue_sql():
    amounts = ", ".join(f"CAST({'k + 0.5' if '__1m_' in c else 'NULL'} AS DECIMAL(38,6)) AS {c}" for c in _REVENUE)
    dates = ("DATE '2024-01-31' AS end_date, DATE '2024-01-01' AS card_revenue__1m__start_date, "
             "CAST(NULL AS DATE) AS card_revenue__3m__start_date, CAST(NULL AS DATE) AS card_revenue__12m__start_date")
    names = {"end_date": "card_revenue__end_date"}
    ident = sql_stable_uuid({names.get(c, c): c for c in ["stg_business_entity_id", *_REV_DATES, *_REVENUE]}, _REVENUE)
    return (f"WITH {_IDS}, r AS (SELECT DISTINCT v AS stg_business_entity_id, {dates}, {amounts} FROM ids WHERE k % 2 = 0) "
            f"SELECT {ident} AS revenue_id, *, {_AUDIT} FROM r")


_DET = ["stg_business_entity_id", "business_entity_name", "company_structure", "year_incorporated", "reported_annual_revenue"]
_SPEND = ["stg_payor_business_entity_id", "stg_payee_business_entity_id", "analysis_conducted_dt",
          "analysis_external_reference_id", "analysis_task_id", "analysis_stage", "count_of_invoices", "payment_terms",
          "count_of_payments", "sum_of_payments", "period_start_date", "period_end_date", "payment_ccy",
          "actual_days_payment_outstanding", "payment_mode", "payment_term_days", "payment_terms_discount_ind",
          "payment_terms_discount_rate", "payment_terms_discount_days"]
_SPEND_NUMBERS = ["count_of_invoices", "count_of_payments", "sum_of_payments", "actual_days_payment_outstanding",
                  "payment_term_days", "payment_terms_discount_rate", "payment_terms_discount_days"]
_SPEND_FROM = {"stg_payor_business_entity_id": "b", "stg_payee_business_entity_id": "v", "analysis_conducted_dt": "'20240131'",
               "analysis_external_reference_id": "'UP1'", "analysis_task_id": "task_id", "analysis_stage": "'final'",
               "count_of_invoices": "annual_invoice_count", "sum_of_payments": "annual_spend_usd",
               "period_start_date": "DATE '2024-01-01'", "payment_ccy": "'USD'",
               "period_end_date": "CASE WHEN business_end_date = '20241231' THEN DATE '2024-12-31' END"}
_ADDRESS = {"related_identifier": "v", "related_identifier_source": "'business_entity'", "physical_address_type": "'billing'",
            "street_line_1": "vendor_address_ln_1", "street_line_2": "CAST(NULL AS VARCHAR)", "country": "CAST(NULL AS VARCHAR)",
            "city": "vendor_address_ln_3", "state_province": "CAST(NULL AS VARCHAR)", "postal_code": "vendor_postcode"}
_CARD = {"stg_business_entity_id": "v",
         "association_name": "CASE WHEN ind_card_match = 'Yes' THEN 'visa' ELSE '' END",
         "match_confidence": "CAST(NULL AS VARCHAR)", "matched_level_2": "CASE WHEN visa_matched_level_ii = 'yes' THEN true END",
         "matched_level_3_summary": "CAST(NULL AS BOOLEAN)", "matched_level_3_lineitem": "CAST(NULL AS BOOLEAN)",
         "matched_fleet_ind": "CAST(NULL AS VARCHAR)", "matched_mcc": "visa_matched_mcc",
         "matched_data_quality": "CAST(NULL AS VARCHAR)"}


def _as(columns):
    return ", ".join(f"{e} AS {c}" for c, e in columns.items())


_AGENTS = "CASE WHEN k % 3 <> 0 THEN 'Agent ' || CAST(k AS VARCHAR) || ';Agent B' END"
_CODES = "CASE WHEN stg_codelist IS NULL THEN 'a;b' ELSE 'a;b;c' END"

ORACLES = {
    "business_entity": f"""WITH {_IDS} SELECT stg_business_entity_id, {_AUDIT} FROM (
        SELECT v AS stg_business_entity_id FROM ids UNION SELECT b FROM ids UNION SELECT f FROM ids WHERE f IS NOT NULL)""",
    "business_entity_details": _sql(f"""r AS (
        SELECT v AS stg_business_entity_id, vendor_name_cleaned AS business_entity_name,
               CASE WHEN filter_individual = 'Y' THEN 'individual' ELSE corporate_structures END AS company_structure,
               year_incorporated, vendor_annualrevenue AS reported_annual_revenue FROM ids
        UNION SELECT f, 'firm', NULL, NULL, NULL FROM ids WHERE f IS NOT NULL
        UNION SELECT b, client_name, NULL, NULL, NULL FROM ids)""", "business_entity_details_id", _DET),
    "business_entity_identifiers": _sql(f"""{_EDGES},
      held AS ({_union(f"SELECT rel_id, '{t}' AS t, {t} AS x FROM rel WHERE {t} IS NOT NULL" for t in _REL_TYPES)}),
      m AS ({_melt(_ENTITY_TYPES, 'entity')}),
      a AS (SELECT rel_id AS related_identifier, 'relationship' AS related_identifier_source, t, x FROM held
            UNION SELECT entity, 'business_entity', t, x FROM m
            WHERE NOT EXISTS (SELECT 1 FROM held WHERE held.t = m.t AND held.x = m.x)),
      r AS (SELECT DISTINCT CASE WHEN t IN ('client_ecid', 'supplier_ecid') THEN 'ecid' ELSE t END AS identifier_type,
              x AS identifier_value, related_identifier, related_identifier_source FROM a)""",
        "identifier_id", ["identifier_type", "identifier_value", "related_identifier", "related_identifier_source"]),
    "business_entity_characteristics": _melted(
        {"credit_rating_moody": "('moody;' || vendor_credit_rating_moody || ';' || vendor_credit_rating_moody_date)",
         "cost_of_goods_sold": "vendor_cogs", "registered_agents": f"({_AGENTS})"},
        "characteristics_id", "characteristic_type", "characteristic_value"),
    "business_entity_contacts": _sql("""r AS (
        SELECT v AS stg_business_entity_id, 'Ann ' || CAST(k AS VARCHAR) AS contact_name, unnest(['CEO', 'CFO']) AS contact_title
        FROM ids WHERE k % 2 = 0
        UNION SELECT v, vendor_contact_name, NULL FROM ids WHERE vendor_contact_name IS NOT NULL AND vendor_contact_name <> 'none')""",
        "business_entity_contact_id", ["stg_business_entity_id", "contact_name", "contact_title"]),
    "business_entity_relationships": f"""WITH {_IDS}, {_EDGES} SELECT DISTINCT rel_id AS business_entity_relationship_id,
        {', '.join(_REL)}, {_AUDIT} FROM rel""",
    "business_entity_spend_analysis": _sql(
        "r AS (SELECT DISTINCT " + _as({c: _SPEND_FROM.get(c, "CAST(NULL AS VARCHAR)") for c in _SPEND}) + " FROM ids)",
        "spend_analysis_id", _SPEND, typed={c: f"try_cast({c} AS DECIMAL(38,6))" for c in _SPEND_NUMBERS}),
    "physical_address": _sql(f"r AS (SELECT DISTINCT {_as(_ADDRESS)} FROM ids)", "physical_address_id", list(_ADDRESS)),
    "electronic_address": _melted({"primary": "email", "website": "vendor_website"}, "electronic_address_id",
                                  "electronic_address_type", "electronic_address", addressed=True),
    "telecommunication_address": _melted({"primary": "vendor_phone_number", "mobile": "vendor_phone_number_2"},
                                         "telecommunication_address_id", "telecommunication_address_type", "phone_number",
                                         addressed=True),
    "restrictions": _melted({"do_not_campaign": "filter_do_not_campaign"}, "restriction_id", "restriction_type",
                            "restriction_indicator", addressed=True,
                            typed={"restriction_indicator": "try_cast(restriction_indicator AS BOOLEAN)"}),
    "business_entity_receivables_attribute": _melted(
        {"average_vendor_dso": "vendor_dso", "average_vendor_dpo": "vendor_dpo", "product_segmentation_applicable": f"({_CODES})",
         "payment_tech_used": "(CASE WHEN k % 2 = 1 THEN 'Pay' || CAST(k % 4 AS VARCHAR) END)"},
        "attribute_id", "receivables_attribute_type", "receivables_attribute_value"),
    "business_entity_card_association": f"""WITH {_IDS}, r AS (SELECT DISTINCT {_as(_CARD)} FROM ids
        WHERE ind_card_match IS NOT NULL OR visa_matched_level_ii IS NOT NULL OR visa_matched_mcc IS NOT NULL)
        SELECT {_u([c for c in _CARD if c != 'association_name'])} AS card_association_id, *, {_AUDIT} FROM r""",
    "business_entity_industry_classification": _sql(f"""m AS ({_melt({"level-1": "vendor_industry_lvl_1",
        "trust": "filter_trust", "govt": "filter_govt"}, 'e')}),
      r AS (SELECT e AS stg_business_entity_id, CASE WHEN t LIKE 'level-%' THEN 'bloomberg' ELSE 'internal' END AS classification_type,
              t AS classification_code, x AS classification_description FROM m
            UNION SELECT v, 'naics', substr(vendor_industry_lvl_1, 8), 'D' FROM ids)""",
        "classification_id", ["stg_business_entity_id", "classification_type", "classification_code", "classification_description"]),
    "business_entity_card_revenues": _revenue_sql(),
    "business_entity_card_transactions_stability": _stability_sql(),
}


def _query(name):
    def run(spark, d):
        return _run(spark, d, name)
    return run


for _name in SPECS:
    register(f"staging_run_{_name.removeprefix('business_entity_')}", ORACLES[_name])(_query(_name))


@register("match_from_staging", f"""
WITH {_IDS}, p AS (SELECT DISTINCT v, vendor_name_cleaned AS name, vendor_government_id AS tax FROM ids
                   WHERE vendor_government_id IS NOT NULL)
SELECT a.v AS src_business_entity_id, b.v AS main_business_entity_id, a.tax AS tax_id
FROM p a JOIN p b ON a.tax = b.tax WHERE a.v <> b.v AND 1.0 - levenshtein(a.name, b.name) / length(a.name) >= 0.9""")
def match_from_staging(spark, d):
    """Match (Z1-Z3) on the tables the staging run made: vendors of one tax id with names a letter apart."""
    names = ["business_entity_details", "business_entity_identifiers", "physical_address"]
    made = run_staging(landing(spark, d), tables=names, mapping=MAPPING)
    profile = match.match_profile(made[names[0]], made[names[1]], made[names[2]], entity="stg_business_entity_id")
    profile = profile.withColumnRenamed("stg_business_entity_id", "business_entity_id")
    found = match.flag_duplicates(match.match_scores(profile, profile, threshold=0.9), 0.9).filter("is_duplicate")
    return found.filter("src_business_entity_id <> main_business_entity_id").select(
        "src_business_entity_id", "main_business_entity_id", "tax_id").distinct()
