"""Landing extract → the 16 typed staging tables in one call.

:func:`run_staging` takes the wide landing frame (all strings) and the mapping
(source column → target table and column).  The mapping decides which landing
columns become identifiers, attributes, characteristics, addresses and
classifications, so a new attribute is a row in the mapping file and no
change here; :data:`DEFAULT_MAPPING` holds the columns every landing has, and
a mapping file read with :func:`ledgerline.sources.io.read_mapping` replaces
it.  Each table's typed projection (:data:`SPECS`) is applied and the audit
columns are stamped after de-duplication.  Nothing is written; the caller
writes the dict once (e.g. with :func:`ledgerline.sources.io.write_all`).

The id-bearing landing frame, projected to the columns in use, feeds several
outputs.  With ``materialize`` (the default when more than one table is
wanted) it is written as Parquet under the shared ``spark.checkpoint.dir``
when the function is called, so each output reads only the columns it needs.
The attribute tables (E6-E11) come from one pass: each landing row emits one
array of tagged (table, entity, type, code, value) structs, from columns and
from JSON alike, which is exploded, made distinct by one exchange and written
once, split by table.  No output joins two landing-sized frames, and none is
made distinct again after its id is stamped.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.scalar import is_empty, join_array, merge_lists, rating_triple
from ledgerline.operators import nested
from ledgerline.operators.clean import clean_blanks
from ledgerline.operators.conform import NO_MAPPING, OutputSpec, ensure_columns, project
from ledgerline.operators.reshape import EXTERNAL_CLASS, EXTERNAL_LEVELS, INTERNAL_CLASS, TYPE_RENAMES
from ledgerline.plans import staging as S
from ledgerline.session import scratch_path

# Landing columns the staging build reads whatever the mapping says: for ids, and for single tables.
ID_COLUMNS = ("client_name", "client_ecid", "supplier_ecid", "vendor_name_cleaned", "sds_supplier_id", "vendor_contact_name")
TABLE_COLUMNS = {
    "business_entity_details": ("filter_individual",),
    "business_entity_receivables_attribute": ("stg_codelist", "technologies"),
    "business_entity_characteristics": ("registered_agents",),
    "business_entity_contacts": ("associated_people",),
    "business_entity_industry_classification": ("industries",),
    "business_entity_card_revenues": ("card_revenues",),
    "business_entity_card_transactions_stability": ("card_transactions_stability",),
}
LANDING_COLUMNS = (*ID_COLUMNS, *(c for columns in TABLE_COLUMNS.values() for c in columns))

# Target tables of the mapping file, by the part of the run that reads them.
DETAILS, CHARACTERISTICS = "business_entity_details", "business_entity_characteristics"
IDENTIFIERS, RECEIVABLES = "business_entity_identifiers", "business_entity_payment_profile_attribute"
PHYSICAL, TELECOM, ELECTRONIC = "physical_address", "telecommunication_address", "electronic_address"
SPEND, RESTRICTIONS = "business_entity_spend_analysis", "restrictions"
INDUSTRY, CARD = "business_entity_industry_classification", "business_entity_card_association"
# Mapped targets that have a rule of their own.
MERGED_CODES, AGENTS_TARGET, CARD_MATCH = "product_segmentation_applicable", "registered_agents", "ind_card_match"
TECH_TYPE = "payment_tech_used"
# Output tables that the mapping file calls otherwise.
MAPPED_AS = {"business_entity_receivables_attribute": RECEIVABLES}
SPEND_DATES = ("period_start_date", "period_end_date")
CARD_LEVELS = ("matched_level_2", "matched_level_3_summary", "matched_level_3_lineitem")
# targets that come from JSON text and are built by their own step, not melted
JSON_TARGETS = ("associated_tax_ids", "technologies", AGENTS_TARGET)

# Source column, target table, target column.
DEFAULT_MAPPING = tuple(tuple(line.split()) for line in """
vendor_annualrevenue business_entity_details reported_annual_revenue
year_incorporated business_entity_details year_incorporated
corporate_structures business_entity_details company_structure
industry_sector_dso_25 business_entity_characteristics scf_industry_sector_dso_25
industry_sector_dso_50 business_entity_characteristics scf_industry_sector_dso_50
industry_sector_dso_75 business_entity_characteristics scf_industry_sector_dso_75
industry_group_dso_25 business_entity_characteristics scf_industry_group_dso_25
industry_group_dso_50 business_entity_characteristics scf_industry_group_dso_50
industry_group_dso_75 business_entity_characteristics scf_industry_group_dso_75
vendor_credit_rating_moody business_entity_characteristics moody
vendor_credit_rating_sp business_entity_characteristics sp
vendor_credit_revolver_rate business_entity_characteristics credit_revolver_rate
vendor_cogs business_entity_characteristics cost_of_goods_sold
ind_vc_campaign business_entity_characteristics vc_campaigned_previously
virtualcard_accpetance_tier_legacy business_entity_characteristics vc_acceptance_tier_legacy
virtualcard_accpetance_tier_model business_entity_characteristics vc_acceptance_tier_model
virtualcard_accpetance_tier_userdefined business_entity_characteristics vc_acceptance_tier_userdefined
ind_virtual_card_campaign_count business_entity_characteristics vc_campaign_count
vc_campaign_accepts business_entity_characteristics vc_campaign_accepts
registered_agents business_entity_characteristics registered_agents
vendor_government_id business_entity_identifiers tax_id
vendor_alternate_name business_entity_identifiers dba
vendor_id business_entity_identifiers client_vendor_id
site_id business_entity_identifiers client_vendor_site_id
vendor_country physical_address country
vendor_state physical_address state_province
vendor_postcode physical_address postal_code
vendor_address_ln_1 physical_address street_line_1
vendor_address_ln_2 physical_address street_line_2
vendor_address_ln_3 physical_address city
vendor_phone_number telecommunication_address primary_phone_number
vendor_phone_number_2 telecommunication_address mobile
vendor_email electronic_address email
vendor_website electronic_address website
file_uploaded_dt business_entity_spend_analysis analysis_conducted_dt
sds_upload_id business_entity_spend_analysis analysis_external_reference_id
analysis_type business_entity_spend_analysis analysis_stage
annual_invoice_count business_entity_spend_analysis count_of_invoices
payment_terms business_entity_spend_analysis payment_terms
annual_transaction_count business_entity_spend_analysis count_of_payments
annual_spend_usd business_entity_spend_analysis sum_of_payments
business_start_date business_entity_spend_analysis period_start_date
business_end_date business_entity_spend_analysis period_end_date
payment_currency business_entity_spend_analysis payment_ccy
payment_actual_days business_entity_spend_analysis actual_days_payment_outstanding
payment_type business_entity_spend_analysis payment_mode
payment_terms_days business_entity_spend_analysis payment_term_days
payment_terms_discount_ind business_entity_spend_analysis payment_terms_discount_ind
payment_terms_discount_rate business_entity_spend_analysis payment_terms_discount_rate
payment_terms_discount_days business_entity_spend_analysis payment_terms_discount_days
task_id business_entity_spend_analysis analysis_task_id
vendor_dso business_entity_payment_profile_attribute average_vendor_dso
vendor_dpo business_entity_payment_profile_attribute average_vendor_dpo
vendor_dio business_entity_payment_profile_attribute average_vendor_dio
ind_scf business_entity_payment_profile_attribute enrolled_scf_supplier
ind_vc business_entity_payment_profile_attribute enrolled_vc_supplier
ind_virtualcard_concierge business_entity_payment_profile_attribute vc_concierge
ind_virtual_card_vcn business_entity_payment_profile_attribute virtual_card_vcn
vc_recency business_entity_payment_profile_attribute vc_enrollment_duration_years
vc_buyercount business_entity_payment_profile_attribute vc_buyercount
ind_virtualcard_interchange_amount business_entity_payment_profile_attribute vc_interchange_amt
ind_cms business_entity_payment_profile_attribute cms_enrolled
ind_bb business_entity_payment_profile_attribute businessbank_enrolled
ind_vcn business_entity_payment_profile_attribute vcn_payment_accepted
stp_partnershiplist business_entity_payment_profile_attribute product_segmentation_applicable
ind_decline business_entity_payment_profile_attribute stp_ind_decline
has_online_payments business_entity_payment_profile_attribute has_online_payments
throughput_usd business_entity_payment_profile_attribute scf_throughput_usd
avg_spread business_entity_payment_profile_attribute scf_avg_spread
avg_payment_terms business_entity_payment_profile_attribute scf_avg_payment_terms
rate_proposed business_entity_payment_profile_attribute scf_rate_proposed
rate_offered business_entity_payment_profile_attribute scf_rate_offered
esg_discount business_entity_payment_profile_attribute scf_esg_discount
filter_do_not_campaign restrictions do_not_campaign
vendor_industry_lvl_1 business_entity_industry_classification level-1
vendor_industry_lvl_2 business_entity_industry_classification level-2
vendor_industry_lvl_3 business_entity_industry_classification level-3
filter_trust business_entity_industry_classification trust
filter_realestate business_entity_industry_classification real_estate
filter_govt business_entity_industry_classification govt
filter_utilities business_entity_industry_classification utilities
filter_insurance business_entity_industry_classification insurance
filter_fi business_entity_industry_classification fi
visa_match_confidence business_entity_card_association match_confidence
visa_matched_level_ii business_entity_card_association matched_level_2
visa_matched_level_iii_summary business_entity_card_association matched_level_3_summary
visa_matched_level_iii_line_item business_entity_card_association matched_level_3_lineitem
visa_matched_fleet_ind business_entity_card_association matched_fleet_ind
visa_matched_data_quality business_entity_card_association matched_data_quality
visa_matched_mcc business_entity_card_association matched_mcc
ind_card_match business_entity_card_association ind_card_match
""".strip().splitlines())


class LandingMapping:
    """(source column, target column) pairs per target table; a source may have several targets."""

    def __init__(self, rows: Iterable):
        self._pairs: dict[str, list[tuple[str, str]]] = {}
        for r in rows:
            if not isinstance(r, tuple) or hasattr(r, "asDict"):
                r = r.asDict() if hasattr(r, "asDict") else dict(r)
                r = r["source_column"], r["target_table"], r["target_column"]
            source, table, target = (str(x or "").strip().lower() for x in r)
            if source and target and NO_MAPPING not in (source, target):
                self._pairs.setdefault(table, []).append((source, target))

    def pairs(self, table: str) -> list[tuple[str, str]]:
        return list(dict.fromkeys(self._pairs.get(table, ())))

    def source(self, table: str, target: str) -> str | None:
        return next((s for s, t in self.pairs(table) if t == target), None)

    def sources(self, tables: Iterable[str] | None = None) -> list[str]:
        wanted = self._pairs if tables is None else tables
        return sorted({s for table in wanted for s, _ in self.pairs(table)})


# Mapping files are small configuration; a longer one is not a mapping.
MAX_MAPPING_ROWS = 10_000


def landing_mapping(mapping: LandingMapping | DataFrame | Iterable | None) -> LandingMapping:
    if mapping is None:
        return LandingMapping(DEFAULT_MAPPING)
    if isinstance(mapping, DataFrame):
        rows = mapping.limit(MAX_MAPPING_ROWS + 1).collect()
        if len(rows) > MAX_MAPPING_ROWS:
            raise ValueError(f"a mapping has at most {MAX_MAPPING_ROWS} rows")
        return LandingMapping(rows)
    return mapping if isinstance(mapping, LandingMapping) else LandingMapping(mapping)


_S = T.StringType()
PEOPLE = T.ArrayType(T.StructType([T.StructField("name", _S), T.StructField("titles", T.ArrayType(_S))]))
INDUSTRIES = T.ArrayType(T.StructType([T.StructField(n, _S) for n in
                                       ("classification_type", "classification_code", "classification_description")]))
TECHNOLOGIES = T.ArrayType(T.StructType([T.StructField("vendor_name", _S), T.StructField("category", _S)]))
AGENTS = T.ArrayType(_S)
WINDOWS = ("1m", "3m", "12m")
REVENUE = T.StructType([T.StructField("end_date", _S), T.StructField("date_accessible", _S)] + [
    T.StructField(w, T.StructType([T.StructField("start_date", _S),
                                   T.StructField("average_monthly_amount", T.DoubleType())])) for w in WINDOWS])
_STAB_FIELDS = ("days_present", "weeks_present", "months_present", "daily_coverage_ratio",
                "weekly_coverage_ratio", "monthly_coverage_ratio")
STABILITY = T.StructType([T.StructField("end_date", _S), T.StructField("date_accessible", _S)] + [
    T.StructField(w, T.StructType([T.StructField("start_date", _S)] + [
        T.StructField(f, T.IntegerType() if f.endswith("present") else T.DoubleType()) for f in _STAB_FIELDS]))
    for w in WINDOWS])


def _n(c: str) -> str:
    return f"try_cast({c} AS DECIMAL(38,6))"


def _spec(name, cols, keys):
    return OutputSpec(name, {c: (e if e else c) for c, e in cols}, keys=keys)


# Types of the flattened stability columns, taken before their id is made.
STABILITY_TYPES = {
    "end_date": "CAST(try_to_timestamp(card_transactions_stability__end_date) AS TIMESTAMP)",
    **{f"card_transactions_stability__{w}__start_date": f"try_to_date(card_transactions_stability__{w}__start_date)"
       for w in WINDOWS},
    **{f"card_transactions_stability__{w}__{f}":
       f"CAST(card_transactions_stability__{w}__{f} AS STRING)" if f.endswith("present")
       else _n(f"card_transactions_stability__{w}__{f}") for w in WINDOWS for f in _STAB_FIELDS},
}

# Typed projections of the 16 staging tables ({column: SQL expression}).
SPECS = {
    "business_entity": _spec("business_entity", [("stg_business_entity_id", None)], ("stg_business_entity_id",)),
    "business_entity_details": _spec("business_entity_details", [
        ("business_entity_details_id", None), ("stg_business_entity_id", None), ("business_entity_name", None),
        ("company_structure", None), ("year_incorporated", None), ("reported_annual_revenue", None)],
        ("business_entity_details_id", "stg_business_entity_id")),
    "business_entity_identifiers": _spec("business_entity_identifiers", [
        ("identifier_id", None), ("identifier_type", None), ("identifier_value", None),
        ("related_identifier", None), ("related_identifier_source", None)], ("identifier_id", "related_identifier")),
    "business_entity_characteristics": _spec("business_entity_characteristics", [
        ("characteristics_id", None), ("stg_business_entity_id", None), ("characteristic_type", None),
        ("characteristic_value", None)], ("characteristics_id", "stg_business_entity_id")),
    "business_entity_contacts": _spec("business_entity_contacts", [
        ("business_entity_contact_id", None), ("stg_business_entity_id", None), ("contact_name", None),
        ("contact_title", None)], ("business_entity_contact_id", "stg_business_entity_id")),
    "business_entity_relationships": _spec("business_entity_relationships", [
        ("business_entity_relationship_id", None)] + [(c, None) for c in S.REL_COLUMNS],
        ("business_entity_relationship_id", "stg_business_entity_id")),
    "business_entity_spend_analysis": _spec("business_entity_spend_analysis", [
        ("spend_analysis_id", None), ("stg_payor_business_entity_id", None), ("stg_payee_business_entity_id", None),
        ("analysis_conducted_dt", None), ("analysis_external_reference_id", None), ("analysis_task_id", None),
        ("analysis_stage", None), ("count_of_invoices", _n("count_of_invoices")), ("payment_terms", None),
        ("count_of_payments", _n("count_of_payments")), ("sum_of_payments", _n("sum_of_payments")),
        ("period_start_date", None), ("period_end_date", None), ("payment_ccy", None),
        ("actual_days_payment_outstanding", _n("actual_days_payment_outstanding")), ("payment_mode", None),
        ("payment_term_days", _n("payment_term_days")), ("payment_terms_discount_ind", None),
        ("payment_terms_discount_rate", _n("payment_terms_discount_rate")),
        ("payment_terms_discount_days", _n("payment_terms_discount_days"))],
        ("spend_analysis_id", "stg_payee_business_entity_id")),
    "physical_address": _spec("physical_address", [
        ("physical_address_id", None), ("related_identifier", None), ("related_identifier_source", None),
        ("physical_address_type", None), ("street_line_1", None), ("street_line_2", None), ("country", None),
        ("city", None), ("state_province", None), ("postal_code", None)], ("physical_address_id", "related_identifier")),
    "electronic_address": _spec("electronic_address", [
        ("electronic_address_id", None), ("related_identifier", None), ("related_identifier_source", None),
        ("electronic_address_type", None), ("electronic_address", None)], ("electronic_address_id", "related_identifier")),
    "telecommunication_address": _spec("telecommunication_address", [
        ("telecommunication_address_id", None), ("related_identifier", None), ("related_identifier_source", None),
        ("telecommunication_address_type", None), ("phone_number", None)],
        ("telecommunication_address_id", "related_identifier")),
    "restrictions": _spec("restrictions", [
        ("restriction_id", None), ("related_identifier", None), ("related_identifier_source", None),
        ("restriction_type", None), ("restriction_indicator", "try_cast(restriction_indicator AS BOOLEAN)")],
        ("restriction_id", "related_identifier")),
    "business_entity_receivables_attribute": _spec("business_entity_receivables_attribute", [
        ("attribute_id", None), ("stg_business_entity_id", None), ("receivables_attribute_type", None),
        ("receivables_attribute_value", None)], ("attribute_id", "stg_business_entity_id")),
    "business_entity_card_association": _spec("business_entity_card_association", [
        ("card_association_id", None), ("stg_business_entity_id", None), ("association_name", None),
        ("match_confidence", None), ("matched_level_2", None), ("matched_level_3_summary", None),
        ("matched_level_3_lineitem", None), ("matched_fleet_ind", None), ("matched_mcc", None),
        ("matched_data_quality", None)], ("card_association_id", "stg_business_entity_id")),
    "business_entity_industry_classification": _spec("business_entity_industry_classification", [
        ("classification_id", None), ("stg_business_entity_id", None), ("classification_type", None),
        ("classification_code", None), ("classification_description", None)],
        ("classification_id", "stg_business_entity_id")),
    "business_entity_card_revenues": _spec("business_entity_card_revenues", [
        ("revenue_id", None), ("stg_business_entity_id", None), ("end_date", "card_revenue__end_date")] + [
        (f"card_revenue__{w}__start_date", None) for w in WINDOWS] + [
        (f"card_revenue__{w}__average_monthly_amount", None) for w in WINDOWS],
        ("revenue_id", "stg_business_entity_id")),
    "business_entity_card_transactions_stability": _spec(
        "business_entity_card_transactions_stability",
        [("card_transactions_stability_id", None), ("stg_business_entity_id", None), *[(c, None) for c in STABILITY_TYPES]],
        ("card_transactions_stability_id", "stg_business_entity_id")),
}


ENT = "vendor_entity_id"


def _people(ids: DataFrame) -> DataFrame:
    parsed = nested.parse_json(ids.select(ENT, "associated_people").distinct(), "associated_people", PEOPLE, "_p")
    ex = nested.explode_nested(parsed, "_p", "titles", "associated_people", [ENT])
    return ex.select(F.col(ENT).alias("stg_business_entity_id"),
                     F.col("associated_people__name").alias("contact_name"),
                     F.col("associated_people__titles").alias("contact_title"))


# -- E6-E11: one pass for all attribute tables -----------------------------------

def _tagged(table: str, kind, value: Column, code=None) -> Column:
    """One row of an attribute table, NULL where it has no value."""
    text = value.cast("string")
    return F.when(text != "", F.struct(F.lit(table).alias("tbl"), F.lit(kind).alias("kind"),
                                       F.lit(code).cast("string").alias("code"), text.alias("value")))


def _columns_of(table: str, columns: dict[str, Column]) -> Column:
    """Rows of mapped columns: the type is the target's name (renamed), blank values are left out."""
    if table == INDUSTRY:
        return F.array(*[_tagged(table, EXTERNAL_CLASS if t in EXTERNAL_LEVELS else INTERNAL_CLASS, c, t)
                         for t, c in columns.items()])
    return F.array(*[_tagged(table, TYPE_RENAMES.get(t, t), c) for t, c in columns.items()])


def _parsed(c: str, schema: T.DataType) -> Column:
    """JSON text by its schema, NULL where it is empty (an object parses as a one-element array)."""
    return F.when(~is_empty(c), F.from_json(F.col(c), schema, {"mode": "PERMISSIVE", "allowSingleQuotes": "true"}))


def _json_rows(table: str, row) -> Column:
    """An element of a JSON list as a row of ``table``: kind, code and value of ``row``, NULL where it has none."""
    has, kind, code, value = row
    return F.when(has, F.struct(F.lit(table).alias("tbl"), kind.alias("kind"), code.cast("string").alias("code"),
                                value.alias("value")))


def _characteristic_rows(ids, m):
    columns = {}
    for source, target in m.pairs(CHARACTERISTICS):
        if target in JSON_TARGETS:
            continue
        if f"{source}_date" in ids.columns:       # a rating: value and date in one text
            columns[f"credit_rating_{target}"] = rating_triple(target, F.col(source), F.col(f"{source}_date"))
        else:
            columns[target] = F.col(source)
    rows = [_columns_of(CHARACTERISTICS, columns)] if columns else []
    if m.source(CHARACTERISTICS, AGENTS_TARGET):
        agents = join_array(_parsed("registered_agents", AGENTS))
        rows.append(F.array(_json_rows(CHARACTERISTICS, (agents.isNotNull(), F.lit(AGENTS_TARGET), F.lit(None), agents))))
    return rows


def _receivable_rows(ids, m):
    columns = {t: F.col(s) for s, t in m.pairs(RECEIVABLES) if t not in JSON_TARGETS}
    if MERGED_CODES in columns:
        columns[MERGED_CODES] = merge_lists(columns[MERGED_CODES], "stg_codelist")

    def used(e):
        name = e["vendor_name"]
        return _json_rows(RECEIVABLES, ((F.trim(name) != "") & (name != "none"), F.lit(TECH_TYPE), F.lit(None), name))
    tech = F.transform(_parsed("technologies", TECHNOLOGIES), used)
    return [*([_columns_of(RECEIVABLES, columns)] if columns else []), tech]


def _industry_rows(ids, m):
    columns = {t: F.col(s) for s, t in m.pairs(INDUSTRY)}

    def own(e):
        kind, code, text = (e[f"classification_{f}"] for f in ("type", "code", "description"))
        return _json_rows(INDUSTRY, (F.coalesce(kind, code, text).isNotNull(), kind, code, text))
    return [*([_columns_of(INDUSTRY, columns)] if columns else []), F.transform(_parsed("industries", INDUSTRIES), own)]


def _plain_rows(table: str):
    def rows(ids, m):
        columns = {t: F.col(s) for s, t in m.pairs(table)}
        return [_columns_of(table, columns)] if columns else []
    return rows


# Output table: mapping table, its rows, id, polymorphic key?, names of kind, code and value.
ATTRIBUTES = {
    "business_entity_characteristics": (CHARACTERISTICS, _characteristic_rows, "characteristics_id", False,
                                        ("characteristic_type", None, "characteristic_value")),
    "electronic_address": (ELECTRONIC, _plain_rows(ELECTRONIC), "electronic_address_id", True,
                           ("electronic_address_type", None, "electronic_address")),
    "telecommunication_address": (TELECOM, _plain_rows(TELECOM), "telecommunication_address_id", True,
                                  ("telecommunication_address_type", None, "phone_number")),
    "restrictions": (RESTRICTIONS, _plain_rows(RESTRICTIONS), "restriction_id", True,
                     ("restriction_type", None, "restriction_indicator")),
    "business_entity_receivables_attribute": (RECEIVABLES, _receivable_rows, "attribute_id", False,
                                              ("receivables_attribute_type", None, "receivables_attribute_value")),
    "business_entity_industry_classification": (INDUSTRY, _industry_rows, "classification_id", False, (
        "classification_type", "classification_code", "classification_description")),
}


def attribute_rows(ids: DataFrame, m: LandingMapping, wanted: Iterable[str]) -> DataFrame:
    """E6-E11 in one pass: distinct (tbl, entity, kind, code, value) of the ``wanted`` output tables."""
    lists = [rows for name in ATTRIBUTES if name in wanted for rows in ATTRIBUTES[name][1](ids, m)]
    empty = F.array().cast("array<struct<tbl:string,kind:string,code:string,value:string>>")
    every = F.concat(empty, *[F.coalesce(r, empty) for r in lists])
    rows = (ids.where(F.col(ENT).isNotNull())
            .select(F.col(ENT).alias("entity"), F.explode(F.array_compact(every)).alias("_r")))
    return rows.select("_r.tbl", "entity", "_r.kind", "_r.code", "_r.value").distinct()


def attribute_table(rows: DataFrame, name: str) -> DataFrame:
    """One output table of :func:`attribute_rows`, with its names and id."""
    table, _, id_name, addressed, (kind, code, value) = ATTRIBUTES[name]
    mine = rows.where(F.col("tbl") == table)
    if addressed:
        key = [F.col("entity").alias("related_identifier"), F.lit(S.SOURCE_ENTITY).alias("related_identifier_source")]
    else:
        key = [F.col("entity").alias("stg_business_entity_id")]
    out = mine.select(*key, F.col("kind").alias(kind), *([F.col("code").alias(code)] if code else []),
                      F.col("value").alias(value))
    return out.select(S.stable_uuid(list(out.columns)).alias(id_name), *out.columns)


def prepare(landing: DataFrame, m: LandingMapping, cfg: S.StagingConfig, employee_flag: str | None,
            firm_flag: str | None, wanted: Iterable[str] = tuple(SPECS)) -> DataFrame:
    """Landing rows of non-employees, projected to the columns that the ``wanted`` tables use, with all entity ids."""
    df = landing.select(*[F.col(f"`{c}`").alias(c.strip().lower()) for c in landing.columns])
    if employee_flag and employee_flag in df.columns:
        df = df.filter(F.col(employee_flag) == "N")
    mapped = m.sources(MAPPED_AS.get(t, t) for t in wanted)
    used = dict.fromkeys([*ID_COLUMNS, *(c for t in wanted for c in TABLE_COLUMNS.get(t, ())), *mapped])
    if CHARACTERISTICS in wanted:
        used |= dict.fromkeys(f"{s}_date" for s, _ in m.pairs(CHARACTERISTICS) if f"{s}_date" in df.columns)
    if firm_flag:
        used[firm_flag] = None
    df = clean_blanks(ensure_columns(df, {c: "string" for c in used}).select(*used))
    ids = S.with_vendor_ids(df, "sds_supplier_id", "vendor_name_cleaned")
    return S.with_client_ids(ids, cfg, "client_ecid", firm_flag)


def run_staging(landing: DataFrame, cfg: S.StagingConfig = S.StagingConfig(), created_by: str = "ledgerline",
                as_of: Column | None = None, employee_flag: str | None = "filter_employee",
                materialize: bool | None = None, tables=None, mapping=None,
                firm_flag: str | None = None) -> dict[str, DataFrame]:
    """Build the staging tables from a landing extract (see module doc).

    ``tables`` restricts the build to some of the 16 tables (all by default).
    ``mapping`` is a mapping frame, its rows, or nothing for
    :data:`DEFAULT_MAPPING`.  Rows whose ``employee_flag`` is not ``N`` are
    left out.  ``firm_flag`` names a landing column that marks the firm with
    ``Y`` besides the client's own id.
    """
    wanted = set(SPECS) if tables is None else set(tables)
    unknown = wanted - set(SPECS)
    if unknown:
        raise ValueError(f"unknown staging tables {sorted(unknown)}")
    m = landing_mapping(mapping)
    ids = prepare(landing, m, cfg, employee_flag, firm_flag, [name for name in SPECS if name in wanted])
    keep = materialize or (materialize is None and len(wanted) > 1)
    if keep:
        ids = _kept(ids, "landing")
    melted = wanted & set(ATTRIBUTES)
    rows = attribute_rows(ids, m, melted)
    if keep and len(melted) > 1:
        rows = _kept(rows, "attributes", "tbl")
    out = {}
    for name in SPECS:
        if name in wanted:
            made = attribute_table(rows, name) if name in melted else BUILDERS[name](ids, m, cfg)
            # ids are made of distinct rows and hold the entity: nothing to make distinct, no hash to test;
            # an identifier is only ever made for an edge or an entity, and its foreign key may be a hash
            keys = () if name == "business_entity_identifiers" else SPECS[name].keys[-1:]
            out[name] = project(made, replace(SPECS[name], keys=keys), created_by, as_of, distinct=False)
    return out


def _kept(df: DataFrame, name: str, *by: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _of(m: LandingMapping, table: str, target: str) -> Column:
    source = m.source(table, target)
    return F.col(source) if source else F.lit(None).cast("string")


def _details(ids, m, cfg):
    named = ids.withColumns({t: _of(m, DETAILS, t) for t in ("company_structure", "year_incorporated",
                                                             "reported_annual_revenue")})
    return S.build_details(named.withColumn("vendor_name", F.col("vendor_name_cleaned")), cfg)


def _identifiers(ids, m, cfg):
    types = {t: s for s, t in m.pairs(IDENTIFIERS) if t not in JSON_TARGETS}
    own = (S.CLIENT_ECID, S.SUPPLIER_ECID)
    named = ids.select(ENT, "buyer_entity_id", "firm_entity_id", "vendor_contact_id", *own,
                       *[F.col(s).alias(t) for t, s in types.items() if t not in own])
    return S.build_identifiers(named, cfg, (*[t for t in types if t not in own], *own))


def _relationships(ids, m, cfg):
    return S.build_relationships(ids, cfg)


def _contacts(ids, m, cfg):
    own = ids.select(F.col(ENT).alias("stg_business_entity_id"), F.col("vendor_contact_name").alias("contact_name"))
    return S.build_contacts(_people(ids), own)


def _spend(ids, m, cfg):
    pairs = {t: s for s, t in m.pairs(SPEND) if t in SPECS["business_entity_spend_analysis"].columns}
    other = {t: F.col(s) for t, s in pairs.items() if t not in SPEND_DATES}
    if "analysis_conducted_dt" in other:
        other["analysis_conducted_dt"] = F.substring(other["analysis_conducted_dt"], 1, 8)
    for c in SPECS["business_entity_spend_analysis"].columns:
        if c not in (*pairs, "spend_analysis_id", "stg_payor_business_entity_id", "stg_payee_business_entity_id"):
            other[c] = F.lit(None).cast("string")
    return S.build_spend(ids, "buyer_entity_id", ENT, {t: pairs[t] for t in SPEND_DATES if t in pairs}, other)


def _physical(ids, m, cfg):
    pairs = {t: s for s, t in m.pairs(PHYSICAL)}
    columns = ("street_line_1", "street_line_2", "country", "city", "state_province", "postal_code")
    src = ids.select(ENT, *[(F.col(pairs[c]) if c in pairs else F.lit(None).cast("string")).alias(c) for c in columns])
    return S.build_physical_address(src, ENT, {c: c for c in columns})


def _card(ids, m, cfg):
    text = ("match_confidence", "matched_fleet_ind", "matched_mcc", "matched_data_quality")
    src = ids.select(ENT, *[_of(m, CARD, t).alias(t) for t in (CARD_MATCH, *CARD_LEVELS, *text)])
    return S.build_card_association(src, ENT, CARD_MATCH, {t: t for t in CARD_LEVELS}, {t: t for t in text})


def _revenues(ids, m, cfg):
    rev = nested.flatten(ids.select(F.col(ENT).alias("stg_business_entity_id"), "card_revenues").distinct(),
                         [nested.FlattenConfig("card_revenues", REVENUE, "struct", "card_revenue")],
                         ["stg_business_entity_id"])["card_revenues"]
    return S.build_card_revenues(
        rev, [f"card_revenue__{w}__average_monthly_amount" for w in WINDOWS],
        ["card_revenue__end_date"] + [f"card_revenue__{w}__start_date" for w in WINDOWS])


def _stability(ids, m, cfg):
    c = "card_transactions_stability"
    parsed = nested.parse_json(ids.select(F.col(ENT).alias("stg_business_entity_id"), c).distinct(), c, STABILITY, "_p")
    flat = nested.flatten_struct(parsed, "_p", c, ["stg_business_entity_id"])
    return S.stamp_card_stability(flat.select("stg_business_entity_id",
                                              *[F.expr(e).alias(n) for n, e in STABILITY_TYPES.items()]))


BUILDERS = {
    "business_entity": lambda ids, m, cfg: S.build_entity(ids),
    "business_entity_details": _details,
    "business_entity_identifiers": _identifiers,
    "business_entity_contacts": _contacts,
    "business_entity_relationships": _relationships,
    "business_entity_spend_analysis": _spend,
    "physical_address": _physical,
    "business_entity_card_association": _card,
    "business_entity_card_revenues": _revenues,
    "business_entity_card_transactions_stability": _stability,
}
