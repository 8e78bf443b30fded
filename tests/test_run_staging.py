"""The whole landing → 16 staging tables run on an invented landing extract."""

import json

from pyspark.sql import functions as F

from ledgerline.plans import staging as S
from ledgerline.plans.staging_run import (
    DEFAULT_MAPPING, LANDING_COLUMNS, SPECS, TABLE_COLUMNS, landing_mapping, prepare, run_staging,
)

PEOPLE = json.dumps([{"name": "Ann Lee", "titles": ["CEO", "Founder", "Director"]},
                     {"name": "Bo Chan", "titles": ["CFO", "Treasurer", "Secretary"]}])
REVENUE = json.dumps({"end_date": "2024-01-31", "1m": {"start_date": "2024-01-01", "average_monthly_amount": 10.555},
                      "3m": {"start_date": "2023-11-01", "average_monthly_amount": None}})


COLUMNS = list(dict.fromkeys([*LANDING_COLUMNS, *[r[0] for r in DEFAULT_MAPPING], "vendor_credit_rating_moody_date",
                              "vendor_credit_rating_sp_date", "filter_employee", "ind_firm", "extra_id"]))


def _frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], ", ".join(f"{c} string" for c in COLUMNS))


def _row(**kw):
    r = {c: None for c in COLUMNS}
    r.update(kw)
    return r


def test_run_staging_builds_all_tables(spark):
    rows = [
        _row(sds_supplier_id="S1", vendor_name_cleaned="Acme Supply", client_name="Client One", client_ecid="C1",
             vendor_contact_name="Pat Doe", vendor_email="pat@acme.test", vendor_website="acme.test",
             vendor_phone_number="+1-555-0100", filter_do_not_campaign="N", vendor_industry_lvl_1="Industrials",
             vendor_credit_rating_sp="AA", vendor_credit_rating_sp_date="2024-01-01", ind_card_match="Yes",
             visa_matched_level_ii="yes", business_start_date="20240101", business_end_date="20241399",
             annual_spend_usd="1200.50", associated_people=PEOPLE, card_revenues=REVENUE,
             registered_agents="['Agent A', 'Agent B']", technologies='{"vendor_name": "PayCo", "category": "ap"}',
             industries='[{"classification_type": "naics", "classification_code": "4236", '
                        '"classification_description": "Electrical"}]', filter_employee="N",
             card_transactions_stability=json.dumps({"end_date": "2024-01-31 00:00:00",
                                                     "3m": {"days_present": 40, "daily_coverage_ratio": 0.4444444}})),
        _row(sds_supplier_id=None, vendor_name_cleaned="O'Brien Tools", client_name="Client One", client_ecid="C1",
             supplier_ecid="SC2", vendor_email="nan", associated_people="[]", card_revenues="{oops",
             card_transactions_stability='{"1m": {"days_present": null}, "3m": {}}', filter_employee="N"),
        _row(sds_supplier_id="S9", vendor_name_cleaned="Employee Co", client_name="Client One", filter_employee="Y"),
    ]
    out = run_staging(_frame(spark, rows), as_of=F.lit("2024-06-01 00:00:00").cast("timestamp"))
    assert set(out) == set(SPECS)
    counts = {k: v.count() for k, v in out.items()}
    assert counts["business_entity"] == 4                 # S1, O'Brien uuid, buyer, firm (employee row dropped)
    assert counts["business_entity_contacts"] == 7        # 2 people x 3 titles + vendor contact
    assert counts["business_entity_relationships"] == 4   # client→firm, 2 supplier→client, supplier→firm
    assert counts["electronic_address"] == 2              # 'nan' email cleaned away
    assert counts["business_entity_card_revenues"] == 1   # malformed JSON dropped
    assert counts["business_entity_card_transactions_stability"] == 1   # all-empty struct dropped
    st = out["business_entity_card_transactions_stability"].first()
    assert st.card_transactions_stability__3m__days_present == "40"
    assert str(st.card_transactions_stability__3m__daily_coverage_ratio) == "0.444444"
    for name, frame in out.items():
        assert frame.columns[-3:] == ["is_active", "created_by", "created_date"], name
        for k in SPECS[name].keys:
            assert frame.filter(F.col(k).isNull()).count() == 0, (name, k)
    spend = out["business_entity_spend_analysis"].first()
    assert str(spend.sum_of_payments) == "1200.500000" and spend.period_end_date is None
    rev = out["business_entity_card_revenues"].first()
    assert str(rev.card_revenue__1m__average_monthly_amount) == "10.560000"
    chars = {r.characteristic_type: r.characteristic_value for r in out["business_entity_characteristics"].collect()}
    assert chars["credit_rating_sp"] == "sp;AA;2024-01-01" and chars["registered_agents"] == "Agent A;Agent B"


def test_mapping_decides_identifiers_attributes_and_phones(spark):
    mapping = [*DEFAULT_MAPPING, ("extra_id", "business_entity_identifiers", "extra_register_id")]
    rows = [_row(sds_supplier_id="S1", vendor_name_cleaned="Acme", client_name="One", client_ecid="C1", supplier_ecid="SE1",
                 vendor_id="V1", site_id="T1", vendor_government_id="99", vendor_alternate_name="Acme Tools", extra_id="X1",
                 vendor_phone_number="1", vendor_phone_number_2="2", filter_trust="Y", vendor_dso="30",
                 stp_partnershiplist="a;b", stg_codelist="b;c", vendor_cogs="7", filter_individual="Y",
                 corporate_structures="llc", filter_employee="N")]
    out = run_staging(_frame(spark, rows), mapping=spark.createDataFrame(
        [(s, t, c) for s, t, c in mapping], "source_column string, target_table string, target_column string"))
    ids = {(r.identifier_type, r.identifier_value, r.related_identifier_source)
           for r in out["business_entity_identifiers"].collect()}
    entity, rel = "business_entity", "relationship"
    assert ids == {("tax_id", "99", entity), ("dba", "Acme Tools", entity), ("extra_register_id", "X1", entity),
                   ("ecid", "C1", rel), ("ecid", "SE1", rel), ("client_vendor_id", "V1", rel),
                   ("client_vendor_site_id", "T1", rel)}
    roles = {(r.business_entity_role, r.related_business_entity_role, r.business_entity_contact_id is None)
             for r in out["business_entity_relationships"].collect()}
    assert roles == {("client", "firm", True), ("supplier", "buyer", True)}
    assert {r.telecommunication_address_type for r in out["telecommunication_address"].collect()} == {"primary", "mobile"}
    att = {r.receivables_attribute_type: r.receivables_attribute_value
           for r in out["business_entity_receivables_attribute"].collect()}
    assert att == {"average_vendor_dso": "30", "product_segmentation_applicable": "a;b;c"}
    assert [(r.classification_type, r.classification_code) for r in
            out["business_entity_industry_classification"].collect()] == [("internal", "trust")]
    assert {r.characteristic_type for r in out["business_entity_characteristics"].collect()} == {"cost_of_goods_sold"}
    assert {r.company_structure for r in out["business_entity_details"].collect()} == {"individual", None}


def test_only_rows_marked_as_no_employee_and_the_firm_flag(spark):
    rows = [_row(sds_supplier_id="S1", vendor_name_cleaned="A", client_name="One", filter_employee=None),
            _row(sds_supplier_id="S2", vendor_name_cleaned="B", client_name="One", filter_employee="N", ind_firm="Y")]
    out = run_staging(_frame(spark, rows), tables=["business_entity"], firm_flag="ind_firm")["business_entity"]
    assert out.count() == 3                        # S2, the buyer, the firm


def test_many_rows_of_one_vendor_stay_linear(spark):
    """10 000 landing rows of one vendor: every step of E6, E10 and E11 reads and makes a few rows per landing row."""
    n = 10_000
    df = spark.range(n).selectExpr(
        "'S1' sds_supplier_id", "'Acme' vendor_name_cleaned", "concat('Client ', id) client_name", "'N' filter_employee",
        "cast(id % 5 as string) vendor_dso", "'Y' filter_trust", "cast(id % 3 as string) vendor_cogs",
        """'{"vendor_name": "PayCo", "category": "ap"}' technologies""", "\"['A', 'B']\" registered_agents",
        """'[{"classification_type": "naics", "classification_code": "1"}]' industries""")
    names = ["business_entity_receivables_attribute", "business_entity_characteristics",
             "business_entity_industry_classification"]
    out = run_staging(df, tables=names)
    assert [out[k].count() for k in names] == [6, 4, 2]
    for k in names:
        plan = out[k]._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan, k


def test_ids_are_hashed_once_and_never_shuffled(spark):
    """No exchange is keyed by a table's own id, no filter computes one, and the attribute tables share one pass."""
    rows = [_row(sds_supplier_id="S1", vendor_name_cleaned="Acme", client_name="One", client_ecid="C1", supplier_ecid="SE1",
                 vendor_email="a@b.test", vendor_phone_number="1", filter_do_not_campaign="N", filter_trust="Y",
                 associated_people=PEOPLE, card_revenues=REVENUE, ind_card_match="Yes", filter_employee="N")]
    out = run_staging(_frame(spark, rows))
    for name, frame in out.items():
        plan = frame._jdf.queryExecution().executedPlan().toString().split("\n")
        own = SPECS[name].keys[0]
        if name != "business_entity":                 # its id is the entity's, made of the landing row
            assert not any("hashpartitioning(" in x and own + "#" in x for x in plan), name
        assert not any("Filter" in x and "sha2" in x for x in plan), name
    melted = ["electronic_address", "telecommunication_address", "restrictions", "business_entity_characteristics",
              "business_entity_receivables_attribute", "business_entity_industry_classification"]
    for name in melted:
        plan = out[name]._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "attributes-" in plan and "PartitionFilters: [isnotnull(tbl" in plan, name


def test_landing_is_kept_with_the_columns_of_the_wanted_tables(spark):
    full = _row(**{c: "x" for c in COLUMNS if c.startswith(("vendor_", "payment_", "ind_", "visa_"))} | {
        "sds_supplier_id": "S1", "vendor_name_cleaned": "Acme", "client_name": "C", "client_ecid": "C1", "filter_employee": "N",
        "filter_individual": "Y", "stg_codelist": "a;b", "registered_agents": "['A']", "associated_people": PEOPLE,
        "card_revenues": REVENUE})
    landing, m, cfg = _frame(spark, [full]), landing_mapping(None), S.StagingConfig()
    some = set(prepare(landing, m, cfg, "filter_employee", None, ["physical_address", "business_entity_identifiers"]).columns)
    assert {"vendor_country", "vendor_government_id", "vendor_contact_id", "buyer_entity_id"} <= some
    assert some.isdisjoint({"industries", "card_revenues", "vendor_email", "vendor_credit_rating_moody", "payment_terms"})
    every = set(prepare(landing, m, cfg, "filter_employee", None).columns)
    assert {*LANDING_COLUMNS, *m.sources(), "vendor_credit_rating_moody_date"} <= every
    whole = run_staging(landing)
    for name in TABLE_COLUMNS:         # each table on its own reads all that it reads among the others
        alone = run_staging(landing, tables=[name])[name].drop("created_date").collect()
        assert alone == whole[name].drop("created_date").collect(), name
