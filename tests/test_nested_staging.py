"""Nested JSON handling and staging builders on invented fixtures."""

import hashlib
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.catalog.q_staging import PEOPLE_SCHEMA
from ledgerline.functions.keys import stable_uuid
from ledgerline.operators import nested
from ledgerline.operators.reshape import TYPE_RENAMES
from ledgerline.plans import staging as S


def test_double_explode_golden(spark):
    doc = ('[{"name": "Ann Lee", "titles": ["CEO", "Founder", "Director"]},'
           ' {"name": "Bo Chan", "titles": ["CFO", "Treasurer", "Secretary"]},'
           ' {"name": "No Title", "titles": []}]')
    df = spark.createDataFrame([("e1", doc), ("e2", "[]"), ("e3", None), ("e4", "{bad json")],
                               "id string, associated_people string")
    parsed = nested.parse_json(df, "associated_people", PEOPLE_SCHEMA, "_p")
    out = nested.explode_nested(parsed, "_p", "titles", "associated_people", ["id"])
    rows = sorted(tuple(r) for r in out.collect())
    assert len(rows) == 6
    assert rows[0] == ("e1", "Ann Lee", "CEO")
    outer = nested.explode_nested(parsed, "_p", "titles", "associated_people", ["id"], outer=True)
    assert outer.count() == 7   # the person without titles is kept with a NULL title


def test_parse_json_drops_malformed_struct(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    df = spark.createDataFrame([(1, '{"a": 1}'), (2, "{oops"), (3, "{}"), (4, "null"), (5, '{"b": "x"}'),
                                (6, "{'a': 2}")], "id int, j string")
    out = nested.parse_json(df, "j", schema, "p")
    assert sorted(r.id for r in out.collect()) == [1, 5, 6]   # single quotes are accepted


def test_flatten_struct_names(spark):
    schema = T.StructType([T.StructField("end_date", T.StringType()), T.StructField("1m", T.StructType([
        T.StructField("start_date", T.StringType()), T.StructField("amount", T.DoubleType())]))])
    df = spark.createDataFrame([("e1", '{"end_date": "2024-01-31", "1m": {"start_date": "2024-01-01", "amount": 3.5}}')],
                               "id string, card_revenue string")
    flat = nested.flatten(df, [nested.FlattenConfig("card_revenue", schema, "struct", "card_revenue")],
                          ["id"])["card_revenue"]
    assert flat.columns == ["id", "card_revenue__end_date", "card_revenue__1m__start_date", "card_revenue__1m__amount"]


def test_separate_lists_do_not_multiply(spark):
    base = spark.createDataFrame([("e1",)], "id string")
    single_a = spark.createDataFrame([("e1", "x")], "id string, a string")
    single_b = spark.createDataFrame([("e1", "y")], "id string, b string")
    assert nested.combine(base, {"a": single_a, "b": single_b}, "id").count() == 1
    lists = nested.flatten(
        spark.createDataFrame([("e1", '["a","b","c"]', '["1","2"]')], "id string, l1 string, l2 string"),
        [nested.FlattenConfig("l1", T.ArrayType(T.StringType()), "simple_array", "l1"),
         nested.FlattenConfig("l2", T.ArrayType(T.StringType()), "simple_array", "l2")], ["id"])
    assert [tuple(r) for r in lists["l1"].collect()] == [("e1", "a;b;c")]
    assert [tuple(r) for r in lists["l2"].collect()] == [("e1", "1;2")]


def _landing(spark):
    rows = [
        # vendor_id, vendor_name, contact, supplier_ecid, client_id, client_name
        ("S1", "Supplier One", "Pat Doe", None, "C1", "Client One"),
        ("S2", "Supplier Two", None, "SC2", "C1", "Client One"),
    ]
    df = spark.createDataFrame(rows, "vendor_id string, vendor_name string, vendor_contact_name string, "
                                     "supplier_ecid string, client_id string, client_name string")
    return df.select("*", F.col("client_id").alias("client_ecid"), *[F.lit(None).cast("string").alias(c) for c in
                     ("company_structure", "year_incorporated", "reported_annual_revenue")])


def test_relationships_golden(spark):
    ids = S.with_entity_ids(_landing(spark))
    rel = S.build_relationships(ids)
    roles = sorted((r.stg_business_entity_id, r.business_entity_role, r.related_business_entity_role)
                   for r in rel.collect())
    buyer = spark.range(1).select(stable_uuid({"name": F.lit("Client One")}).alias("u")).first().u
    assert roles == sorted([(buyer, "client", "firm"), ("S1", "supplier", "buyer"), ("S2", "supplier", "buyer"),
                            ("S2", "client", "firm")])
    assert all(r.business_entity_contact_id is None for r in rel.collect() if r.related_business_entity_role == "firm")
    contact = [r.business_entity_contact_id for r in rel.collect() if r.stg_business_entity_id == "S1"][0]
    contacts = S.build_contacts(spark.createDataFrame([], "stg_business_entity_id string, contact_name string, "
                                                          "contact_title string"),
                                spark.createDataFrame([("S1", "Pat Doe")], "stg_business_entity_id string, "
                                                                           "contact_name string"))
    assert contacts.first().business_entity_contact_id == contact   # ids agree across tables


def test_identifiers_scope(spark):
    """A (type, value) held by a relationship is dropped for every vendor, or for the edge's vendor only."""
    landing = _landing(spark).withColumns({
        "tax_id": F.lit("SC2"),                                             # the value of another type is not held
        "client_vendor_id": F.when(F.col("vendor_id") == "S1", "V1"),
        "supplier_ecid": F.when(F.col("vendor_id") == "S2", "SC2")})
    ids = S.with_entity_ids(landing)

    def found(cfg):
        return {(r.related_identifier_source, r.identifier_type, r.identifier_value)
                for r in S.build_identifiers(ids, cfg).collect()}
    glob, ent = found(S.StagingConfig()), found(S.StagingConfig(identifier_scope="entity"))
    held = {("relationship", "ecid", "C1"), ("relationship", "ecid", "SC2"), ("relationship", "client_vendor_id", "V1")}
    assert glob == held | {("business_entity", "tax_id", "SC2")}
    # the client's id sits on the client's edge, not on the vendor's, so each vendor keeps it
    assert ent == glob | {("business_entity", "ecid", "C1")}


def test_entity_and_details(spark):
    ids = S.with_entity_ids(_landing(spark))
    ents = {r.stg_business_entity_id for r in S.build_entity(ids).collect()}
    assert {"S1", "S2", S.StagingConfig().firm_uuid} <= ents and len(ents) == 4
    det = S.build_details(ids)
    assert det.count() == 4 and det.filter(F.col("business_entity_details_id").isNull()).count() == 0


def test_relationship_ids_compat_double_hash(spark):
    ids = S.with_entity_ids(_landing(spark))
    once = S.build_relationships(ids)
    twice = S.build_relationships(ids, S.StagingConfig(compat_double_hash=True))
    again = once.withColumn("is_active", F.lit(True)).select(stable_uuid(
        [*S.REL_COLUMNS, "business_entity_relationship_id", "is_active"]).alias("u"))
    got = {r.business_entity_relationship_id for r in twice.collect()}
    assert got == {r.u for r in again.collect()}
    assert got.isdisjoint(r.business_entity_relationship_id for r in once.collect())


def _wide_ids(spark):
    rows = [(f"v{i % 4}", None if i % 3 else f"p{i % 4}", f"b{i % 5}", f"c{i % 5}", "c1" if i % 4 == 1 else None, f"t{i % 2}",
             f"x{i % 4}") for i in range(40)] + [("b1", None, "b1", "c1", "c1", "t9", None)]
    return spark.createDataFrame(rows, "vendor_entity_id string, vendor_contact_id string, buyer_entity_id string, "
                                 "client_ecid string, supplier_ecid string, tax_id string, client_vendor_id string")


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_edges_and_identifiers_are_shuffled_once(spark):
    """Each edge and each of its identifiers passes one exchange; only entities' identifiers meet the held ones."""
    ids = _wide_ids(spark)
    assert _exchanges(S.build_relationships(ids)) == 1
    by_entity = S.build_identifiers(ids, S.StagingConfig(identifier_scope="entity"))
    assert "Join" not in by_entity._jdf.queryExecution().optimizedPlan().toString()


def test_identifiers_of_one_new_type_are_distinct_and_held_by_their_old(spark):
    for scope in ("global", "entity"):
        out = S.build_identifiers(_wide_ids(spark), S.StagingConfig(identifier_scope=scope)).collect()
        assert len({r.identifier_id for r in out}) == len(out)
        own = {(r.related_identifier, r.identifier_type, r.identifier_value) for r in out
               if r.related_identifier_source == "business_entity"}
        clients = {(f"v{i % 4}", "ecid", f"c{i % 5}") for i in range(40)} if scope == "entity" else set()
        clients -= {("b1", "ecid", "c1")}
        if scope == "entity":            # held for v1 as its supplier_ecid, but not as a client_ecid
            assert ("v1", "ecid", "c1") in own
        assert own == clients | {(f"v{i % 4}", "tax_id", f"t{i % 2}") for i in range(40)} | {("b1", "tax_id", "t9")}
        edges = {r.related_identifier for r in out if r.related_identifier_source == "relationship"}
        rel = {r.business_entity_relationship_id for r in S.build_relationships(_wide_ids(spark)).collect()}
        assert edges <= rel and None not in edges


def test_identifiers_read_one_exchange(spark):
    """Edges', entities' and held identifiers come from one exchange; a type that no edge has from one part of the result."""
    for scope in ("global", "entity"):
        out = S.build_identifiers(_wide_ids(spark), S.StagingConfig(identifier_scope=scope))
        out.collect()
        final = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert final.count("functions=[partial_bit_or") == 1
        tax = out.filter("identifier_type = 'tax_id'")
        assert tax._jdf.queryExecution().optimizedPlan().toString().count("bit_or") == 1
        assert tax.count() == len({r.identifier_id for r in out.collect() if r.identifier_type == "tax_id"}) > 0


def test_identifiers_equal_a_plain_version(spark):
    """Missing buyers and vendors, ids that differ in case only, entities that are vendor and buyer, and shared values."""
    rng = random.Random(4)
    names = ["vendor_entity_id", "vendor_contact_id", "buyer_entity_id", "client_ecid", "supplier_ecid", "tax_id",
             "client_vendor_id", "client_vendor_site_id"]
    pools = [["v1", "V1", "v2", "b1", None], ["p1", None], ["b1", "b2", "B2", "v2", None], ["c1", "c2", "c3", None],
             ["c1", "s2", None], ["t1", "c1", None], ["x1", "x2", None], ["x1", "y2", None]]
    rows = [tuple(rng.choice(p) for p in pools) for _ in range(60)]
    rows += [("v1", None, None, "c9", None, None, "x1", "y9"), ("v2", None, None, "c9", "c9", None, None, "y9")]
    ids = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    firm = S.StagingConfig().firm_uuid

    def hashed(*texts):
        x = hashlib.sha256(",".join(t.strip().lower() for t in texts if t).encode()).hexdigest()
        return "-".join((x[:8], x[8:12], x[12:16], x[16:20], x[20:32]))

    for scope in ("global", "entity"):
        rel, held, own = set(), set(), set()
        for r in (dict(zip(names, row)) for row in rows):
            v, b = r["vendor_entity_id"], r["buyer_entity_id"]
            edges = []
            if v and b:
                edges += [(b, hashed("client", "firm", b, firm), ["client_ecid"]),
                          (v, hashed(r["vendor_contact_id"], "supplier", "buyer", v, b), ["client_vendor_id", "client_vendor_site_id"])]
            if v and r["supplier_ecid"]:
                edges.append((v, hashed("client", "firm", v, firm), ["supplier_ecid"]))
            for first, edge, types in edges:
                rel |= {(edge, t, r[t]) for t in types if r[t]}
                held |= {(first if scope == "entity" else None, t, r[t]) for t in types if r[t]}
            own |= {(v, t, r[t]) for t in ["tax_id", *S.VENDOR_LINK_TYPES, "client_ecid", "supplier_ecid"] if v and r[t]}
        own = {(v, t, x) for v, t, x in own if (v if scope == "entity" else None, t, x) not in held}
        want = {(key, source, TYPE_RENAMES.get(t, t), x)
                for some, source in ((rel, "relationship"), (own, "business_entity")) for key, t, x in some}
        got = [tuple(r)[1:] for r in S.build_identifiers(ids, S.StagingConfig(identifier_scope=scope)).collect()]
        assert len(got) == len(set(got)) and set(got) == want
        assert {t for _, s, t, _ in want if s == "business_entity"} >= {"tax_id", "ecid", "client_vendor_site_id"}
