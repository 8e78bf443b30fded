"""Landing → staging tables (E1-E16), one function per output table.

Inputs are a conformed *landing* frame (one row per vendor × client link,
string columns named as in :data:`LANDING_COLUMNS`) plus, for the nested
tables, frames already parsed from JSON.  Each builder is a composition of
library operators and returns a lazy DataFrame; :func:`run_staging` returns
all of them as a dict so the caller writes them once.

Identifiers follow the stable-id rule (:func:`ledgerline.functions.keys.
stable_uuid`), hashed once over the business columns of each row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.keys import entity_id, firm_id, stable_bytes, stable_uuid, uuid_of
from ledgerline.functions.scalar import (
    any_meaningful, any_not_null, parse_date, rating_triple, valid_name, yes_no,
)
from ledgerline.operators.dedupe import distinct_wide
from ledgerline.operators.reshape import TYPE_RENAMES, class_of, melt, rename_types

# Tags of the polymorphic foreign key.
SOURCE_ENTITY = "business_entity"
SOURCE_RELATIONSHIP = "relationship"
# Company structure of a private person.
INDIVIDUAL = "individual"
# Identifier types of an entity, and those that sit on a relationship.
CLIENT_ECID, SUPPLIER_ECID = "client_ecid", "supplier_ecid"
VENDOR_LINK_TYPES = ("client_vendor_id", "client_vendor_site_id")
# Address type of the vendor address.
BILLING = "billing"
# Association name of a card match.
CARD_ASSOCIATION = "visa"


@dataclass(frozen=True)
class Roles:
    """Relationship role names (configurable; newest naming is the default).

    An edge to the firm is client → firm, from clients and from suppliers that
    carry an id of their own; an edge to a client is supplier → buyer.
    """
    client: str = "client"
    firm: str = "firm"
    supplier: str = "supplier"
    buyer: str = "buyer"


@dataclass(frozen=True)
class StagingConfig:
    firm_uuid: str = "00000000-0000-0000-0000-000000000001"
    firm_name: str = "firm"
    roles: Roles = field(default_factory=Roles)
    identifier_scope: str = "global"     # "global" (reference) or "entity"
    # ids of relationships hashed a second time over (edge, first id, is_active),
    # reproducing ids of data loaded by the older jobs
    compat_double_hash: bool = False


def relationship_id(cfg: StagingConfig = StagingConfig(), edge: Mapping[str, Column] | None = None) -> Column:
    """Relationship id: K1 over the edge columns (hashed twice in compat mode)."""
    cols = dict(edge) if edge else {c: F.col(c) for c in REL_COLUMNS}
    first = stable_uuid(cols)
    if not cfg.compat_double_hash:
        return first
    cols["business_entity_relationship_id"] = first
    cols["is_active"] = F.lit(True)
    return stable_uuid(cols)


def _relationship_bytes(cfg: StagingConfig, edge: Mapping[str, Column]) -> Column:
    """The 16 bytes of :func:`relationship_id`."""
    if cfg.compat_double_hash:
        return F.unhex(F.replace(relationship_id(cfg, edge), F.lit("-"), F.lit("")))
    return stable_bytes(dict(edge))


# ---------------------------------------------------------------------------
# ids carried by every landing row

def with_vendor_ids(df: DataFrame, id_col: str = "vendor_id", name_col: str = "vendor_name") -> DataFrame:
    """Vendor entity id (K6) and the vendor contact id, from vendor columns."""
    vid = entity_id(id_col, name_col)
    out = df.select("*", vid.alias("vendor_entity_id"))
    return out.select("*", F.when(valid_name("vendor_contact_name"), stable_uuid(
        {"stg_business_entity_id": F.col("vendor_entity_id"),
         "contact_name": F.col("vendor_contact_name")})).alias("vendor_contact_id"))


def with_client_ids(df: DataFrame, cfg: StagingConfig = StagingConfig(), id_col: str = "client_id",
                    flag: str | None = None) -> DataFrame:
    """Buyer entity id (K7) and firm marker (K8), from client columns; ``flag``
    names a column that marks the firm with ``Y`` besides the client id."""
    return df.select("*", stable_uuid({"name": F.col("client_name")}).alias("buyer_entity_id"),
                     firm_id(cfg.firm_uuid, client_id=F.col(id_col), flag=flag).alias("firm_entity_id"))


def with_entity_ids(landing: DataFrame, cfg: StagingConfig = StagingConfig()) -> DataFrame:
    """All ids of a wide landing frame (one row per vendor × client link).

    When vendors and clients come from their own tables, prefer
    :func:`link_entity_ids`, which hashes once per entity instead of once per
    link row.
    """
    return with_client_ids(with_vendor_ids(landing), cfg)


def link_entity_ids(links: DataFrame, vendors: DataFrame, clients: DataFrame, vendor_key: str,
                    client_key: str, cfg: StagingConfig = StagingConfig()) -> DataFrame:
    """Ids for vendor × client links whose attributes live in two dimension
    frames: the ids are computed on the dimensions (one hash per entity) and
    then joined to the links on the given keys."""
    v = with_vendor_ids(vendors)
    c = with_client_ids(clients, cfg)
    # clients first: their few columns, and not the vendors' many, travel with each link to the second join
    out = links.join(c, client_key).join(v, vendor_key)
    return out.select(*v.drop(vendor_key).columns, *c.drop(client_key).columns)


def _stamp(df: DataFrame, id_name: str, id_cols: Sequence[str], decimals: Sequence[str] = ()) -> DataFrame:
    """Prepend a stable id over ``id_cols`` (K1)."""
    return df.select(stable_uuid(list(id_cols), decimals=decimals).alias(id_name), *df.columns)


# ---------------------------------------------------------------------------
# Entities and their details

def build_entity(ids: DataFrame) -> DataFrame:
    """Distinct union of vendor, buyer and firm ids, NULLs dropped (one pass)."""
    every = F.array("vendor_entity_id", "buyer_entity_id", "firm_entity_id")
    return ids.select(F.explode(F.array_compact(every)).alias("stg_business_entity_id")).distinct()


def build_details(ids: DataFrame, cfg: StagingConfig = StagingConfig()) -> DataFrame:
    """Vendor rows ∪ firm row ∪ buyer rows, id = K1 over the row (one pass).

    A vendor whose ``filter_individual`` is ``Y`` has the company structure
    ``individual``, whatever the source says.
    """
    none = F.lit(None).cast("string")
    structure = F.col("company_structure")
    if "filter_individual" in ids.columns:
        structure = F.when(F.col("filter_individual") == "Y", F.lit(INDIVIDUAL)).otherwise(structure)

    def row(entity, name, *rest):
        names = ("stg_business_entity_id", "business_entity_name", "company_structure", "year_incorporated",
                 "reported_annual_revenue")
        return F.when(entity.isNotNull(), F.struct(*[c.alias(n) for c, n in zip((entity, name, *rest), names)]))

    every = F.array(
        row(F.col("vendor_entity_id"), F.col("vendor_name"), structure, F.col("year_incorporated"),
            F.col("reported_annual_revenue")),
        row(F.col("firm_entity_id"), F.lit(cfg.firm_name), none, none, none),
        row(F.col("buyer_entity_id"), F.col("client_name"), none, none, none))
    rows = ids.select(F.explode(F.array_compact(every)).alias("_d")).select("_d.*").distinct()
    return _stamp(rows, "business_entity_details_id", rows.columns)


# ---------------------------------------------------------------------------
# contacts

def build_contacts(people: DataFrame, vendors: DataFrame) -> DataFrame:
    """Exploded people (entity, name, title) ∪ vendor contact names.

    ``people`` has ``stg_business_entity_id, contact_name, contact_title``
    (output of the double explode); ``vendors`` has
    ``stg_business_entity_id, contact_name``.  Names must be valid.
    """
    v = vendors.select("stg_business_entity_id", "contact_name",
                       F.lit(None).cast("string").alias("contact_title"))
    rows = people.select("stg_business_entity_id", "contact_name", "contact_title").unionByName(v)
    rows = rows.filter(valid_name("contact_name") & F.col("stg_business_entity_id").isNotNull()).distinct()
    return _stamp(rows, "business_entity_contact_id", rows.columns)


# ---------------------------------------------------------------------------
# Flattened card metrics

def build_card_revenues(flat: DataFrame, amount_cols: Sequence[str], date_cols: Sequence[str]) -> DataFrame:
    """Flattened revenue struct; typed; all-NULL metric rows dropped; amounts
    rounded to 2 places; id = K1 with amounts as decimals."""
    cols = ["stg_business_entity_id", *date_cols, *amount_cols]
    typed = flat.select(
        "stg_business_entity_id",
        *[parse_date(F.col(c), "yyyy-MM-dd").alias(c) for c in date_cols],
        *[F.round(F.col(c).cast("decimal(38,6)"), 2).cast("decimal(38,6)").alias(c) for c in amount_cols])
    rows = typed.filter(any_not_null([*date_cols, *amount_cols])).select(*cols).distinct()
    return _stamp(rows, "revenue_id", cols, decimals=amount_cols)


def stamp_card_stability(flat: DataFrame) -> DataFrame:
    """E5 on rows known to carry data: rows of an entity, distinct, K1 over the row.

    The struct has 23 fields; a test over each of its flattened columns would
    be copied once per alias by the optimizer's constraint propagation, so
    rows without data are dropped before, on the struct's text (``parse_json``).
    """
    rows = flat.filter(F.col("stg_business_entity_id").isNotNull()).distinct()
    return _stamp(rows, "card_transactions_stability_id", rows.columns)


def build_card_stability(flat: DataFrame, metric_cols: Sequence[str]) -> DataFrame:
    """E5: flattened stability struct; rows kept when any of a few metrics carries data."""
    return stamp_card_stability(flat.filter(any_meaningful(metric_cols)).select("stg_business_entity_id", *metric_cols))


# ---------------------------------------------------------------------------
# Melted attribute tables

def build_melted(df: DataFrame, id_col: str, columns: Sequence[str], type_name: str, value_name: str,
                 id_name: str, renames: Mapping[str, str] | None = None,
                 source_tag: str | None = None, drop_blank: bool = False,
                 id_out: str = "stg_business_entity_id") -> DataFrame:
    """E6-E11 skeleton: melt → (optional) drop ``''`` → type rename → source tag → K1."""
    m = melt(df.select(F.col(id_col).alias(id_out), *columns), id_out, columns, (type_name, value_name))
    if drop_blank:
        m = m.filter(F.col(value_name) != "")
    if renames:
        m = m.select(id_out, rename_types(type_name, renames).alias(type_name), value_name)
    if source_tag is not None:
        m = m.select(id_out, F.lit(source_tag).alias("related_identifier_source"), type_name, value_name)
    m = m.distinct()
    return _stamp(m, id_name, m.columns)


def build_industry(df: DataFrame, id_col: str, level_cols: Mapping[str, str]) -> DataFrame:
    """Melt classification levels; ``classification_type`` from M4,
    ``classification_code`` = level name, description = value."""
    src = df.select(F.col(id_col).alias("stg_business_entity_id"),
                    *[F.col(c).alias(lvl) for lvl, c in level_cols.items()])
    m = melt(src, "stg_business_entity_id", list(level_cols), ("classification_code", "classification_description"))
    out = m.select("stg_business_entity_id", class_of("classification_code").alias("classification_type"),
                   "classification_code", "classification_description").distinct()
    return _stamp(out, "classification_id", out.columns)


def build_characteristics(df: DataFrame, id_col: str, ratings: Sequence[tuple[str, str, str]],
                          plain: Sequence[str] = ()) -> DataFrame:
    """``(kind, value_col, date_col)`` ratings as ``kind;value;date`` text
    under type ``credit_rating_<kind>`` plus plain attribute columns, melted."""
    cols = {f"credit_rating_{k}": rating_triple(k, F.col(v), F.col(dc)) for k, v, dc in ratings}
    src = df.select(F.col(id_col).alias("stg_business_entity_id"),
                    *[c.alias(n) for n, c in cols.items()], *plain)
    m = melt(src, "stg_business_entity_id", [*cols, *plain], ("characteristic_type", "characteristic_value"))
    return _stamp(m, "characteristics_id", m.columns)


# ---------------------------------------------------------------------------
# E12-E14

def build_physical_address(df: DataFrame, id_col: str, mapping: Mapping[str, str]) -> DataFrame:
    """Rename address columns, tag ``billing`` and the entity source, K1."""
    out = df.select(F.col(id_col).alias("related_identifier"),
                    F.lit(SOURCE_ENTITY).alias("related_identifier_source"),
                    F.lit(BILLING).alias("physical_address_type"),
                    *[F.col(src).alias(dst) for dst, src in mapping.items()]).distinct()
    return _stamp(out, "physical_address_id", out.columns)


def build_card_association(df: DataFrame, id_col: str, match_col: str, level_cols: Mapping[str, str],
                           text_cols: Mapping[str, str]) -> DataFrame:
    """Rows with any card data; ``visa`` when matched else ``''``;
    yes/no flags to booleans; id over all but the match flag."""
    src_cols = [match_col, *level_cols.values(), *text_cols.values()]
    kept = df.filter(any_meaningful(src_cols))
    matched = F.lower(F.trim(F.col(match_col))) == "yes"
    out = kept.select(
        F.col(id_col).alias("stg_business_entity_id"),
        F.when(matched, F.lit(CARD_ASSOCIATION)).otherwise(F.lit("")).alias("association_name"),
        *[yes_no(F.col(src)).alias(dst) for dst, src in level_cols.items()],
        *[F.col(src).alias(dst) for dst, src in text_cols.items()]).distinct()
    idc = [c for c in out.columns if c != "association_name"]
    return _stamp(out, "card_association_id", idc)


def build_spend(df: DataFrame, payor: str, payee: str, date_cols: Mapping[str, str],
                other: Mapping[str, Column], date_format: str = "yyyyMMdd") -> DataFrame:
    """payor/payee ids, dates parsed from text (bad text → NULL), K1.

    There are about as many rows as links, and few are equal.
    """
    out = df.select(F.col(payor).alias("stg_payor_business_entity_id"),
                    F.col(payee).alias("stg_payee_business_entity_id"),
                    *[parse_date(F.col(src), date_format).alias(dst) for dst, src in date_cols.items()],
                    *[c.alias(n) for n, c in other.items()])
    one = distinct_wide(out, ["stg_payor_business_entity_id", "stg_payee_business_entity_id"])
    return _stamp(one, "spend_analysis_id", out.columns)


# ---------------------------------------------------------------------------
# Relationships and identifiers

REL_COLUMNS = ("stg_business_entity_id", "business_entity_contact_id", "stg_related_business_entity_id",
               "related_business_entity_contact_id", "business_entity_role", "related_business_entity_role")


def _edges(ids: DataFrame, cfg: StagingConfig) -> list[tuple[Column, dict[str, Column], tuple[str, ...]]]:
    """The edges of a landing row: condition, edge columns, and the identifier columns it carries.  Those to the firm
    come first and last; their columns follow from the first entity (:func:`_firm_edge`).

    * client → firm for every client of a vendor, with the client's own id;
    * supplier → buyer with the vendor contact, and the ids under which the
      client knows the vendor;
    * supplier → firm (as client → firm, without contact) where the supplier
      carries an id of its own, with that id.
    """
    r = cfg.roles
    none = F.lit(None).cast("string")

    def edge(cond, a, a_contact, b, role_a, role_b, *carried):
        values = (a, a_contact, b, none, F.lit(role_a), F.lit(role_b))
        return cond, dict(zip(REL_COLUMNS, values)), tuple(c for c in carried if c in ids.columns)

    def to_firm(cond, a, *carried):
        return cond, _firm_edge(a, cfg), tuple(c for c in carried if c in ids.columns)

    vendor, buyer = F.col("vendor_entity_id"), F.col("buyer_entity_id")
    both = vendor.isNotNull() & buyer.isNotNull()
    return [to_firm(both, buyer, CLIENT_ECID),
            edge(both, vendor, F.col("vendor_contact_id"), buyer, r.supplier, r.buyer, *VENDOR_LINK_TYPES),
            to_firm(F.col(SUPPLIER_ECID).isNotNull() & vendor.isNotNull(), vendor, SUPPLIER_ECID)]


def _firm_edge(entity: Column, cfg: StagingConfig) -> dict[str, Column]:
    none = F.lit(None).cast("string")
    return dict(zip(REL_COLUMNS, (entity, none, F.lit(cfg.firm_uuid), none, F.lit(cfg.roles.client), F.lit(cfg.roles.firm))))


def _with_contact(ids: DataFrame) -> DataFrame:
    return ids if "vendor_contact_id" in ids.columns else with_vendor_ids(ids)


def build_relationships(ids: DataFrame, cfg: StagingConfig = StagingConfig()) -> DataFrame:
    """Relationship edges, id = K1 over the edge columns.

    One pass: each landing row emits up to three edges, made distinct by one
    exchange; the partial aggregate collapses the many copies of a hot edge
    (every landing row of a client points at the firm) before it.
    """
    rows = F.array(*[F.when(cond, F.struct(*[c.alias(n) for n, c in edge.items()]))
                     for cond, edge, _ in _edges(ids, cfg)])
    edges = _with_contact(ids).select(F.explode(F.array_compact(rows)).alias("_e")).select("_e.*").distinct()
    return edges.select(relationship_id(cfg).alias("business_entity_relationship_id"), *edges.columns)


# Identifier types every landing can carry; a mapping adds others.
IDENTIFIER_TYPES = ("tax_id", "dba", *VENDOR_LINK_TYPES, CLIENT_ECID, SUPPLIER_ECID)


# Places of an identifier's bits: carried by an edge, held by one, an entity's own of an edge's type, carried by its edge
# to the firm, or an entity's own of a type that no edge has; and the number of places.
_REL, _HELD, _OWN, _FIRM, _FREE, _PLACES = 0, 1, 2, 3, 4, 5


def build_identifiers(ids: DataFrame, cfg: StagingConfig = StagingConfig(),
                      types: Sequence[str] = IDENTIFIER_TYPES) -> DataFrame:
    """Relationship identifiers ∪ vendor identifiers that no relationship holds.

    * the identifiers each edge carries (see :func:`_edges`), under the
      relationship's id;
    * each vendor's identifiers (columns of ``ids`` named in ``types``) unless
      the same (type, value) is a relationship identifier.
      ``scope="global"`` compares (type, value) over all relationships
      (reference behaviour: a value shared by many entities is dropped for
      all of them); ``scope="entity"`` also compares the vendor, which is the
      edge's first entity;
    * type names then pass the M3 renames (``client_ecid``/``supplier_ecid``
      → ``ecid``).

    Plan shape: the landing is read once.  Each landing row emits its
    identifiers, the (type, value) pairs that its edges hold among them, and
    one aggregate makes them distinct under their new type names; which types
    they had, and whether as an edge's, an entity's or a held one, are bits
    of a number.  A vendor's identifier that an edge of the same row holds is
    not emitted as its own.  Of an edge to the firm the first entity is
    emitted, and its id made of distinct rows, since very many landing rows
    have the same; only the edges between entities are hashed row by row, and
    their ids travel as 16 bytes.  With scope ``entity`` a held pair has the
    key of the identifier that it rules out, so nothing is left to join.  With
    scope ``global`` the entities' identifiers of the edges' types meet the
    held pairs in an anti join, each side with an exchange of its own, so that
    AQE can split a (type, value) that very many entities have.  All of these
    read the same exchange: that (type, value) is not NULL is tested before
    it, since the join would push that test below the aggregate on its own
    side only and build the exchange twice.  Each part of the result names
    the types it can have, so that a filter on ``identifier_type`` drops the
    parts that have none of it.
    """
    if cfg.identifier_scope not in ("global", "entity"):
        raise ValueError(f"unknown scope {cfg.identifier_scope!r}")
    by_entity = cfg.identifier_scope == "entity"
    held_types = [t for t in types if t in ids.columns]
    edges = _edges(ids, cfg)
    names = list(dict.fromkeys([*held_types, *(t for _, _, carried in edges for t in carried)]))
    groups: dict[str, list[str]] = {}      # types by their new name
    for t in names:
        groups.setdefault(TYPE_RENAMES.get(t, t), []).append(t)
    renamed, most = list(groups), max(map(len, groups.values()))
    between, to_firm = edges[1:-1], (edges[0], edges[-1])

    def new_names(some):
        return dict.fromkeys(TYPE_RENAMES.get(t, t) for _, _, carried in some for t in carried)

    free = [new for new in renamed if new not in new_names(edges)]

    def ident(cond, place, key, rel, t):
        new = TYPE_RENAMES.get(t, t)
        return F.when(cond & F.col(t).isNotNull(), F.struct(
            key.alias("key"), rel.alias("rel"), F.lit(renamed.index(new)).alias("type"),
            F.col(t).cast("string").alias("value"),
            F.lit(1 << (_PLACES * groups[new].index(t) + place)).cast("long").alias("bit")))

    no_key, no_rel = F.lit(None).cast("string"), F.lit(None).cast("binary")
    vendor = F.col("vendor_entity_id")
    rows = [ident(cond, _FIRM, edge[REL_COLUMNS[0]], no_rel, t) for cond, edge, carried in to_firm for t in carried]
    pre = _with_contact(ids)
    for x, (cond, edge, carried) in enumerate(between):
        pre = pre.withColumn(f"_rel{x}", F.when(cond, F.coalesce(_relationship_bytes(cfg, edge), F.lit(b""))))
        rows += [ident(cond, _REL, no_key, F.col(f"_rel{x}"), t) for t in carried]
        rows += [ident(cond, _HELD, edge[REL_COLUMNS[0]] if by_entity else no_key, no_rel, t) for t in carried]
    for t in held_types:
        own = vendor.isNotNull()
        for cond, edge, carried in edges:
            if t in carried:
                own = own & ~(cond & (edge[REL_COLUMNS[0]] == vendor) if by_entity else cond)
        rows.append(ident(own, _FREE if TYPE_RENAMES.get(t, t) in free else _OWN, vendor, no_rel, t))
    # an inner explode of a column would test its size first, by making the rows once more
    seen = (pre.select(F.array_compact(F.array(*rows)).alias("_rows")).select(F.explode_outer("_rows").alias("_i"))
            .filter(F.col("_i").isNotNull()).select("_i.*")
            .filter(F.col("type").isNotNull() & F.col("value").isNotNull())
            .groupBy("key", "rel", "type", "value").agg(F.bit_or("bit").alias("bits")))

    def bits(*places):
        mask = sum(1 << (_PLACES * x) for x in range(most))
        return F.lit(0).cast("long") if not places else F.shiftright("bits", places[0]).bitwiseAND(F.lit(mask)).bitwiseOR(bits(*places[1:]))

    def each_type(places):                 # a row for each of the types that an identifier of a new type had
        which = F.array(*[F.when(bits(*places).bitwiseAND(F.lit(1 << (_PLACES * x))) != 0, F.lit(x)) for x in range(most)])
        return F.explode(which).alias("was")

    def out(df, related, source, of):      # ``of``: the types that the rows can have; a filter on another leaves nothing to read
        name = F.lit(None).cast("string")
        for new in of:
            name = F.when(F.col("type") == renamed.index(new), F.lit(new)).otherwise(name)
        return df.select(related.alias("related_identifier"), source.alias("related_identifier_source"),
                         name.alias("identifier_type"), F.col("value").alias("identifier_value"))

    edge_source, own_source = F.lit(SOURCE_RELATIONSHIP), F.lit(SOURCE_ENTITY)
    # no filter on a column of the aggregate's key here: pushed below it, it would build the exchange anew
    plain = seen.filter(bits(_REL, _FREE) != 0)
    is_own = F.col("key").isNotNull()
    plain = out(plain, F.when(is_own, F.col("key")).when(F.length("rel") > 0, uuid_of(F.col("rel"))),
                F.when(is_own, own_source).otherwise(edge_source), [*new_names(between), *free])
    # two keys can make one id; an edge between entities carries other types
    firm = seen.filter(bits(_FIRM) != 0).select(
        relationship_id(cfg, _firm_edge(F.col("key"), cfg)).alias("related"), "type", "value").distinct()
    own = seen.filter(bits(_OWN) != 0)
    if by_entity:
        own = own.filter(bits(_OWN).bitwiseAND(F.bitwise_not(bits(_HELD, _FIRM))) != 0).select("key", "type", "value")
    else:
        held = seen.filter(bits(_HELD, _FIRM) != 0).select("type", "value", each_type((_HELD, _FIRM))).filter("was is not null")
        own = own.select("key", "type", "value", each_type((_OWN,))).filter("was is not null")
        own = own.join(held, ["type", "value", "was"], "left_anti").select("key", "type", "value").distinct()
    made = plain.unionByName(out(firm, F.col("related"), edge_source, new_names(to_firm))).unionByName(
        out(own, F.col("key"), own_source, new_names(edges)))
    return _stamp(made, "identifier_id", made.columns)
