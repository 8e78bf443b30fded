"""Column-level operators on the driver tables: keys, cleaning, conformance,
scalar functions and melt."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.catalog import register
from ledgerline.functions import keys as K
from ledgerline.functions import scalar as X
from ledgerline.operators import clean, conform, reshape
from ledgerline.session import table

UUID_SQL_SUPPLIER = K.sql_stable_uuid(
    {"s_suppkey": "s_suppkey", "s_name": "s_name", "s_nationkey": "s_nationkey",
     "s_acctbal": "CAST(s_acctbal AS DECIMAL(18,2))"}, decimals=("s_acctbal",))


# --- keys (K1-K8) -------------------------------------------------------------

@register("keys_stable_uuid", f"""
SELECT s_suppkey, {UUID_SQL_SUPPLIER} AS entity_uuid FROM supplier""")
def keys_stable_uuid(spark, d):
    s = table(spark, d, "supplier")
    cols = {"s_suppkey": F.col("s_suppkey"), "s_name": F.col("s_name"),
            "s_nationkey": F.col("s_nationkey"), "s_acctbal": F.col("s_acctbal").cast("decimal(18,2)")}
    return s.select("s_suppkey", K.stable_uuid(cols, decimals=("s_acctbal",)).alias("entity_uuid"))


# name text with blanks, tabs and no-value tokens mixed in, derived from the data
_NAME_VARIANTS_SPARK = (
    "CASE WHEN c_acctbal < 0 THEN concat(chr(9), c_name, '  ') "
    "WHEN c_acctbal < 500 THEN 'None' WHEN c_acctbal > 9500 THEN ' ' ELSE upper(c_name) END")
_NAME_VARIANTS_SQL = (
    "CASE WHEN c_acctbal < 0 THEN concat(chr(9), c_name, '  ') "
    "WHEN c_acctbal < 500 THEN 'None' WHEN c_acctbal > 9500 THEN ' ' ELSE upper(c_name) END")


@register("keys_stable_uuid_mixed", f"""
SELECT c_custkey, {K.sql_stable_uuid({'name': _NAME_VARIANTS_SQL, 'segment': 'c_mktsegment'})} AS entity_uuid
FROM customer""")
def keys_stable_uuid_mixed(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", K.stable_uuid(
        {"name": F.expr(_NAME_VARIANTS_SPARK), "segment": F.col("c_mktsegment")}).alias("entity_uuid"))


@register("keys_stable_uuid_md5_sorted", """
SELECT s_suppkey,
  concat_ws('-', substr(h,1,8), substr(h,9,4), substr(h,13,4), substr(h,17,4), substr(h,21,12)) AS entity_uuid
FROM (SELECT s_suppkey, md5(array_to_string(list_sort(list_filter(
        [lower(CAST(s_name AS VARCHAR)), lower(CAST(s_nationkey AS VARCHAR))], lambda x: x IS NOT NULL)), ',')) AS h
      FROM supplier)""")
def keys_stable_uuid_md5_sorted(spark, d):
    s = table(spark, d, "supplier")
    return s.select("s_suppkey", K.stable_uuid(["s_name", "s_nationkey"], algo="md5",
                                               sort_values=True).alias("entity_uuid"))


@register("keys_row_key", """
SELECT l_orderkey, l_linenumber,
  sha256(concat_ws('-', 'SRC', COALESCE(CAST(l_orderkey AS VARCHAR), ''), COALESCE(CAST(l_linenumber AS VARCHAR), ''))) AS row_key,
  concat_ws('-', 'SRC', COALESCE(CAST(l_orderkey AS VARCHAR), ''), COALESCE(CAST(l_linenumber AS VARCHAR), '')) AS business_key
FROM lineitem""")
def keys_row_key(spark, d):
    li = table(spark, d, "lineitem")
    parts = [F.lit("SRC"), "l_orderkey", "l_linenumber"]
    return li.select("l_orderkey", "l_linenumber", K.row_key(parts).alias("row_key"),
                     K.business_key(parts).alias("business_key"))


@register("keys_change_hash", """
SELECT o_orderkey, md5(concat_ws('-',
    COALESCE(CAST(o_orderstatus AS VARCHAR), '*~+'),
    COALESCE(CAST(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS VARCHAR), '*~+'),
    COALESCE(CAST(o_custkey AS VARCHAR), '*~+'))) AS md5_key
FROM orders""")
def keys_change_hash(spark, d):
    o = table(spark, d, "orders")
    prio = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return o.select("o_orderkey", K.change_hash(["o_orderstatus", prio, "o_custkey"]).alias("md5_key"))


@register("keys_entity_id", f"""
SELECT c_custkey,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN CASE WHEN c_mktsegment = 'MACHINERY' THEN ' none' ELSE CAST(c_custkey AS VARCHAR) END
       ELSE {K.sql_stable_uuid({'name': 'c_name'})} END AS entity_id,
  CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN CAST(c_custkey AS VARCHAR)
       ELSE {K.sql_stable_uuid({'name': 'c_name'})} END AS entity_id_usable
FROM customer""")
def keys_entity_id(spark, d):
    c = table(spark, d, "customer")
    supplied = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit(" none")) \
                .when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey").cast("string"))
    return c.select("c_custkey", K.entity_id(supplied, "c_name").alias("entity_id"),
                    K.entity_id(supplied, "c_name", usable_only=True).alias("entity_id_usable"))


@register("keys_buyer_and_firm_id", f"""
SELECT n_nationkey, {K.sql_stable_uuid({'name': 'n_name'})} AS buyer_id,
  CASE WHEN n_regionkey = 1 OR n_name LIKE 'C%' THEN '00000000-0000-0000-0000-000000000001' END AS firm_id
FROM nation""")
def keys_buyer_and_firm_id(spark, d):
    n = table(spark, d, "nation")
    client = F.when(F.col("n_regionkey") == 1, F.col("n_nationkey"))
    flag = F.when(F.col("n_name").startswith("C"), F.lit("y"))
    return n.select("n_nationkey", K.stable_uuid({"name": F.col("n_name")}).alias("buyer_id"),
                    K.firm_id("00000000-0000-0000-0000-000000000001", client, flag).alias("firm_id"))


# --- cleaning and predicates (F1-F14) ---------------------------------------

@register("clean_blanks", """
SELECT c_custkey,
  CASE WHEN lower(trim(seg)) IN ('', 'nan') THEN NULL ELSE seg END AS segment_text,
  c_nationkey
FROM (SELECT c_custkey, c_nationkey,
        CASE WHEN c_acctbal < 0 THEN '   ' WHEN c_acctbal < 300 THEN 'NaN' ELSE c_mktsegment END AS seg
      FROM customer)""")
def clean_blanks_q(spark, d):
    c = table(spark, d, "customer")
    seg = F.when(F.col("c_acctbal") < 0, F.lit("   ")).when(F.col("c_acctbal") < 300, F.lit("NaN")) \
           .otherwise(F.col("c_mktsegment"))
    return clean.clean_blanks(c.select("c_custkey", seg.alias("segment_text"), "c_nationkey"))


_PROPS_SQL = ("CASE WHEN event_type = 'error' THEN '{}' WHEN event_type = 'view' THEN '' "
              "WHEN event_type = 'signup' THEN 'null' WHEN event_type = 'click' THEN NULL ELSE props END")


@register("filter_is_empty", f"""
SELECT event_id, ({_PROPS_SQL}) IS NULL OR ({_PROPS_SQL}) IN ('', '[]', '{{}}', 'null') AS props_empty
FROM events""")
def filter_is_empty(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", X.is_empty(F.expr(_PROPS_SQL)).alias("props_empty"))


@register("filter_any_meaningful", """
SELECT o_orderkey, note_a, note_b FROM (
  SELECT o_orderkey,
    CASE WHEN o_orderstatus = 'F' THEN 'null' WHEN o_orderstatus = 'O' THEN o_orderpriority END AS note_a,
    CASE WHEN o_orderpriority LIKE '1%' THEN '' WHEN o_orderpriority LIKE '2%' THEN 'urgent' END AS note_b
  FROM orders)
WHERE (note_a IS NOT NULL AND note_a NOT IN ('', 'null')) OR (note_b IS NOT NULL AND note_b NOT IN ('', 'null'))""")
def filter_any_meaningful(spark, d):
    o = table(spark, d, "orders")
    a = F.when(F.col("o_orderstatus") == "F", F.lit("null")) \
         .when(F.col("o_orderstatus") == "O", F.col("o_orderpriority"))
    b = F.when(F.col("o_orderpriority").startswith("1"), F.lit("")) \
         .when(F.col("o_orderpriority").startswith("2"), F.lit("urgent"))
    df = o.select("o_orderkey", a.alias("note_a"), b.alias("note_b"))
    return clean.keep_meaningful(df, ["note_a", "note_b"])


_PNAME = ("CASE WHEN p_size < 4 THEN 'none' WHEN p_size < 7 THEN 'None' WHEN p_size > 47 THEN '   ' "
          "WHEN p_size = 20 THEN NULL ELSE p_name END")


@register("filter_valid_name", f"""
SELECT p_partkey,
  COALESCE(n IS NOT NULL AND trim(n) <> '' AND trim(n) <> 'none', false) AS valid_person,
  COALESCE(n IS NOT NULL AND trim(n) <> '' AND lower(trim(n)) <> 'none', false) AS valid_agent
FROM (SELECT p_partkey, {_PNAME} AS n FROM part)""")
def filter_valid_name(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.expr(_PNAME).alias("n"))
    return p.select("p_partkey", X.valid_name("n").alias("valid_person"),
                    X.valid_name("n", case_insensitive=True).alias("valid_agent"))


_SID = ("CASE WHEN s_acctbal < 0 THEN 'NULL' WHEN s_acctbal < 1000 THEN ' none ' "
        "WHEN s_acctbal > 9000 THEN ' ' ELSE CAST(s_suppkey AS VARCHAR) END")


@register("filter_valid_id", f"""
SELECT s_suppkey, COALESCE(i IS NOT NULL AND lower(trim(i)) NOT IN ('', 'null', 'none'), false) AS id_valid
FROM (SELECT s_suppkey, {_SID} AS i FROM supplier)""")
def filter_valid_id(spark, d):
    s = table(spark, d, "supplier")
    return s.select("s_suppkey", X.valid_id(F.expr(_SID.replace("VARCHAR", "STRING"))).alias("id_valid"))


@register("filter_drop_null_keys", """
SELECT o_orderkey, prio FROM (
  SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS prio FROM orders)
WHERE o_orderkey IS NOT NULL AND prio IS NOT NULL""")
def filter_drop_null_keys(spark, d):
    o = table(spark, d, "orders")
    df = o.select("o_orderkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("prio"))
    return clean.drop_null_keys(df, ["o_orderkey", "prio"])


@register("filter_yes_no", """
SELECT o_orderkey,
  CASE WHEN lower(trim(t)) = 'yes' THEN true WHEN lower(trim(t)) = 'no' THEN false END AS flag
FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Yes' WHEN 'O' THEN ' no ' ELSE 'maybe' END AS t FROM orders)""")
def filter_yes_no(spark, d):
    o = table(spark, d, "orders")
    t = F.when(F.col("o_orderstatus") == "F", "Yes").when(F.col("o_orderstatus") == "O", " no ").otherwise("maybe")
    return o.select("o_orderkey", X.yes_no(t).alias("flag"))


@register("filter_isin", """
SELECT p_partkey, p_brand FROM part WHERE p_brand IN ('Brand#1', 'Brand#12', 'Brand#23')""")
def filter_isin(spark, d):
    p = table(spark, d, "part")
    return p.filter(F.col("p_brand").isin("Brand#1", "Brand#12", "Brand#23")).select("p_partkey", "p_brand")


@register("filter_fill_blank", """
SELECT c_custkey, COALESCE(CASE WHEN c_acctbal > 0 THEN c_mktsegment END, '') AS segment,
       COALESCE(c_name, '') AS c_name
FROM customer""")
def filter_fill_blank(spark, d):
    c = table(spark, d, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("segment"), "c_name")
    return clean.fill_blank_strings(c)


# --- conformance (P1-P9) -----------------------------------------------------

@register("conform_apply_mapping", """
SELECT c_custkey AS customer_id, c_name AS business_entity_name, c_nationkey AS country_code,
       c_acctbal, c_mktsegment AS segment
FROM customer""")
def conform_apply_mapping(spark, d):
    c = table(spark, d, "customer")
    rows = [
        {"source_table": "landing", "source_column": " C_CUSTKEY", "target_table": "details", "target_column": "customer_id"},
        {"source_table": "landing", "source_column": "c_name", "target_table": "details", "target_column": "business_entity_name"},
        {"source_table": "landing", "source_column": "c_name", "target_table": "contacts", "target_column": "contact_name"},
        {"source_table": "landing", "source_column": "c_nationkey", "target_table": "details", "target_column": "country_code"},
        {"source_table": "landing", "source_column": "c_acctbal", "target_table": "details", "target_column": "nomapping"},
        {"source_table": "landing", "source_column": "c_mktsegment", "target_table": "details", "target_column": "Segment"},
    ]
    return conform.apply_mapping(c, conform.mapping_dict(rows, target_table="details"))


@register("conform_ensure_columns", """
SELECT *, CAST(NULL AS DATE) AS effective_date, CAST(NULL AS DOUBLE) AS spend_amount,
       CAST(NULL AS VARCHAR) AS note
FROM nation""")
def conform_ensure_columns(spark, d):
    n = table(spark, d, "nation")
    return conform.ensure_columns(n, ["n_name", "effective_date", "spend_amount", "note"])


@register("conform_project", """
SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS customer_id, c_mktsegment AS segment,
       CAST(c_acctbal AS DECIMAL(38,6)) AS balance, true AS is_active, 'loader' AS created_by
FROM customer WHERE c_mktsegment IS NOT NULL""")
def conform_project(spark, d):
    spec = conform.OutputSpec("customer_profile", {
        "customer_id": "CAST(c_custkey AS STRING)",
        "segment": "c_mktsegment",
        "balance": "CAST(c_acctbal AS DECIMAL(38,6))",
    }, keys=("customer_id", "segment"))
    return conform.project(table(spark, d, "customer"), spec, created_by="loader").drop("created_date")


# --- scalar functions (X1-X19) ----------------------------------------------

@register("scalar_concat", """
SELECT c_custkey,
  concat_ws(':', CASE WHEN c_acctbal > 0 THEN c_name END, CASE WHEN c_acctbal > 5000 THEN c_mktsegment END) AS joined_ws,
  CASE WHEN c_acctbal > 5000 THEN 'sp;' || c_mktsegment || ';' || CAST(c_nationkey AS VARCHAR) END AS joined_strict
FROM customer""")
def scalar_concat(spark, d):
    c = table(spark, d, "customer")
    a = F.when(F.col("c_acctbal") > 0, F.col("c_name"))
    b = F.when(F.col("c_acctbal") > 5000, F.col("c_mktsegment"))
    return c.select("c_custkey", F.concat_ws(":", a, b).alias("joined_ws"),
                    X.rating_triple("sp", b, F.col("c_nationkey").cast("string")).alias("joined_strict"))


@register("scalar_merge_lists", """
SELECT doc_id, CASE WHEN len(u) > 0 THEN array_to_string(list_sort(u), ';') END AS merged FROM (
  SELECT doc_id, list_distinct(list_concat(
      COALESCE(string_split(lang || ';' || source, ';'), []),
      COALESCE(string_split(CASE WHEN n_chars > 1000 THEN 'long;' || lang END, ';'), []))) AS u
  FROM documents)""")
def scalar_merge_lists(spark, d):
    # order inside the merged list is engine-specific; the check sorts it
    doc = table(spark, d, "documents")
    a = F.concat_ws(";", "lang", "source")
    b = F.when(F.col("n_chars") > 1000, F.concat(F.lit("long;"), F.col("lang")))
    merged = X.merge_lists(a, b)
    return doc.select("doc_id", F.array_join(F.array_sort(F.split(merged, ";")), ";").alias("merged"))


@register("scalar_text_probe", """
SELECT c_custkey, CAST(length(c_name) AS INTEGER) AS name_length, ascii(substr(c_name, 1, 1)) AS first_char_code,
       substr(c_name, 1, 8) AS name_prefix8, CAST(levenshtein(c_name, 'Customer#000000001') AS INTEGER) AS lev
FROM customer""")
def scalar_text_probe(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", F.length("c_name").alias("name_length"),
                    X.first_char_code("c_name").alias("first_char_code"),
                    F.substring("c_name", 1, 8).alias("name_prefix8"),
                    F.levenshtein("c_name", F.lit("Customer#000000001")).alias("lev"))


@register("scalar_round", """
SELECT l_orderkey, l_linenumber,
  round(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)), 2) AS net_round,
  CAST(round_even(CAST(l_quantity AS DECIMAL(18,1)) / 2, 0) AS DECIMAL(18,0)) AS half_qty_even
FROM lineitem""")
def scalar_round(spark, d):
    li = table(spark, d, "lineitem")
    net = (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)")
    return li.select("l_orderkey", "l_linenumber", F.round(net, 2).cast("decimal(18,2)").alias("net_round"),
                     F.bround(F.col("l_quantity").cast("decimal(18,1)") / 2, 0).cast("decimal(18,0)").alias("half_qty_even"))


@register("scalar_parse_date", """
SELECT o_orderkey, CAST(try_strptime(t, '%Y%m%d') AS DATE) AS parsed
FROM (SELECT o_orderkey,
        CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y%m') || '99'
             ELSE strftime(o_orderdate, '%Y%m%d') END AS t FROM orders)""")
def scalar_parse_date(spark, d):
    o = table(spark, d, "orders")
    t = F.when(F.col("o_orderstatus") == "P", F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lit("99"))) \
         .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return o.select("o_orderkey", X.parse_date(t, "yyyyMMdd").alias("parsed"))


@register("scalar_julian", """
SELECT o_orderkey,
  CASE WHEN j IS NOT NULL AND j <> 0 THEN strftime(CAST(strptime(CAST(j + 1900000 AS VARCHAR), '%Y%j') AS DATE), '%Y%m%d') END AS ymd
FROM (SELECT o_orderkey,
        CASE WHEN o_orderstatus = 'P' THEN 0
             ELSE (year(o_orderdate) - 1900) * 1000 + dayofyear(o_orderdate) END AS j FROM orders)""")
def scalar_julian(spark, d):
    o = table(spark, d, "orders")
    j = F.when(F.col("o_orderstatus") == "P", F.lit(0)) \
         .otherwise((F.year("o_orderdate") - 1900) * 1000 + F.dayofyear("o_orderdate"))
    return o.select("o_orderkey", X.julian_to_text(j).alias("ymd"))


@register("scalar_scaled_decimal", """
SELECT l_orderkey, l_linenumber,
  CAST(CAST(CAST(round(l_quantity * 10000) AS BIGINT) AS DECIMAL(38,0)) / 10000 AS DECIMAL(38,5)) AS qty
FROM lineitem""")
def scalar_scaled_decimal(spark, d):
    li = table(spark, d, "lineitem")
    raw = F.round(F.col("l_quantity") * 10000).cast("bigint")
    return li.select("l_orderkey", "l_linenumber", X.scaled_decimal(raw).alias("qty"))


@register("scalar_greatest_change", """
SELECT o_orderkey, CAST(greatest(COALESCE(upd, ld, TIMESTAMP '1900-01-01 00:00:00'),
                           COALESCE(NULL, ld2, TIMESTAMP '1900-01-01 00:00:00')) AS VARCHAR) AS changed_at,
  (CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) + (CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END) AS n_true
FROM (SELECT o_orderkey, o_orderstatus, o_totalprice,
        CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 10 DAY END AS upd,
        CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS ld,
        CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate + INTERVAL 20 DAY END AS ld2
      FROM orders)""")
def scalar_greatest_change(spark, d):
    o = table(spark, d, "orders")
    upd = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("INTERVAL 10 DAYS"))
    ld = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    ld2 = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderdate") + F.expr("INTERVAL 20 DAYS"))
    ts = X.latest_change([(upd, ld), (F.lit(None).cast("timestamp"), ld2)])
    return o.select("o_orderkey",
                    F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("changed_at"),
                    X.count_true([F.col("o_orderstatus") == "F", F.col("o_totalprice") > 100000]).alias("n_true"))


# --- melt (M1-M4) -------------------------------------------------------------

@register("reshape_melt", """
SELECT DISTINCT related_identifier, attribute_type, attribute_value FROM (
  SELECT CAST(s_suppkey AS VARCHAR) AS related_identifier, 'nation' AS attribute_type, CAST(s_nationkey AS VARCHAR) AS attribute_value FROM supplier
  UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'balance', CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) FROM supplier
  UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'overdrawn', CASE WHEN s_acctbal < 0 THEN 'Y' END FROM supplier)
WHERE attribute_value IS NOT NULL""")
def reshape_melt(spark, d):
    s = table(spark, d, "supplier").select(
        F.col("s_suppkey").cast("string").alias("related_identifier"),
        F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").cast("decimal(18,2)").alias("balance"),
        F.when(F.col("s_acctbal") < 0, F.lit("Y")).alias("overdrawn"))
    return reshape.melt(s, "related_identifier", ["nation", "balance", "overdrawn"],
                        ("attribute_type", "attribute_value"))


@register("reshape_melt_multi_id", """
SELECT DISTINCT l_orderkey, l_linenumber, k, v FROM (
  SELECT l_orderkey, l_linenumber, 'returnflag' AS k, l_returnflag AS v FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'linestatus', l_linestatus FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'quantity', CAST(CAST(l_quantity AS DECIMAL(12,2)) AS VARCHAR) FROM lineitem)
WHERE v IS NOT NULL""")
def reshape_melt_multi_id(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_returnflag").alias("returnflag"),
        F.col("l_linestatus").alias("linestatus"), F.col("l_quantity").cast("decimal(12,2)").alias("quantity"))
    return reshape.melt(li, ["l_orderkey", "l_linenumber"], ["returnflag", "linestatus", "quantity"], ("k", "v"))
