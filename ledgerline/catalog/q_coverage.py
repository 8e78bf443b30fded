"""Small operators that no other query reaches: readers, conforming steps,
validation, JSON with single quotes, clocks, null keys, query choice, file
loads and multi-batch streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.catalog import register
from ledgerline.catalog.q_streaming import EVENTS_SCHEMA, TARGET_SCHEMA, _changes
from ledgerline.functions.scalar import join_array
from ledgerline.operators import clean, conform, merge, nested, quality
from ledgerline.plans import load
from ledgerline.session import scratch_path, table
from ledgerline.sources import io
from ledgerline.streaming import cdc

AS_OF = "2024-06-01 00:00:00"


# --- S4-S6, S8, S10 readers and writers ----------------------------------------------------

@register("source_read_mapping", """
SELECT 'nation' AS source_table, n_name AS source_column, 'region' AS target_table,
       'r' || CAST(n_regionkey AS VARCHAR) AS target_column FROM nation""")
def source_read_mapping(spark, d):
    """The file has its columns in another order, and one more."""
    n = table(spark, d, "nation").select(
        F.concat(F.lit("r"), F.col("n_regionkey")).alias("Target_Column"), F.lit("x").alias("note"),
        F.lit("nation").alias("source_table"), F.lit("region").alias("target_table"), F.col("n_name").alias("source_column"))
    path = scratch_path(spark, "mapping")
    io.write_table(n, io.Source("csv", path, {"header": "true"}))
    return io.read_mapping(spark, path)


@register("source_read_schema", """
SELECT 'll_nation' AS table_name, COUNT(*) AS n FROM nation UNION ALL SELECT 'll_region', COUNT(*) FROM region""")
def source_read_schema(spark, d):
    for name in ("nation", "region"):
        table(spark, d, name).createOrReplaceGlobalTempView(f"ll_{name}")
    frames = io.read_schema(spark, "global_temp")
    return (frames["ll_nation"].agg(F.lit("ll_nation").alias("table_name"), F.count(F.lit(1)).alias("n"))
            .unionByName(frames["ll_region"].agg(F.lit("ll_region").alias("table_name"), F.count(F.lit(1)).alias("n"))))


@register("source_table_keys", "SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 2")
def source_table_keys(spark, d):
    keys = table(spark, d, "region").select(F.concat(F.lit("T"), F.col("r_regionkey")).alias("table_name"),
                                            F.col("r_regionkey").alias("pk"))
    row = io.table_keys(keys, " t2 ")
    return table(spark, d, "nation").filter(F.col("n_regionkey") == row["pk"]).select("n_nationkey", "n_name")


@register("source_catalog_table", "SELECT p_partkey, p_brand FROM part")
def source_catalog_table(spark, d):
    table(spark, d, "part").createOrReplaceTempView("ll_part")
    return io.read_table(spark, io.Source("table", "ll_part")).select("p_partkey", "p_brand")


@register("source_write_partitions", "SELECT CAST(6 AS BIGINT) AS n_files, COUNT(*) AS n_rows FROM orders")
def source_write_partitions(spark, d):
    path = scratch_path(spark, "orders-six")
    io.write_table(table(spark, d, "orders"), io.Source("parquet", path), partitions=6)
    files = spark.read.parquet(path).select(F.input_file_name().alias("file"))
    return files.agg(F.count_distinct("file").alias("n_files"), F.count(F.lit(1)).alias("n_rows"))


# --- P5, P7-P9 conforming ---------------------------------------------------------------------

@register("conform_fix_void", "SELECT r_regionkey, CAST(NULL AS VARCHAR) AS remark FROM region")
def conform_fix_void(spark, d):
    """A column of NULL type can be written once it is text."""
    path = scratch_path(spark, "void")
    io.write_table(conform.fix_void(table(spark, d, "region").select("r_regionkey", F.lit(None).alias("remark"))),
                   io.Source("parquet", path))
    return spark.read.parquet(path)


@register("conform_suffix", "SELECT n_nationkey AS n_nationkey_stg, n_name AS name_stg FROM nation")
def conform_suffix(spark, d):
    return conform.suffix(table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("name_stg")))


@register("conform_valid_columns", """
SELECT c_custkey, c_name AS stg_name, 'U' AS load_flag FROM customer""")
def conform_valid_columns(spark, d):
    src = table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("stg_name"), "c_acctbal",
                                             F.lit("U").alias("load_flag"))
    return conform.valid_columns(src, ["C_NAME"], {"stg_name": "c_name"}, keys=["C_CUSTKEY"], flag="load_flag")


@register("conform_common_columns", "SELECT s_suppkey, s_name FROM supplier")
def conform_common_columns(spark, d):
    s = table(spark, d, "supplier")
    other = s.select(F.col("s_name").alias("S_NAME"), F.col("s_suppkey").alias("S_SuppKey"), F.lit(1).alias("more"))
    return s.select(*conform.common_columns(s, other))


# --- F8/Q6, F9/O3 ------------------------------------------------------------------------------

@register("quality_validate", """
SELECT COUNT(*) AS n_nations, true AS missing_column_raises, true AS no_rows_raise FROM nation""")
def quality_validate(spark, d):
    n = table(spark, d, "nation")
    quality.validate(n, ["N_NAME", "n_nationkey"])

    def raises(df, required):
        try:
            quality.validate(df, required)
        except ValueError:
            return True
        return False
    return n.agg(F.count(F.lit(1)).alias("n_nations"), F.lit(raises(n, ["no_such"])).alias("missing_column_raises"),
                 F.lit(raises(clean.empty_like(spark, n.schema), ["n_name"])).alias("no_rows_raise"))


@register("clean_empty_like", "SELECT r_regionkey, r_name FROM region")
def clean_empty_like(spark, d):
    r = table(spark, d, "region").select("r_regionkey", "r_name")
    return clean.empty_like(spark, r.schema).unionByName(r)


# --- X5, X17 -------------------------------------------------------------------------------------

@register("nested_single_quotes", """
SELECT s_suppkey, 'Agent ' || CAST(s_suppkey AS VARCHAR) || ';O' || chr(34) || 'B' AS agents FROM supplier""")
def nested_single_quotes(spark, d):
    doc = F.concat(F.lit("['Agent "), F.col("s_suppkey"), F.lit("', 'O\"B']"))
    src = table(spark, d, "supplier").select("s_suppkey", doc.alias("doc"))
    parsed = nested.parse_json(src, "doc", T.ArrayType(T.StringType()), "list")
    return parsed.select("s_suppkey", join_array("list").alias("agents"))


@register("scalar_now_millis", "SELECT n_nationkey, true AS whole_millis, true AS is_now FROM nation")
def scalar_now_millis(spark, d):
    now = merge.now_ms()
    return table(spark, d, "nation").select(
        "n_nationkey", (F.unix_micros(now) % 1000 == 0).alias("whole_millis"),
        (F.unix_micros(F.current_timestamp()) - F.unix_micros(now) < 1000).alias("is_now"))


# --- U4, U5: renamed and NULL keys, the choice of what a duplicate does -----------------------

@register("merge_upsert_null_keys", """
SELECT k, upper(max(c_name)) AS c_name FROM (
  SELECT CASE WHEN c_nationkey <> 7 THEN c_nationkey END AS k, c_name FROM customer) GROUP BY k""")
def merge_upsert_null_keys(spark, d):
    """One row per nation; the NULL nation of the source updates the NULL nation of the target."""
    key = F.when(F.col("c_nationkey") != 7, F.col("c_nationkey"))
    tgt = table(spark, d, "customer").groupBy(key.alias("k")).agg(F.max("c_name").alias("c_name"))
    src = tgt.select(F.col("k").alias("stg_k"), F.upper("c_name").alias("c_name"), F.lit("U").alias("load_flag"))
    return merge.upsert(src, tgt, ["k"], mapping={"stg_k": "k"}, on_duplicates="raise",
                        as_of=F.lit(AS_OF).cast("timestamp")).target


# --- U14, I3, Q5 loads -----------------------------------------------------------------------------

_STAMPS = "CAST(NULL AS TIMESTAMP) AS AUD_LD_DTS, CAST(NULL AS TIMESTAMP) AS AUD_UPD_DTS"


def _nation_config(d, full):
    return load.LoadConfig(
        src_system="erp", src_tbl="nation", tgt_tbl="hub.nation", load_strategy="merge", merge_keys=("n_nationkey",),
        source_sql=f"SELECT n_nationkey, upper(n_name) AS n_name, {_STAMPS} FROM parquet.`{d}/nation.parquet`",
        incremental_sql=f"SELECT n_nationkey, lower(n_name) AS n_name, {_STAMPS} FROM parquet.`{d}/nation.parquet` "
                        "WHERE n_nationkey >= 20", full_load=full)


@register("load_query_choice", """
SELECT 'full' AS run, n_nationkey, upper(n_name) AS n_name FROM nation
UNION ALL SELECT 'incremental', n_nationkey, CASE WHEN n_nationkey >= 20 THEN lower(n_name) ELSE n_name END FROM nation""")
def load_query_choice(spark, d):
    """A full load runs the full query, any other load the incremental one."""
    tgt = table(spark, d, "nation").selectExpr("n_nationkey", "n_name", _STAMPS.split(", ")[0], _STAMPS.split(", ")[1])
    out = [load.run_load(spark, _nation_config(d, full), tgt).target.select(F.lit(name).alias("run"), "n_nationkey", "n_name")
           for name, full in (("full", True), ("incremental", False))]
    return out[0].unionByName(out[1])


@register("load_files_log", """
SELECT 'nation' AS file_name, 'completed' AS status, false AS has_error, COUNT(*) AS n_loaded FROM nation
UNION ALL SELECT 'no_such_file', 'failed', true, 0
UNION ALL SELECT 'region', 'completed', false, COUNT(*) FROM region""")
def load_files_log(spark, d):
    """A file that cannot be read is logged with its error, and the next one still loads."""
    root = scratch_path(spark, "files")
    log = load.job_log(spark, load.load_files(
        ["nation", "no_such_file", "region"], lambda f: table(spark, d, f).write.parquet(f"{root}/{f}")))
    counts = None
    for name in ("nation", "region"):
        one = spark.read.parquet(f"{root}/{name}").agg(F.lit(name).alias("file_name"), F.count(F.lit(1)).alias("n"))
        counts = one if counts is None else counts.unionByName(one)
    return log.join(counts, "file_name", "left").select(
        "file_name", "status", (F.col("error") != "").alias("has_error"), F.coalesce("n", F.lit(0).cast("long")).alias("n_loaded"))


@register("quality_missing_parameters", """
SELECT n_name AS src_tbl, n_regionkey <> 0 AS accepted FROM nation""")
def quality_missing_parameters(spark, d):
    """Config rows, one per nation; those of region 0 name no target table."""
    rows = table(spark, d, "nation").select(
        F.lit("erp").alias("src_system"), F.col("n_name").alias("src_tbl"), F.lit("overwrite").alias("load_strategy"),
        F.when(F.col("n_regionkey") != 0, "hub.t").alias("tgt_tbl"))
    return load.missing_parameters(rows).select("src_tbl", (F.size("missing") == 0).alias("accepted"))


@register("quality_config_rows", """
SELECT o_orderkey AS id, array_to_string(list_filter([
    CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 AND o_custkey % 5 = 1 THEN 'delete_sql' END,
    CASE WHEN (o_orderstatus = 'P' OR o_custkey % 5 = 1) AND o_orderkey % 7 = 0 THEN 'merge_keys' END,
    CASE WHEN o_custkey % 11 = 0 THEN 'tgt_tbl' END], lambda x: x IS NOT NULL), ',') AS missing
FROM orders""")
def quality_config_rows(spark, d):
    """A config table of one row per order: what each row lacks, decided by the executors."""
    o = table(spark, d, "orders")
    status, even = F.col("o_orderstatus"), F.col("o_orderkey") % 2 == 0
    rows = o.select(
        F.col("o_orderkey").alias("id"), F.lit("erp").alias("SRC_SYSTEM"), F.lit("t").alias("src_tbl"),
        F.when(F.col("o_custkey") % 11 != 0, "hub.t").otherwise("  ").alias("tgt_tbl"),
        F.when(status == "P", "scd1").when(status == "F", "overwrite").otherwise("truncate").alias("load_strategy"),
        F.when(F.col("o_orderkey") % 7 != 0, "a, b").otherwise(" , ").alias("tgt_merge_col_nm"),
        F.when(F.col("o_custkey") % 5 == 1, "y").otherwise("N").alias("hard_delete_flag"),
        F.when(even, "SELECT 1").alias("batch_sql_query"))
    out = load.missing_parameters(rows, hash_col="md5_key")
    return out.select("id", F.array_join("missing", ",").alias("missing"))


# --- T2: several micro-batches -----------------------------------------------------------------------

@register("stream_multi_batch", """
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def stream_multi_batch(spark, d):
    """The events as five files, one per micro-batch: the stream ends where the batch result is."""
    folder, root = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    table(spark, d, "events").repartition(5, "event_id").write.parquet(folder)
    sink = cdc.Scd1StreamSink(root, ["user_id"], "md5_key", TARGET_SCHEMA, ["changed_at", "event_id"],
                              guard_col="changed_at", buckets=4)
    src = cdc.stream_source(spark, folder, EVENTS_SCHEMA, options={"maxFilesPerTrigger": "1"})
    cdc.run_scd1_stream(src, sink, scratch_path(spark, "stream-mark"), transform=_changes, timeout_s=600)
    return sink.current(spark).select("user_id", "event_id", "event_type")
