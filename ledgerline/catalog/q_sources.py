"""Sources and sinks (S1-S18) exercised on the driver tables.

Round trips write to a fresh folder under the shared checkpoint directory
(``spark.checkpoint.dir``) and read the result back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.catalog import register
from ledgerline.session import scratch_path, table
from ledgerline.sources import io


def _src(d, name):
    return io.Source("parquet", f"{d}/{name}.parquet")


@register("source_scan_table", "SELECT * FROM supplier")
def source_scan_table(spark, d):
    return io.read_table(spark, _src(d, "supplier"))


@register("source_read_landing", "SELECT DISTINCT * FROM orders WHERE o_orderstatus = 'F'")
def source_read_landing(spark, d):
    return io.read_landing(spark, _src(d, "orders"), "o_orderstatus", "F")


_CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@register("source_csv_roundtrip", "SELECT * FROM customer")
def source_csv_roundtrip(spark, d):
    path = scratch_path(spark, "csv-customer")
    io.write_table(table(spark, d, "customer"), io.Source("csv", path, {"header": "true"}), mode="overwrite")
    return io.read_csv(spark, path, _CUSTOMER_SCHEMA)


@register("source_rejects_csv", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, 'unknown status' AS reason
FROM orders WHERE o_orderstatus = 'P'""")
def source_rejects_csv(spark, d):
    rej = table(spark, d, "orders").filter(F.col("o_orderstatus") == "P").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus",
        F.lit("unknown status").alias("reason"))
    path = io.write_rejects(rej, scratch_path(spark, "rejects"))
    return io.read_csv(spark, path, "o_orderkey string, o_orderstatus string, reason string")


@register("source_partitioned_roundtrip", """
SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O')""")
def source_partitioned_roundtrip(spark, d):
    path = scratch_path(spark, "orders-by-status")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    io.write_table(o, io.Source("parquet", path), mode="overwrite", partition_by=["o_orderstatus"])
    # partition pruning: only the F and O folders are listed and read
    return spark.read.parquet(path).filter(F.col("o_orderstatus").isin("F", "O"))


@register("source_overwrite_where", """
SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_regionkey <> 1
UNION ALL SELECT n_nationkey, upper(n_name) || ' (NEW)', n_regionkey FROM nation WHERE n_regionkey = 1""")
def source_overwrite_where(spark, d):
    n = table(spark, d, "nation")
    new = n.filter(F.col("n_regionkey") == 1).select(
        "n_nationkey", F.concat(F.upper("n_name"), F.lit(" (NEW)")).alias("n_name"), "n_regionkey")
    return io.overwrite_where(new, n, "n_regionkey = 1")


@register("source_dynamic_partition_overwrite", """
SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderstatus = 'P' THEN 'P2' ELSE o_orderstatus END AS o_orderstatus
FROM orders""")
def source_dynamic_partition_overwrite(spark, d):
    path = scratch_path(spark, "orders-dyn")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    io.write_table(o, io.Source("parquet", path), mode="overwrite", partition_by=["o_orderstatus"])
    # replace partition P only: rows move to a renamed status, other partitions untouched
    moved = o.filter(F.col("o_orderstatus") == "P").withColumn("o_orderstatus", F.lit("P2"))
    io.write_partitions(moved, path, ["o_orderstatus"])
    empty_p = o.filter(F.lit(False))
    io.write_partitions(empty_p, path, ["o_orderstatus"])
    base = spark.read.parquet(path)
    # partition P is still on disk (dynamic overwrite never deletes partitions
    # it was not given); retire it explicitly with the predicate form
    return io.overwrite_where(base.filter(F.lit(False)), base, "o_orderstatus = 'P'")


@register("source_evolve", """
SELECT *, CAST(NULL AS DECIMAL(38,6)) AS p_discount FROM part""")
def source_evolve(spark, d):
    return io.evolve(table(spark, d, "part"), {"p_discount": "decimal(38,6)", "p_name": "string"})


@register("source_overwrite_stamp", """
SELECT r_regionkey, r_name, '2024-06-01 00:00:00' AS aud_ld_dts, CAST(NULL AS VARCHAR) AS aud_upd_dts FROM region""")
def source_overwrite_stamp(spark, d):
    out = io.overwrite_load(table(spark, d, "region"), F.lit("2024-06-01 00:00:00").cast("timestamp"),
                            ld_col="aud_ld_dts", upd_col="aud_upd_dts")
    return out.select("r_regionkey", "r_name", F.date_format("aud_ld_dts", "yyyy-MM-dd HH:mm:ss").alias("aud_ld_dts"),
                      F.col("aud_upd_dts").cast("string").alias("aud_upd_dts"))


@register("source_write_all", """
SELECT 'nation' AS table_name, COUNT(*) AS row_count FROM nation
UNION ALL SELECT 'region', COUNT(*) FROM region
UNION ALL SELECT 'supplier', COUNT(*) FROM supplier""")
def source_write_all(spark, d):
    root = scratch_path(spark, "write-all")
    names = ["nation", "region", "supplier"]
    frames = {n: table(spark, d, n) for n in names}
    sinks = {n: io.Source("parquet", f"{root}/{n}") for n in names}
    io.write_all(frames, sinks, mode="overwrite", parallel=4)
    parts = [spark.read.parquet(f"{root}/{n}").agg(F.lit(n).alias("table_name"),
                                                    F.count(F.lit(1)).alias("row_count")) for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("source_backup_copy", "SELECT * FROM region")
def source_backup_copy(spark, d):
    path = scratch_path(spark, "region-backup")
    io.backup(table(spark, d, "region"), path)
    return spark.read.parquet(path)
