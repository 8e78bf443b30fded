"""Loads and merges of sources whose columns differ from the target's."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.catalog import register
from ledgerline.functions.keys import change_hash
from ledgerline.operators import incremental, merge
from ledgerline.plans import load
from ledgerline.session import scratch_path, table
from ledgerline.sources import versioned

AS_OF = "2024-06-01 00:00:00"
_STAMPS = {"AUD_LD_DTS": "2024-01-01 00:00:00", "AUD_UPD_DTS": None}


def _as_of():
    return F.lit(AS_OF).cast("timestamp")


def _stamped(df):
    return df.withColumns({c: F.lit(v).cast("timestamp") for c, v in _STAMPS.items()})


def _text(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c.lower())


def _hub_orders(spark, d):
    """Orders as the hub holds them: the priority is known to the hub only."""
    o = table(spark, d, "orders")
    return _stamped(o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
                             change_hash(["o_custkey", "o_orderstatus"]).alias("md5_key")))


def _lake_orders(spark, d):
    """Changed orders: no priority and no time column; the total price is new; half of the keys are new.

    Every third row comes twice, with another status.
    """
    o = table(spark, d, "orders")
    status = F.when(F.col("o_totalprice") > 150_000, F.lower("o_orderstatus")).otherwise(F.col("o_orderstatus"))
    once = o.select((F.col("o_orderkey") * 2).alias("O_ORDERKEY"), "o_custkey", status.alias("o_orderstatus"), "o_totalprice")
    again = once.filter(F.col("O_ORDERKEY") % 3 == 0).withColumn("o_orderstatus", F.lit("Z"))
    both = once.unionByName(again)
    return both.withColumn("md5_key", change_hash(["o_custkey", "o_orderstatus"]))


# Source rows, one per key: the greatest row of a key, compared column by column.
_SOURCE = """
once AS (SELECT o_orderkey * 2 AS k, o_custkey AS cust, CASE WHEN o_totalprice > 150000 THEN lower(o_orderstatus)
                ELSE o_orderstatus END AS status, o_totalprice AS price FROM orders),
twice AS (SELECT k, cust, status, price FROM once UNION ALL SELECT k, cust, 'Z', price FROM once WHERE k % 3 = 0),
src AS (SELECT k, cust, status, price FROM (
          SELECT *, row_number() OVER (PARTITION BY k ORDER BY cust DESC, status DESC, price DESC) AS rn FROM twice)
        WHERE rn = 1)"""


@register("merge_scd1_common_columns", f"""
WITH {_SOURCE}
SELECT o.o_orderkey, CASE WHEN s.k IS NOT NULL THEN s.cust ELSE o.o_custkey END AS o_custkey,
       CASE WHEN s.k IS NOT NULL THEN s.status ELSE o.o_orderstatus END AS o_orderstatus, o.o_orderpriority,
       CASE WHEN s.k IS NOT NULL AND (s.cust <> o.o_custkey OR s.status <> o.o_orderstatus)
            THEN CAST(s.price AS DECIMAL(18,2)) END AS o_totalprice
FROM orders o LEFT JOIN src s ON o.o_orderkey = s.k
UNION ALL
SELECT k, cust, status, NULL, CAST(price AS DECIMAL(18,2)) FROM src WHERE k NOT IN (SELECT o_orderkey FROM orders)""")
def merge_scd1_common_columns(spark, d):
    """An update keeps what only the hub knows, and brings the declared new column."""
    res = merge.scd1_merge(_lake_orders(spark, d), _hub_orders(spark, d), ["o_orderkey"], "md5_key",
                           upd_col="AUD_UPD_DTS", ld_col="AUD_LD_DTS", as_of=_as_of(),
                           evolve="o_totalprice decimal(18,2)")
    return res.target.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")


@register("load_scd1_without_stamps", f"""
WITH {_SOURCE}
SELECT o.o_orderkey, o.o_orderpriority, '2024-01-01 00:00:00' AS aud_ld_dts,
       CASE WHEN s.cust <> o.o_custkey OR s.status <> o.o_orderstatus THEN '{AS_OF}' END AS aud_upd_dts
FROM orders o JOIN src s ON o.o_orderkey = s.k
UNION ALL SELECT k, NULL, '{AS_OF}', NULL FROM src WHERE k NOT IN (SELECT o_orderkey FROM orders)""")
def load_scd1_without_stamps(spark, d):
    """A configured SCD1 load of a source that has no time column, with hard delete by that source."""
    cfg = load.LoadConfig(src_system="erp", src_tbl="orders", tgt_tbl="hub.orders", load_strategy="SCD1",
                          merge_keys=("o_orderkey",), hash_col="md5_key", hard_delete=True)
    res = load.run_load(spark, cfg, _hub_orders(spark, d), source=_lake_orders(spark, d), as_of=_as_of())
    return res.target.select("o_orderkey", "o_orderpriority", _text("AUD_LD_DTS"), _text("AUD_UPD_DTS"))


@register("load_counts_of_the_write", f"""
WITH {_SOURCE},
j AS (SELECT o.o_orderkey, s.k, s.cust <> o.o_custkey OR s.status <> o.o_orderstatus AS changed
      FROM orders o FULL OUTER JOIN src s ON o.o_orderkey = s.k)
SELECT (SELECT count(*) FROM twice) AS src_data_count, count(*) FILTER (WHERE k IS NOT NULL AND changed) AS updated,
       count(*) FILTER (WHERE o_orderkey IS NULL) AS inserted,
       count(*) FILTER (WHERE o_orderkey IS NOT NULL AND NOT changed) AS unchanged,
       count(*) FILTER (WHERE o_orderkey IS NOT NULL) + count(*) FILTER (WHERE o_orderkey IS NULL) AS written
FROM j""")
def load_counts_of_the_write(spark, d):
    """A whole run: the audit's count and the rows by outcome come from the pass that writes."""
    path, notes = scratch_path(spark, "load-orders"), []
    cfg = load.LoadConfig(src_system="erp", src_tbl="orders", tgt_tbl="hub.orders", load_strategy="SCD1",
                          merge_keys=("o_orderkey",), hash_col="md5_key")
    res = load.execute_load(spark, cfg, _hub_orders(spark, d), lambda df: df.write.parquet(path), notes.append,
                            source=_lake_orders(spark, d), as_of=_as_of())
    n = res.counts
    written = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("written"))
    one = notes[-1].select("src_data_count", *[F.lit(n[k]).cast("long").alias(name) for k, name in (
        (merge.UPDATE, "updated"), (merge.INSERT, "inserted"), (merge.UNCHANGED, "unchanged"))])
    return one.select("*", written.select("written").scalar().alias("written"))


def _scoped(spark, d, strategy):
    """Orders of status F come anew, with one column less than the hub has."""
    src = table(spark, d, "orders").filter("o_orderstatus = 'F' AND o_orderkey % 5 <> 0").select(
        F.col("o_orderkey").cast("string").alias("O_OrderKey"), "o_custkey", "o_orderstatus",
        change_hash(["o_custkey", "o_orderstatus"]).alias("md5_key"), F.lit("x").alias("not_in_the_hub"))
    cfg = load.LoadConfig(src_system="erp", src_tbl="orders", tgt_tbl="hub.orders", load_strategy=strategy,
                          tgt_filter="o_orderstatus = 'F'")
    res = load.run_load(spark, cfg, _hub_orders(spark, d), source=src, as_of=_as_of())
    return res.target.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", _text("AUD_LD_DTS"))


_SCOPED = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, '2024-01-01 00:00:00' AS aud_ld_dts
FROM orders WHERE o_orderstatus <> 'F'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, NULL, '{AS_OF}' FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 5 <> 0"""


@register("load_truncate_fewer_columns", _SCOPED)
def load_truncate_fewer_columns(spark, d):
    return _scoped(spark, d, "truncate")


@register("load_overwrite_fewer_columns", _SCOPED)
def load_overwrite_fewer_columns(spark, d):
    return _scoped(spark, d, "overwrite")


# --- I1 / T4: changed keys instead of a filtered join -----------------------------------------------

@register("incremental_delta_keys", """
WITH m AS (SELECT max(o_orderdate) - INTERVAL 400 DAY AS mark FROM orders)
SELECT o_orderkey, o_custkey FROM (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAY END AS o_upd,
         o_orderdate AS o_ld, CASE WHEN c_acctbal > 9000 THEN TIMESTAMP '1998-12-01 00:00:00' END AS c_upd
  FROM orders JOIN customer ON o_custkey = c_custkey)
WHERE greatest(COALESCE(o_upd, o_ld), COALESCE(c_upd, TIMESTAMP '1900-01-01 00:00:00')) >= (SELECT mark FROM m)""")
def incremental_delta_keys(spark, d):
    """The rows of incremental_changed_since, from the keys of changed customers."""
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    mark = o.agg((F.max(F.col("o_orderdate").cast("timestamp")) - F.expr("INTERVAL 400 DAYS")).alias("m")).scalar()
    orders = o.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("ld"),
                      F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS"))
                      .cast("timestamp").alias("upd"))
    customers = c.select("c_custkey", F.lit(None).cast("timestamp").alias("ld"),
                         F.when(F.col("c_acctbal") > 9000, F.lit("1998-12-01 00:00:00").cast("timestamp")).alias("upd"))
    found = incremental.changed_facts(orders, ("upd", "ld"), [
        incremental.Dimension(customers, "c_custkey", "o_custkey", ("upd", "ld"))], incremental.mark_of(spark, mark))
    return found.select("o_orderkey", "o_custkey")


@register("incremental_delta_lines", """
SELECT l_orderkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE greatest(l_shipdate, o_orderdate) >= (SELECT max(l_shipdate) - INTERVAL 200 DAY FROM lineitem)""")
def incremental_delta_lines(spark, d):
    """Order lines shipped, or whose order was placed, since the last run; the orders are scanned from that day on."""
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    mark = li.agg((F.max(F.col("l_shipdate").cast("timestamp")) - F.expr("INTERVAL 200 DAYS")).alias("m")).scalar()
    found = incremental.changed_facts(li, ("l_shipdate", "l_shipdate"), [
        incremental.Dimension(o, "o_orderkey", "l_orderkey", ("o_orderdate", "o_orderdate"))],
        incremental.mark_of(spark, mark))
    return found.select("l_orderkey", "l_linenumber")


# --- versions on plain files: touched buckets, whole sets, batches to stream from ------------------------

@register("merge_touched_buckets", """
WITH few AS (SELECT * FROM customer WHERE c_custkey % 100 = 7 AND c_custkey % 3 <> 0)
SELECT c.c_custkey, CASE WHEN f.c_custkey IS NULL THEN c.c_name ELSE upper(c.c_name) END AS c_name, c.c_mktsegment
FROM customer c LEFT JOIN few f ON c.c_custkey = f.c_custkey WHERE c.c_custkey % 100 <> 8
UNION ALL SELECT -c_custkey, upper(c_name), c_mktsegment FROM customer WHERE c_custkey % 100 = 7 AND c_custkey % 3 = 0""")
def merge_touched_buckets(spark, d):
    """A bucketed hub: 1 % of the customers changed or are new, then 1 % are deleted; other buckets are not rewritten."""
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment",
                                           change_hash(["c_name", "c_mktsegment"]).alias("md5_key"))
    hub = versioned.BucketedTable(scratch_path(spark, "hub-customer"), ["c_custkey"], c.schema, buckets=64)
    hub.store(c)
    some = c.filter("c_custkey % 100 = 7")
    key = F.when(F.col("c_custkey") % 3 == 0, -F.col("c_custkey")).otherwise(F.col("c_custkey"))
    name = F.upper("c_name")
    hub.scd1(some.select(key.alias("c_custkey"), name.alias("c_name"),
                         change_hash([name, "c_mktsegment"]).alias("md5_key")), "md5_key")
    hub.hard_delete(c.filter("c_custkey % 100 <> 8"), "c_custkey > 0")
    segment = c.select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"))
    now = hub.read(spark).drop("md5_key")
    back = now.join(segment, F.abs("c_custkey") == F.col("k"))         # new rows have no segment of their own
    return back.select("c_custkey", "c_name", F.coalesce("c_mktsegment", "segment").alias("c_mktsegment"))


@register("source_publish_all", """
SELECT 'orders' AS name, count(*) AS n, max(o_orderkey) AS last_key FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'customer', count(*), max(c_custkey) FROM customer""")
def source_publish_all(spark, d):
    """Two sets of tables: the second replaces the first as a whole; a third fails and changes nothing."""
    root = scratch_path(spark, "published")
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    versioned.publish_all(spark, {"orders": o, "customer": c.limit(1)}, root)
    versioned.publish_all(spark, {"orders": o.filter("o_orderstatus = 'F'"), "customer": c}, root)
    broken = c.select(F.raise_error(F.lit("no rows today")).alias("c_custkey"))
    try:
        versioned.publish_all(spark, {"orders": o, "customer": broken}, root)
    except RuntimeError:
        pass
    out = [versioned.read_published(spark, root, name).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"),
                                                           F.max(key).alias("last_key"))
           for name, key in (("orders", "o_orderkey"), ("customer", "c_custkey"))]
    return out[0].unionByName(out[1])


@register("source_truncate_load", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_shipdate >= DATE '1997-01-01'""")
def source_truncate_load(spark, d):
    """Truncate-then-load of a file sink: the old rows go when the new ones are there."""
    root = scratch_path(spark, "truncated")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    versioned.publish_all(spark, {"lines": li}, root)
    versioned.publish_all(spark, {"lines": li.filter("l_shipdate >= DATE '1997-01-01'").drop("l_shipdate")}, root)
    return versioned.read_published(spark, root, "lines")


@register("stream_from_version", """
SELECT o_orderkey, o_orderstatus, CAST(o_orderkey % 5 AS BIGINT) AS version FROM orders WHERE o_orderkey % 5 >= 2""")
def stream_from_version(spark, d):
    """Orders in five numbered batches; a stream that starts at version 2 gets the later ones only."""
    root, out = scratch_path(spark, "versions"), scratch_path(spark, "versions-out")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    for k in range(5):
        versioned.append_version(o.filter(F.col("o_orderkey") % 5 == k), root, k)
    q = (versioned.stream_versions(spark, root, o.schema, 2).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", scratch_path(spark, "versions-mark")).trigger(availableNow=True).start())
    if q.awaitTermination(600) is False:
        q.stop()
        raise TimeoutError("the stream has not finished")
    return spark.read.parquet(out)


@register("load_files_one_job", """
WITH f AS (SELECT CAST(o_orderkey % 40 AS INTEGER) AS file, o_orderkey % 40 IN (3, 17, 31) AS bad, o_orderkey FROM orders)
SELECT file, CASE WHEN bad THEN 'failed' ELSE 'completed' END AS status, count(*) FILTER (WHERE NOT bad) AS n_rows,
       CAST(coalesce(sum(o_orderkey) FILTER (WHERE NOT bad), 0) AS BIGINT) AS keys
FROM f GROUP BY file, bad""")
def load_files_one_job(spark, d):
    """Orders as 40 text files, three of them with a line that is no order: one scan loads the others and logs all."""
    folder = scratch_path(spark, "order-files")
    o = table(spark, d, "orders").select((F.col("o_orderkey") % 40).cast("int").alias("file"), "o_orderkey", "o_orderstatus")
    broken = F.col("file").isin(3, 17, 31) & (F.col("o_orderstatus") == "F")
    line = F.when(broken, F.concat_ws("|", "o_orderkey", "o_orderstatus")).otherwise(F.concat_ws(",", "o_orderkey", "o_orderstatus"))
    o.select("file", line.alias("value")).repartition("file").write.partitionBy("file").text(folder)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType())])
    rows, log = load.scan_files(spark, f"{folder}/*", schema)
    number = lambda c: F.regexp_extract(c, "file=([0-9]+)", 1).cast("int")
    keys = rows.groupBy(number(load.FILE).alias("loaded")).agg(F.sum("o_orderkey").alias("keys"))
    return log.select(number("file_name").alias("file"), "status", "n_rows").join(
        keys, F.col("file") == F.col("loaded"), "left").select(
        "file", "status", "n_rows", F.coalesce("keys", F.lit(0).cast("long")).alias("keys"))
