"""Ordered window steps that stay balanced when one key holds most rows (W-4, W-5).

A plain ``Window.partitionBy(key).orderBy(t)`` sends each key to one task; a
key with a third of all rows (or an unpartitioned ledger) becomes one huge
task.  Here the rows are first range-partitioned on ``(key, order)`` so a hot
key is cut into ordered chunks of bounded size.  The chunk assignment is
pinned with a reliable ``checkpoint()`` (it comes from sampling, which must
not be repeated differently by the two branches that read it).  Each chunk is
processed on its own; a small per-chunk summary (at most ``chunks`` rows per
key) carries the state across chunk borders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import checkpoint_dir


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _ranged(df: DataFrame, partition: Sequence[str], order: Sequence[Column],
            chunks: int | None) -> DataFrame:
    spark = df.sparkSession
    n = chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    checkpoint_dir(spark)
    ranged = df.repartitionByRange(n, *[F.col(p) for p in partition], *order) \
               .withColumn("_chunk", F.spark_partition_id())
    return ranged.checkpoint(eager=True)


def _join_chunks(local: DataFrame, summary: DataFrame, partition: Sequence[str]) -> DataFrame:
    """Rows with their chunk's summary; a NULL partition key is a key like any other."""
    right = summary.withColumnsRenamed({"_chunk": "_c", **{p: f"_p_{p}" for p in partition}})
    on = F.col("_chunk") == F.col("_c")
    for p in partition:
        on = on & F.col(p).eqNullSafe(F.col(f"_p_{p}"))
    return local.join(right, on, "inner").drop("_c", *[f"_p_{p}" for p in partition])


def running_sum(df: DataFrame, partition: Sequence[str], order: Sequence[Column | str],
                value: Column | str, name: str, chunks: int | None = None) -> DataFrame:
    """W-5: cumulative sum of ``value`` per ``partition`` in ``order`` (ascending).

    ``partition`` may be empty (one global ledger).  ``order`` should be a
    total order (add a unique tie-break column) for a deterministic result.
    NULL values add nothing; the sum is NULL until the first value, as in a SQL
    window.  Runs a job when called: the chunks are pinned by a checkpoint.
    """
    order = [_c(o) for o in order]
    ranged = _ranged(df.withColumn("_v", _c(value)), partition, order, chunks)
    w = (Window.partitionBy(*partition, "_chunk").orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.withColumn("_local", F.sum("_v").over(w))
    totals = ranged.groupBy(*partition, "_chunk").agg(F.sum("_v").alias("_tot"))
    wc = Window.partitionBy(*partition).orderBy("_chunk") \
               .rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*partition, "_chunk",
                            F.sum("_tot").over(wc).alias("_off"))
    out = _join_chunks(local, offsets, partition)
    kind = out.schema["_local"].dataType
    zero, off = F.lit(0).cast(kind), F.col("_off").cast(kind)
    seen = F.col("_local").isNotNull() | off.isNotNull()
    res = out.withColumn(name, F.when(seen, F.coalesce("_local", zero) + F.coalesce(off, zero)))
    return res.drop("_v", "_local", "_off", "_chunk")


def previous_value(df: DataFrame, partition: Sequence[str], order: Sequence[Column | str],
                   value: str, name: str, chunks: int | None = None) -> DataFrame:
    """W-4: ``lag(value, 1)`` per partition, balanced across hot keys.

    ``order`` takes sort expressions (``desc()``, ``asc_nulls_last()`` ...) as
    a window does; the rows are cut into chunks in that very order.  Runs a
    job when called: the chunks are pinned by a checkpoint.
    """
    order = [_c(o) for o in order]
    ranged = _ranged(df, partition, order, chunks)
    w = Window.partitionBy(*partition, "_chunk").orderBy(*order)
    local = ranged.withColumn("_lag", F.lag(F.col(value), 1).over(w)) \
                  .withColumn("_nth", F.row_number().over(w))
    # last value of each chunk by its place in the order (a sort expression has no value to compare),
    # then the previous chunk's last value per key
    last = local.groupBy(*partition, "_chunk").agg(F.max_by(F.struct(value), "_nth").alias("_m"))
    wc = Window.partitionBy(*partition).orderBy("_chunk")
    prev = last.select(*partition, "_chunk", F.lag(F.col(f"_m.{value}"), 1).over(wc).alias("_prev"))
    out = _join_chunks(local, prev, partition)
    res = out.withColumn(name, F.when(F.col("_nth") == 1, F.col("_prev")).otherwise(F.col("_lag")))
    return res.drop("_lag", "_nth", "_prev", "_chunk")
