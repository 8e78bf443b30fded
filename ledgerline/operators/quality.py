"""Reconciliation and data-quality reports (A2-A4, J-10, Q1-Q3, Q6).

Reports are aggregates: each one is a single distributed job whose result is
small (one row per group, per side or per outcome).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.scalar import first_char_code

# Side labels of a reconciliation.
SIDE_BOTH, SIDE_LEFT, SIDE_RIGHT = "both", "left_only", "right_only"
# Audit status that counts as a failure.
FAILED = "failed"


def duplicates(df: DataFrame, cs: Sequence[str], name: str = "n") -> DataFrame:
    """A2: key groups occurring more than once (``HAVING COUNT(*) > 1``).

    Partial aggregation runs before the shuffle, so a hot key costs one row
    per task on the wire.
    """
    return df.groupBy(*cs).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def profile(frames: Mapping[str, DataFrame], key: str | Mapping[str, str]) -> DataFrame:
    """A3: ``COUNT(DISTINCT key)`` and ``COUNT(*)`` per table, stacked."""
    parts = []
    for name, df in frames.items():
        k = key[name] if isinstance(key, Mapping) else key
        parts.append(df.agg(F.lit(name).alias("table_name"),
                            F.countDistinct(F.col(k)).alias("distinct_keys"),
                            F.count(F.lit(1)).alias("row_count")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def outcome_counts(classified: DataFrame, outcome: str = "outcome") -> DataFrame:
    """A4: one pass, one row per outcome."""
    return classified.groupBy(outcome).agg(F.count(F.lit(1)).alias("n"))


def reconcile(a: DataFrame, b: DataFrame, key: str, b_key: str | None = None) -> DataFrame:
    """J-10: full outer join of the two key sets with a side label.

    Each side is reduced to its distinct keys first, so duplicated keys do
    not multiply.
    """
    bk = b_key or key
    ka = a.select(F.col(key).alias("_ka")).distinct()
    kb = b.select(F.col(bk).alias("_kb")).distinct()
    j = ka.join(kb, ka["_ka"] == kb["_kb"], "full_outer")
    side = (F.when(F.col("_ka").isNotNull() & F.col("_kb").isNotNull(), F.lit(SIDE_BOTH))
            .when(F.col("_ka").isNotNull(), F.lit(SIDE_LEFT)).otherwise(F.lit(SIDE_RIGHT)))
    return j.select(F.coalesce("_ka", "_kb").alias(key), side.alias("side"))


def missing_keys(a: DataFrame, b: DataFrame, key: str, b_key: str | None = None) -> DataFrame:
    """Q1: keys of ``a`` that ``b`` lacks (distinct), via a real anti join."""
    bk = b_key or key
    kb = b.select(F.col(bk).alias(key)).distinct()
    return a.select(key).distinct().join(kb, key, "left_anti")


def probe_names(df: DataFrame, c: str, names: Sequence[str]) -> DataFrame:
    """Q2: length, first character code and normalised membership of a text column."""
    norm = F.lower(F.trim(F.col(c)))
    return df.select(
        F.col(c),
        F.length(F.col(c)).alias("name_length"),
        first_char_code(F.col(c)).alias("first_char_code"),
        norm.isin(*[n.strip().lower() for n in names]).alias("matches_list"),
    )


def failed_twice(audit: DataFrame, group: Sequence[str] = ("tgt_tbl_nm", "src_tbl_nm", "src_system"),
                 batch: str = "batch_id", status: str = "status") -> DataFrame:
    """Q3: per load, how many of the two latest batches failed (2 = alarm).

    A batch's status is the smallest status text it has (``completed`` <
    ``failed`` < ``running``), as in the reference.  Latest two batches come
    from ``row_number() <= 2``, which Spark plans with a partial
    ``WindowGroupLimit`` before the shuffle, so a load with very many batches
    sends two rows per task.  ``failed_twice`` is true when both failed.
    """
    g = list(group)
    per_batch = audit.groupBy(*g, batch).agg(F.min(status).alias("batch_status"))
    w = Window.partitionBy(*g).orderBy(F.col(batch).desc())
    top2 = per_batch.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= 2)
    out = top2.groupBy(*g).agg(
        F.sum(F.when(F.col("batch_status") == FAILED, 1).otherwise(0)).cast("int").alias("failed_in_last_two"),
        F.max(batch).alias("last_batch_id"),
    )
    return out.withColumn("failed_twice", F.col("failed_in_last_two") == 2)


def validate(df: DataFrame, required: Sequence[str] = (), non_empty: bool = True) -> None:
    """Q6: raise when required columns are missing or (optionally) no row exists.

    ``isEmpty`` reads at most one row.
    """
    missing = [c for c in required if c.lower() not in {x.lower() for x in df.columns}]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    if non_empty and df.isEmpty():
        raise ValueError("input has no rows")
