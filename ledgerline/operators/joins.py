"""Join helpers (J-4 … J-12).

All joins are equi-joins so Catalyst can plan sort-merge, shuffled-hash or
broadcast joins; null-safe matching uses ``<=>`` (``eqNullSafe``), which is
still an equi key.  No side is hinted: Catalyst and AQE broadcast a dimension
(J-4) by its measured bytes against ``spark.sql.autoBroadcastJoinThreshold``,
and AQE's skew-join handling splits hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerline.session import scratch_path

# Default placeholder for a missing dimension key.
MISSING_KEY = "-1"
# Parts that the rows of a NULL key are dealt into.
NULL_SPREAD = 4096


def null_safe_on(left: DataFrame, right: DataFrame, cols: Sequence[str],
                 mapping: Mapping[str, str] | None = None, ci: bool = False,
                 default: str | None = None) -> Column:
    """J-7/J-8/J-11: null-safe equality over key columns.

    ``mapping`` renames left keys to right keys.  ``ci`` lower-cases string
    keys (decided from the schema once, not per row by ``typeof``).
    ``default`` reproduces ``coalesce(x, d) = coalesce(y, d)``, which differs
    from ``<=>`` only when the data holds ``d`` itself.
    """
    m = dict(mapping or {})
    conds = []
    for c in cols:
        lc, rc = left[c], right[m.get(c, c)]
        if ci and isinstance(left.schema[c].dataType, StringType):
            lc, rc = F.lower(lc), F.lower(rc)
        if default is not None:
            conds.append(F.coalesce(lc.cast("string"), F.lit(default))
                         == F.coalesce(rc.cast("string"), F.lit(default)))
        else:
            conds.append(lc.eqNullSafe(rc))
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def anti(df: DataFrame, other: DataFrame, on: Sequence[str] | Column) -> DataFrame:
    """J-5/J-6: rows of ``df`` with no partner in ``other`` (a real anti join)."""
    if isinstance(on, Column):
        return df.join(other, on, "left_anti")
    keys = other.select(*on).distinct()
    return df.join(keys, list(on), "left_anti")


def join_trim(left: DataFrame, right: DataFrame, lkey: str, rkey: str, how: str = "left") -> DataFrame:
    """J-9: equi-join on trimmed text keys."""
    return left.join(right, F.trim(left[lkey].cast("string")) == F.trim(right[rkey].cast("string")), how)


def resolve_keys(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str, str, str]],
                 missing: str = MISSING_KEY) -> DataFrame:
    """J-12: fact → dimension key lookup, missing keys become ``missing``.

    ``dims`` holds ``(dim_df, fact_col, dim_col, dim_key_col, out_name)``.
    Each lookup is a left join on one key; a lookup value with several keys
    takes the least of them (as text), so duplicates cannot multiply fact rows
    and the choice does not depend on row order.

    NULL fact keys find nothing, so they are dealt out by a hash of the row
    instead of meeting in one task.  The lookups are written to the shared
    folder when this is called: their size is known to the planner, and in a
    sort-merge join each side has an exchange of its own, so that AQE can
    split a hot key.
    """
    spark, out = fact.sparkSession, fact
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns]), F.lit(NULL_SPREAD))
    for i, (dim, fcol, dcol, kcol, name) in enumerate(dims):
        path = scratch_path(spark, f"lookup-{i}")
        (dim.filter(F.col(dcol).isNotNull()).groupBy(F.col(dcol).alias(f"_d{i}"))
         .agg(F.min(F.col(kcol).cast("string")).alias(f"_k{i}")).write.parquet(path))
        d = spark.read.parquet(path).withColumn("_z", F.lit(0).cast("long"))
        salt = F.when(out[fcol].isNull(), spread).otherwise(0)
        out = out.join(d, (out[fcol] == d[f"_d{i}"]) & (salt == d["_z"]), "left") \
                 .withColumn(name, F.coalesce(F.col(f"_k{i}"), F.lit(missing))) \
                 .drop(f"_d{i}", f"_k{i}", "_z")
    return out
