"""Row and cell cleaning.

Everything is one ``select`` or one ``filter`` so the whole step stays in a
single codegen stage and Catalyst can push filters into the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ledgerline.functions.scalar import any_meaningful, any_not_null


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def clean_blanks(df: DataFrame, tokens: Sequence[str] = ("nan",),
                 columns: Sequence[str] | None = None) -> DataFrame:
    """trimmed ``''`` and the tokens (any case) become NULL.

    Only string columns are touched (other types cannot hold these values),
    and all of them in one projection.
    """
    targets = set(columns if columns is not None else string_columns(df))
    toks = ", ".join(["''"] + ["'" + t.lower().replace("'", "''") + "'" for t in tokens])

    def q(c: str) -> str:
        return "`" + c.replace("`", "``") + "`"

    # built as SQL text: one JVM call for the whole projection instead of
    # several per column (wide landing extracts have ~60 string columns)
    return df.selectExpr(*[
        f"CASE WHEN lower(trim({q(c)})) IN ({toks}) THEN NULL ELSE {q(c)} END AS {q(c)}" if c in targets else q(c)
        for c in df.columns
    ])


def keep_meaningful(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """keep rows where any of ``columns`` carries data."""
    return df.filter(any_meaningful(columns))


def drop_all_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """drop rows whose ``columns`` are all NULL."""
    return df.filter(any_not_null(columns))


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """drop rows with a NULL in any key column before a write."""
    return df.dropna(how="any", subset=list(keys))


def empty_like(spark: SparkSession, schema: StructType) -> DataFrame:
    """empty frame with a given schema (no job is run)."""
    return spark.createDataFrame([], schema)


def fill_blank_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL → ``''`` on string columns.

    Beware: after this, blank values join with each other; use it only for
    display or for comparisons that treat blanks as equal on purpose.
    """
    return df.fillna("", subset=list(columns) if columns is not None else string_columns(df))


def prefilter(target: DataFrame, keys: DataFrame, on: Sequence[str],
              none_as_null: bool = False) -> DataFrame:
    """target rows whose key tuple occurs in ``keys`` (null-safe).

    A left-semi join replaces collecting key lists to the driver; NULL keys
    match NULL keys.  With ``none_as_null`` the text ``none`` (any case) in a
    key counts as NULL on both sides.  The key side is de-duplicated first so
    a hot key costs one row, and AQE chooses broadcast when it is small.
    """
    def norm(df: DataFrame) -> DataFrame:
        if not none_as_null:
            return df
        return df.select(*[
            F.when(F.lower(F.col(c).cast("string")) != "none", F.col(c)).alias(c)
            if c in on else F.col(c) for c in df.columns
        ])

    t = norm(target)
    k = norm(keys.select(*on)).distinct()
    cond = [t[c].eqNullSafe(k[c]) for c in on]
    return t.join(k, cond, "left_semi")
