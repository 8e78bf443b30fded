"""De-duplication, latest-row selection and window steps (A1, A5, W-1 … W-5).

"Latest row per key" is written as an aggregate of ``max(struct(order…,
payload))``: Spark runs it as a partial (map-side) aggregate followed by a
final one, so a key holding a third of all rows is reduced to one row per
task before the shuffle instead of being sorted in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
           tiebreak: Sequence[str] = (), count_as: str | None = None) -> DataFrame:
    """A5/W-1: one row per key, the greatest by ``order`` then ``tiebreak``.

    ``order`` columns are compared descending (greatest wins), NULLs lowest.
    Ties on all order and tie-break columns are broken by the full row
    (deterministic).  Output has the input's columns, and with ``count_as``
    the number of rows of the key, counted by the same aggregate.
    """
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    ords = [_c(o).alias(f"_o{i}") for i, o in enumerate(order)]
    tbs = [F.col(t).alias(f"_t{i}") for i, t in enumerate(tiebreak)]
    best = F.max(F.struct(*ords, *tbs, *[F.col(f"`{c}`") for c in payload])).alias("_best")
    agg = df.groupBy(*keys).agg(best, F.count(F.lit(1)).alias("_rows"))
    many = [F.col("_rows").alias(count_as)] if count_as else []
    return agg.select(*keys, *[F.col(f"_best.`{c}`").alias(c) for c in payload], *many)


def latest_window(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """W-1 in window form (``row_number() = 1``); Spark inserts a partial
    ``WindowGroupLimit`` before the shuffle.  ``order`` carries its own
    direction."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def distinct_wide(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """``distinct`` for wide rows few of which are equal.

    The rows are distributed by the columns ``by`` before any is held, so a
    task that makes wide rows of narrow ones streams them; the tasks that hold
    them are sized by what they hold.  Equal rows are not reduced before the
    shuffle.  ``by`` must vary: the distinct drops constants from its keys, and
    its rows would move again.
    """
    return df.repartition(*by).distinct()


def row_ids(df: DataFrame, name: str = "row_id") -> DataFrame:
    """W-2 replacement: unique (not consecutive) id without a single-partition window."""
    return df.withColumn(name, F.monotonically_increasing_id())
