"""Melt / unpivot and type renaming (M1-M4).

``DataFrame.unpivot`` plans as a single ``Expand`` over one scan, instead of
one scan per melted column joined by unions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Type renames applied after melting.
TYPE_RENAMES = {
    "email": "primary",
    "primary_phone_number": "primary",
    "client_ecid": "ecid",
    "supplier_ecid": "ecid",
    "technologies_vendor_name": "payment_tech_used",
}

# Industry levels that belong to the external classification.
EXTERNAL_LEVELS = ("level-1", "level-2", "level-3")
EXTERNAL_CLASS = "bloomberg"
INTERNAL_CLASS = "internal"


def melt(df: DataFrame, ids: str | Sequence[str], columns: Sequence[str],
         names: tuple[str, str] = ("type", "value"), keep_nulls: bool = False,
         distinct: bool = True) -> DataFrame:
    """M1/M2: unpivot ``columns`` to (type, value) rows keeping ``ids``.

    Values are cast to string so mixed types can share one column.  NULL
    values are dropped (``unpivot`` keeps them) and the result is distinct,
    which also removes duplicates that the id columns do not tell apart.
    """
    id_cols = [ids] if isinstance(ids, str) else list(ids)
    k, v = names
    src = df.select(*id_cols, *[F.col(c).cast("string").alias(c) for c in columns])
    out = src.unpivot(id_cols, list(columns), k, v)
    if not keep_nulls:
        out = out.filter(F.col(v).isNotNull())
    return out.distinct() if distinct else out


def rename_types(c, renames: Mapping[str, str] = TYPE_RENAMES) -> Column:
    """M3: map melted type names (unknown names pass through)."""
    col = F.col(c) if isinstance(c, str) else c
    if not renames:
        return col
    expr = None
    for old, new in renames.items():
        expr = (F.when(col == old, F.lit(new)) if expr is None
                else expr.when(col == old, F.lit(new)))
    return expr.otherwise(col)


def class_of(c, levels: Sequence[str] = EXTERNAL_LEVELS,
             external: str = EXTERNAL_CLASS, internal: str = INTERNAL_CLASS) -> Column:
    """M4: ``level-1..3`` types belong to the external scheme, others are internal."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col.isin(*levels), F.lit(external)).otherwise(F.lit(internal))
