"""Schema conformance: mapping renames, typed NULL columns, projections.

Mappings are small configuration (one row per source column) and are the only
thing read to the driver here; the data itself is touched by one ``select``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NullType, StringType, StructType

# Mapping file columns.
MAPPING_COLUMNS = ("source_table", "source_column", "target_table", "target_column")
# A target column marked as not mapped.
NO_MAPPING = "nomapping"


def _norm(name: str) -> str:
    return name.strip().lower()


def mapping_dict(rows, target_table: str | None = None) -> dict[str, str]:
    """Build ``{source_column: target_column}`` keyed by (table, source).

    ``rows`` are mapping rows (dicts or Rows).  Restricting to one target
    table makes the one-source-to-several-targets case explicit instead of
    "last one wins".
    """
    out: dict[str, str] = {}
    for r in rows:
        r = r.asDict() if hasattr(r, "asDict") else dict(r)
        if target_table is not None and _norm(r["target_table"]) != _norm(target_table):
            continue
        tgt = r["target_column"]
        if tgt is None or _norm(tgt) == NO_MAPPING:
            continue
        out[_norm(r["source_column"])] = _norm(tgt)
    return out


def apply_mapping(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """lower/trim each source name, rename when mapped, pass others through."""
    m = {_norm(k): v for k, v in mapping.items()}
    return df.select(*[F.col(f"`{c}`").alias(m.get(_norm(c), _norm(c))) for c in df.columns])


def typed_null_rule(name: str) -> DataType | str:
    """``*date*`` → date, ``*amount*`` → double, else string."""
    n = name.lower()
    if "date" in n:
        return "date"
    if "amount" in n:
        return "double"
    return "string"


def ensure_columns(df: DataFrame, required: StructType | Mapping[str, DataType | str] | Sequence[str],
                   rule=typed_null_rule) -> DataFrame:
    """Add each missing required column as a typed NULL.

    ``required`` is a schema, a ``{name: type}`` dict, or a list of names (the
    type then comes from ``rule``).
    """
    if isinstance(required, StructType):
        req = {f.name: f.dataType for f in required.fields}
    elif isinstance(required, Mapping):
        req = dict(required)
    else:
        req = {n: rule(n) for n in required}
    have = {c.lower() for c in df.columns}
    extra = [F.lit(None).cast(t).alias(n) for n, t in req.items() if n.lower() not in have]
    return df.select("*", *extra) if extra else df


def fix_void(df: DataFrame) -> DataFrame:
    """P5: columns of NULL type (from ``lit(None)``) become strings."""
    return df.select(*[
        F.col(f.name).cast(StringType()).alias(f.name) if isinstance(f.dataType, NullType)
        else F.col(f.name) for f in df.schema.fields
    ])


@dataclass(frozen=True)
class OutputSpec:
    """Typed projection of one output table.

    ``columns`` is an ordered ``{name: SQL expression}``; ``keys`` must not be
    NULL.  Audit constants are stamped *after* the de-duplication so they do
    not take part in it.
    """
    name: str
    columns: dict
    keys: tuple = ()
    audit: bool = True


def project(df: DataFrame, spec: OutputSpec, created_by: str = "ledgerline",
            as_of: Column | None = None, distinct: bool = True) -> DataFrame:
    """Apply an :class:`OutputSpec`: typed select, NULL-key drop, distinct, audit stamp."""
    # pass-through columns are selected as-is: an alias per column makes the
    # optimizer copy every constraint that mentions it (2^n with wide filters)
    out = df.select(*[F.col(f"`{n}`") if expr == n else F.expr(f"{expr} AS `{n}`")
                      for n, expr in spec.columns.items()])
    if spec.keys:
        out = out.dropna(subset=list(spec.keys))
    if distinct:
        out = out.distinct()
    if spec.audit:
        ts = as_of if as_of is not None else F.current_timestamp()
        out = out.select("*", F.lit(True).alias("is_active"), F.lit(created_by).alias("created_by"),
                         ts.alias("created_date"))
    return out


def suffix(df: DataFrame, s: str = "_stg") -> DataFrame:
    """Suffix every column once (already-suffixed names are left alone).

    Raises where a column and its suffixed twin would get one name.
    """
    names = [(c if c.endswith(s) else c + s).lower() for c in df.columns]
    if twice := sorted({n for n in names if names.count(n) > 1}):
        raise ValueError(f"two columns would be called {twice}")
    return df.select(*[F.col(f"`{c}`").alias(c if c.endswith(s) else c + s) for c in df.columns])


def valid_columns(df: DataFrame, target_cols: Sequence[str], mapping: Mapping[str, str] | None = None,
                  keys: Sequence[str] = (), flag: str | None = None) -> DataFrame:
    """Keep columns present in the target (after mapping), keys and flag."""
    m = {k.lower(): v.lower() for k, v in (mapping or {}).items()}
    keep = {c.lower() for c in target_cols} | {k.lower() for k in keys}
    if flag:
        keep.add(flag.lower())
    cols = [c for c in df.columns if c.lower() in keep or m.get(c.lower()) in keep]
    return df.select(*cols)


def common_columns(src: DataFrame, tgt: DataFrame) -> list[str]:
    """Source columns that exist in the target, case-insensitively, in source order."""
    t = {c.lower() for c in tgt.columns}
    return [c for c in src.columns if c.lower() in t]


@dataclass(frozen=True)
class Alignment:
    """How a source and a target schema fit (names as the target spells them).

    ``common`` columns are loaded from the source, ``target_only`` columns
    keep their value, ``added`` columns are new in the target.
    """
    common: tuple
    target_only: tuple
    added: tuple


def align(source: DataFrame, target: DataFrame, evolve: StructType | Mapping[str, DataType | str] | str | None = None
          ) -> tuple[DataFrame, DataFrame, Alignment]:
    """A source and a target made to fit by their common columns.

    Names match in any letter case; the source takes the target's spelling and
    types.  ``evolve`` (a schema, its DDL, or ``{name: type}``) declares columns
    that the target gets where it lacks them, NULL in its old rows.  Source
    columns that the target neither has nor gets are left out.
    """
    twice = sorted(n for n, k in Counter(c.lower() for c in source.columns).items() if k > 1)
    if twice:
        raise ValueError(f"source columns differ only in letter case: {twice}")
    if isinstance(evolve, str):
        evolve = StructType.fromDDL(evolve)
    if isinstance(evolve, StructType):
        evolve = {f.name: f.dataType for f in evolve.fields}
    wide = ensure_columns(target, evolve or {})
    given = {c.lower(): c for c in source.columns}
    common = tuple(c for c in wide.columns if c.lower() in given)
    aligned = source.select(*[F.col(f"`{given[c.lower()]}`").cast(wide.schema[c].dataType).alias(c) for c in common])
    return aligned, wide, Alignment(common, tuple(c for c in target.columns if c not in common),
                                    tuple(wide.columns[len(target.columns):]))
