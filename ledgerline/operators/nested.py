"""JSON columns, structs and arrays.

Parsing is ``from_json`` with a declared schema; flattening is a schema walk
on the driver that emits one ``select``; explosion is ``explode``.  Independent
lists are kept in separate frames so they never cross-multiply.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from ledgerline.functions.scalar import is_empty, join_array

CORRUPT = "_corrupt"


def parse_json(df: DataFrame, c: str, schema: DataType | str, out: str | None = None,
               drop_failed: bool = True) -> DataFrame:
    """Parse a JSON text column with a declared schema.

    A malformed object under a struct schema parses to a struct of NULL
    fields rather than NULL, so "failed" means: input not empty and every
    leaf of the parsed value NULL (or the whole value NULL).  Empty inputs
    (NULL, ``''``, ``[]``, ``{}``, ``null``) are dropped as well when
    ``drop_failed``.
    """
    out = out or f"{c}_parsed"
    parsed = F.from_json(F.col(c), schema, {"mode": "PERMISSIVE", "allowSingleQuotes": "true"})
    res = df.withColumn(out, parsed)
    if not drop_failed:
        return res
    dt = parsed_type(schema, df)
    return res.filter(~is_empty(c) & _has_data(F.col(out), dt))


def parsed_type(schema, df: DataFrame) -> DataType:
    if isinstance(schema, DataType):
        return schema
    return df.sparkSession.range(1).select(F.from_json(F.lit("{}"), schema).alias("x")).schema["x"].dataType


# A JSON value position that holds data: not a nested object, not an empty
# array, not an empty or "null" string (NULL fields are omitted by to_json).
_VALUE_WITH_DATA = r':(?!\{|\[\]|""|"null")'


def _has_data(col, dt: DataType):
    """Some leaf of the parsed value carries data.

    For structs the test runs on the value's JSON text: one expression over
    the struct as a whole.  A predicate over every leaf would be copied by
    the optimizer once per leaf that a later projection aliases (2^n copies
    for an n-field flatten).
    """
    if isinstance(dt, StructType):
        return col.isNotNull() & F.to_json(col).rlike(_VALUE_WITH_DATA)
    if isinstance(dt, ArrayType):
        return col.isNotNull() & (F.size(col) > 0)
    return col.isNotNull()


def flatten_struct(df: DataFrame, c: str, prefix: str, keep: Sequence[str] = (),
                   sep: str = "__") -> DataFrame:
    """Flatten a struct column recursively into ``prefix__field__sub`` columns."""
    dt = df.schema[c].dataType
    cols = []

    def walk(t: StructType, path, name):
        for f in t.fields:
            p = path[f.name]
            n = f"{name}{sep}{f.name}"
            if isinstance(f.dataType, StructType):
                walk(f.dataType, p, n)
            else:
                cols.append(p.alias(n))

    walk(dt, F.col(c), prefix)
    return df.select(*keep, *cols)


def explode_nested(df: DataFrame, c: str, inner: str, prefix: str, keep: Sequence[str] = (),
                   name_field: str = "name", outer: bool = False) -> DataFrame:
    """Array of structs with an inner array → one row per (element, inner value).

    ``outer=False`` follows the reference: empty lists and elements without
    inner values produce no row.  ``outer=True`` keeps them with NULLs.
    """
    ex = F.explode_outer if outer else F.explode
    step = df.select(*keep, ex(F.col(c)).alias("_el"))
    return step.select(*keep, F.col(f"_el.{name_field}").alias(f"{prefix}{'__'}{name_field}"),
                       ex(F.col(f"_el.{inner}")).alias(f"{prefix}__{inner}"))


def explode_structs(df: DataFrame, c: str, keep: Sequence[str] = (), prefix: str | None = None,
                    outer: bool = False) -> DataFrame:
    """Array of structs → one row per element, fields as columns."""
    ex = F.explode_outer if outer else F.explode
    step = df.select(*keep, ex(F.col(c)).alias("_el"))
    et = df.schema[c].dataType.elementType
    return step.select(*keep, *[
        F.col(f"_el.{f.name}").alias(f"{prefix}__{f.name}" if prefix else f.name) for f in et.fields
    ])


def explode_values(df: DataFrame, c: str, keep: Sequence[str] = (), out: str | None = None,
                   outer: bool = False) -> DataFrame:
    """Array of scalars → one row per value."""
    ex = F.explode_outer if outer else F.explode
    return df.select(*keep, ex(F.col(c)).alias(out or c))


def simple_array(df: DataFrame, c: str, prefix: str, keep: Sequence[str] = (), sep: str = ";") -> DataFrame:
    """N4 as a frame step: array → ``sep`` text column named ``prefix``."""
    return df.select(*keep, join_array(F.col(c), sep).alias(prefix))


@dataclass(frozen=True)
class FlattenConfig:
    """How one JSON column is flattened."""
    column: str
    schema: DataType
    kind: str            # "struct" | "array_double_explode" | "simple_array"
    prefix: str
    inner: str = "titles"


def flatten(df: DataFrame, configs: Sequence[FlattenConfig], keep: Sequence[str]) -> dict[str, DataFrame]:
    """Parse and flatten each configured JSON column into its own frame.

    Columns missing from ``df`` are skipped.  No emptiness probe is run: an
    all-empty column simply yields an empty frame with the right schema.
    """
    out = {}
    for cfg in configs:
        if cfg.column not in df.columns:
            continue
        parsed = parse_json(df.select(*keep, cfg.column), cfg.column, cfg.schema, "_p")
        if cfg.kind == "struct":
            out[cfg.column] = flatten_struct(parsed, "_p", cfg.prefix, keep)
        elif cfg.kind == "array_double_explode":
            out[cfg.column] = explode_nested(parsed, "_p", cfg.inner, cfg.prefix, keep)
        elif cfg.kind == "simple_array":
            out[cfg.column] = simple_array(parsed, "_p", cfg.prefix, keep)
        else:
            raise ValueError(f"unknown flatten kind {cfg.kind!r}")
    return out


def combine(base: DataFrame, frames: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Attach single-row-per-key frames to the key, drop all-empty rows, distinct.

    Only frames with at most one row per key belong here; list-valued frames
    stay separate (joining two lists by key multiplies them).
    """
    res = base.select(key).distinct()
    for f in frames.values():
        res = res.join(f, key, "left")
    rest = [c for c in res.columns if c != key]
    if rest:
        vals = F.array(*[F.col(c).cast("string") for c in rest])
        res = res.filter(F.exists(vals, lambda x: x.isNotNull() & ~x.isin("", "[]", "{}")))
    return res.distinct()
