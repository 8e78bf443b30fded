"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\f\r"          # the class [\x20\x09-\x0D]
BLANK_RUN = r"[\x20\x09-\x0D]+"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Add a query (and its DuckDB SQL, where there is one) to the registry."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def text_of(name: str = "text") -> Column:
    """The text column; a null is an empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    An expression used several times inside lambdas would be computed again
    for every element; as the single element of an array it is bound to a
    lambda variable instead.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` in order."""
    return F.filter(F.split(text, BLANK_RUN), lambda w: w != "")


def aside(df: DataFrame, names: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns called like ``names`` renamed, and how to rename them back.

    The operators' own helper columns begin with two underscores; such names
    are reserved.
    """
    taken = {n.lower() for n in names}
    away = {c: f"__kept_{c}" for c in df.columns if c.lower() in taken}
    return df.withColumnsRenamed(away), {v: k for k, v in away.items()}


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later plans read it instead of computing it again."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: later steps read it instead of computing it again.

    Unlike a checkpoint it has a known size, so a small one is broadcast by
    Spark's own bound; and a join has a shuffle of its own for it, which lets
    a hot key on the other side be split.
    """
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)
