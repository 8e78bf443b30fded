"""Incremental selection by change time and the job log.

The last-run mark is a scalar subquery over the job-log frame (one value),
kept inside the same plan; when the log has no row the mark falls back to a
far-past time, so a first run takes everything instead of nothing.

:func:`changed_since` filters a finished join.  :func:`changed_facts` gets the
same fact rows from the changed keys of each dimension, without joining what
has not changed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from ledgerline.functions.scalar import FAR_PAST, latest_change
from ledgerline.session import scratch_path

JOB_LOG_COLUMNS = ("src_system", "src_tbl", "tgt_tbl", "batch_last_run_time")


def last_run(job_log: DataFrame, src_system: str, src_tbl: str, tgt_tbl: str) -> Column:
    """The mark for one load as a scalar-subquery Column (NULL → far past)."""
    mark = (job_log.filter((F.col("src_system") == src_system) & (F.col("src_tbl") == src_tbl)
                           & (F.col("tgt_tbl") == tgt_tbl))
            .agg(F.max("batch_last_run_time").alias("m")).scalar())
    return F.coalesce(mark, F.lit(FAR_PAST).cast("timestamp"))


def changed_since(joined: DataFrame, ts_pairs: Sequence[tuple], mark: Column) -> DataFrame:
    """Keep rows whose latest change over all (update, load) pairs is at or
    after ``mark``; a change in any dimension re-emits the fact row (T4)."""
    return joined.filter(latest_change(ts_pairs) >= mark)


@dataclass(frozen=True)
class Dimension:
    """A dimension of a fact: its frame, its key, the fact's column with that key, its (update, load) times."""
    frame: DataFrame
    key: str
    fact_key: str
    times: tuple[str, str]


@dataclass(frozen=True)
class Mark:
    """The last run as text literals: the time, and the first whole day that is not before it."""
    time: str
    day: str


def mark_of(spark, mark: Column) -> Mark:
    """The value of a mark (one row read), so that scans can be filtered by it."""
    day = F.date_trunc("day", "m")
    one = spark.range(1).select(mark.cast("timestamp").alias("m")).select(
        F.date_format("m", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time"),
        F.date_format(F.when(day == F.col("m"), day).otherwise(day + F.expr("INTERVAL 1 DAY")), "yyyy-MM-dd").alias("day"))
    return Mark(*one.first())


def at_or_after(df: DataFrame, times: tuple[str, str], mark: Mark) -> Column:
    """Whether a row changed at or after ``mark``: its update time, or its load time where it was never updated.

    Plain comparisons of columns with literals of their own types, which reach
    a parquet scan as pushed filters.
    """
    def late(c: str) -> Column:
        is_day = isinstance(df.schema[c].dataType, DateType)
        return F.col(c) >= (F.lit(mark.day).cast("date") if is_day else F.lit(mark.time).cast("timestamp"))
    update, load = times
    if mark.time[:len(FAR_PAST)] <= FAR_PAST:
        return F.lit(True)                         # the first run takes rows without any time as well
    return late(update) | (F.col(update).isNull() & late(load))


def changed_facts(fact: DataFrame, times: tuple[str, str] | None, dims: Sequence[Dimension], mark: Mark) -> DataFrame:
    """I1/T4 by delta keys: fact rows that changed themselves or whose row in a dimension did.

    Each dimension is scanned with its time filter and reduced to the distinct
    keys that changed, which are written to the shared folder; the facts are
    then scanned once and looked up in them.  What a dimension holds besides
    is never read, and an unchanged dimension row is never joined.  Join the
    attributes to the result afterwards.  A fact key without a dimension row,
    or NULL, is no change.
    """
    spark, out = fact.sparkSession, fact
    late = at_or_after(fact, times, mark) if times else F.lit(False)
    for i, dim in enumerate(dims):
        path = scratch_path(spark, f"changed-{i}")
        (dim.frame.filter(at_or_after(dim.frame, dim.times, mark) & F.col(dim.key).isNotNull())
         .select(F.col(dim.key).alias(f"_key{i}")).distinct().write.parquet(path))
        keys = spark.read.parquet(path).withColumn(f"_hit{i}", F.lit(True))
        out = out.join(keys, out[dim.fact_key] == keys[f"_key{i}"], "left")
        late = late | F.col(f"_hit{i}").isNotNull()
    return out.filter(late).select(*[F.col(f"`{c}`") for c in fact.columns])


def advance(job_log: DataFrame, src_system: str, src_tbl: str, tgt_tbl: str, new_mark: Column) -> DataFrame:
    """Job log with this load's mark replaced (row added when absent)."""
    key = (F.col("src_system") == src_system) & (F.col("src_tbl") == src_tbl) & (F.col("tgt_tbl") == tgt_tbl)
    others = job_log.filter(~key)
    row = job_log.sparkSession.range(1).select(
        F.lit(src_system).alias("src_system"), F.lit(src_tbl).alias("src_tbl"),
        F.lit(tgt_tbl).alias("tgt_tbl"), new_mark.cast("timestamp").alias("batch_last_run_time"))
    return others.unionByName(row)
