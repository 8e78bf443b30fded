"""Sources and sinks.

Readers return lazy DataFrames so filters and projections reach the scan
(parquet/ORC pushdown, JDBC predicate pushdown).  Writers run one Spark job
per table; concurrent writes only submit jobs from a small thread pool.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from ledgerline.operators.conform import MAPPING_COLUMNS

# JDBC write defaults and the write-partition clamp.
JDBC_BATCH_SIZE = 1000
JDBC_ISOLATION = "READ_COMMITTED"
MIN_WRITE_PARTITIONS, MAX_WRITE_PARTITIONS = 4, 20
DEFAULT_PARALLEL_WRITES = 4


@dataclass(frozen=True)
class Source:
    """Where a table lives: ``format`` is ``jdbc``, ``parquet``, ``csv``,
    ``delta``, ``table`` (catalog) …; ``location`` is a path, a JDBC
    ``dbtable`` or a catalog name.  ``partition_column`` with ``lower``,
    ``upper`` and ``partitions`` splits a JDBC scan over several tasks."""
    format: str
    location: str
    options: Mapping[str, str] = field(default_factory=dict)
    partition_column: str | None = None
    lower: object = None
    upper: object = None
    partitions: int | None = None


def read_table(spark: SparkSession, src: Source, schema: StructType | None = None) -> DataFrame:
    """Scan a whole table."""
    if src.format == "table":
        return spark.table(src.location)
    r = spark.read.format(src.format).options(**dict(src.options))
    if schema is not None:
        r = r.schema(schema)
    if src.format == "jdbc":
        for k, v in jdbc_ranges(src).items():
            r = r.option(k, v)
        return r.option("dbtable", src.location).load()
    return r.load(src.location)


def jdbc_ranges(src: Source) -> dict[str, str]:
    """Reader options that cut a JDBC scan into ``src.partitions`` key ranges, one task each.

    Rows outside ``lower``..``upper`` are still read, by the first and the
    last task.  Without a ``partition_column`` the scan is one task.
    """
    if src.partition_column is None:
        return {}
    if src.lower is None or src.upper is None or not src.partitions:
        raise ValueError("a partitioned JDBC scan needs lower, upper and partitions")
    return {"partitionColumn": src.partition_column, "lowerBound": str(src.lower), "upperBound": str(src.upper),
            "numPartitions": str(src.partitions)}


def read_landing(spark: SparkSession, src: Source, flag_col: str, keep: str | Sequence[str]) -> DataFrame:
    """Rows whose processing flag is in ``keep``, de-duplicated.

    The filter is a DataFrame filter, so it is pushed into the scan (JDBC
    WHERE clause, parquet row-group statistics).
    """
    vals = [keep] if isinstance(keep, str) else list(keep)
    return read_table(spark, src).filter(F.col(flag_col).isin(*vals)).distinct()


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """S3: CSV with a header; a given schema avoids the inference pass."""
    r = spark.read.option("header", "true")
    r = r.schema(schema) if schema is not None else r.option("inferSchema", "true")
    return r.csv(path)


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Mapping file with the required columns (all strings), found by their
    header names whatever their order."""
    df = spark.read.option("header", "true").csv(path)
    by_name = {c.strip().lower(): c for c in df.columns}
    missing = [c for c in MAPPING_COLUMNS if c not in by_name]
    if missing:
        raise ValueError(f"mapping file lacks columns {missing}")
    return df.select(*[F.col(f"`{by_name[c]}`").alias(c) for c in MAPPING_COLUMNS])


def read_schema(spark: SparkSession, db: str) -> dict[str, DataFrame]:
    """Every table of a catalog database, by name (lazy).

    ``listTables`` also returns the session's temporary views, which belong
    to no database; they are left out.
    """
    return {t.name: spark.table(f"{db}.{t.name}") for t in spark.catalog.listTables(db)
            if t.database == db or (t.namespace and t.namespace[-1] == db)}


def table_keys(mapping: DataFrame, table: str, table_col: str = "table_name") -> dict:
    """The key-mapping row of one table (small configuration, one row)."""
    rows = mapping.filter(F.lower(F.trim(F.col(table_col))) == table.strip().lower()).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected one key-mapping row for {table}, found {len(rows)}")
    return rows[0].asDict()


def clamp_partitions(n: int, lo: int = MIN_WRITE_PARTITIONS, hi: int = MAX_WRITE_PARTITIONS) -> int:
    return max(lo, min(hi, n))


def write_table(df: DataFrame, sink: Source, mode: str = "append", partitions: int | None = None,
                partition_by: Sequence[str] = (), connections: tuple[int, int] = (MIN_WRITE_PARTITIONS,
                                                                                  MAX_WRITE_PARTITIONS)) -> None:
    """Write one table.

    JDBC sinks get ``batchsize`` and ``isolationLevel``; ``overwrite`` on
    JDBC truncates instead of dropping the table.  ``partitions`` sets the
    number of writer tasks, for JDBC within ``connections`` (least, most) so
    the database sees a bounded number of them.
    """
    out = df
    if partitions is not None:
        n = clamp_partitions(partitions, *connections) if sink.format == "jdbc" else partitions
        out = out.repartition(n)
    w = out.write.mode(mode).format(sink.format).options(**dict(sink.options))
    if sink.format == "jdbc":
        w = w.option("dbtable", sink.location).option("batchsize", JDBC_BATCH_SIZE) \
             .option("isolationLevel", JDBC_ISOLATION)
        if mode == "overwrite":
            w = w.option("truncate", "true")
        w.save()
        return
    if partition_by:
        w = w.partitionBy(*partition_by)
    if sink.format == "table":
        w.format("parquet").saveAsTable(sink.location)
    else:
        w.save(sink.location)


@dataclass
class LoadReport:
    """Per-table outcome of a multi-table load."""
    succeeded: list = field(default_factory=list)
    failed: dict = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return not self.failed


def write_all(frames: Mapping[str, DataFrame], sinks: Mapping[str, Source], mode: str = "append",
              parallel: int = DEFAULT_PARALLEL_WRITES, raise_on_failure: bool = True) -> LoadReport:
    """Write several tables, up to ``parallel`` jobs at a time.

    Threads only submit Spark jobs (the work runs on the executors).  Every
    table is attempted; failures are collected and raised together.
    """
    report = LoadReport()

    def one(name):
        write_table(frames[name], sinks[name], mode)
        return name

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        futs = {name: pool.submit(one, name) for name in frames}
        for name, fut in futs.items():
            try:
                fut.result()
                report.succeeded.append(name)
            except Exception as e:  # collected, then raised below
                report.failed[name] = f"{type(e).__name__}: {e}"
    if report.failed and raise_on_failure:
        raise RuntimeError(f"load failed for {sorted(report.failed)}")
    return report


def overwrite_load(df: DataFrame, as_of: Column | None = None, ld_col: str = "AUD_LD_DTS",
                   upd_col: str = "AUD_UPD_DTS") -> DataFrame:
    """Rows of a full overwrite, load time stamped and update time NULL."""
    ts = as_of if as_of is not None else F.current_timestamp()
    cols = [c for c in df.columns if c not in (ld_col, upd_col)]
    return df.select(*cols, ts.cast("timestamp").alias(ld_col), F.lit(None).cast("timestamp").alias(upd_col))


def overwrite_where(new_rows: DataFrame, target: DataFrame, predicate: Column | str) -> DataFrame:
    """Replace the target rows matching ``predicate`` by ``new_rows``.

    Written to a new location this is the same as Delta ``replaceWhere``;
    when the predicate is on partition columns, writing ``new_rows`` with
    dynamic partition overwrite (:func:`write_partitions`) touches only those
    partitions.
    """
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    keep = target.filter(~F.coalesce(p, F.lit(False)))
    return keep.unionByName(new_rows.select(*target.columns))


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """S14 on partition keys: dynamic overwrite replaces only the partitions present in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
      .partitionBy(*partition_by).parquet(path)


def write_rejects(df: DataFrame, base_path: str, stamp: str | None = None) -> str:
    """Rejected rows as CSV with a header under a time-stamped folder."""
    s = stamp or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S")
    path = f"{base_path.rstrip('/')}/rejects_{s}"
    df.write.mode("errorifexists").option("header", "true").csv(path)
    return path


def backup(df: DataFrame, path: str) -> None:
    """Copy a table to a new location (never over what is being read)."""
    df.write.mode("errorifexists").parquet(path)


def evolve(df: DataFrame, new_cols: Mapping[str, DataType | str]) -> DataFrame:
    """Add columns (NULL for existing rows); existing columns are kept."""
    have = {c.lower() for c in df.columns}
    extra = [F.lit(None).cast(t).alias(n) for n, t in new_cols.items() if n.lower() not in have]
    return df.select("*", *extra)
