"""Config-driven lake → hub loads.

A load is described by a :class:`LoadConfig`, usually one row of the config
table (:func:`config_from_row`).  :func:`run_load` turns it into DataFrame
operations:

* ``SCD1``      → fingerprint merge (+ hard delete when asked);
* ``OVERWRITE`` → whole table, or only the rows of the target filter;
* ``TRUNCATE``  → delete by filter (or all), then add every source row;
* other         → the merge path (as SCD1 without delete).

``run_load`` writes nothing: it returns the new target and one audit row.
:func:`execute_load` is the whole run: audit ``running``, pre-SQL, load, write
(by the caller's function), post-SQL, audit ``completed``, or ``failed`` with
the error.  Pre/post SQL statements run through ``spark.sql`` as a *list* of
statements (a naive ``;`` split breaks on quoted semicolons).
"""

from __future__ import annotations

import re
import threading
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.operators import merge
from ledgerline.operators.conform import align, ensure_columns
from ledgerline.session import scratch_path
from ledgerline.sources.io import overwrite_load, overwrite_where

# Load strategies and audit statuses.
SCD1, OVERWRITE, TRUNCATE, MERGE = "SCD1", "OVERWRITE", "TRUNCATE", "MERGE"
RUNNING, COMPLETED, FAILED = "running", "completed", "failed"
OBSERVED_WITHIN = 5       # seconds after a write in which Spark reports what it observed


@dataclass(frozen=True)
class LoadConfig:
    src_system: str
    src_tbl: str
    tgt_tbl: str
    load_strategy: str
    merge_keys: tuple = ()
    hash_col: str | None = None
    source_sql: str | None = None
    incremental_sql: str | None = None
    full_load: bool = False
    hard_delete: bool = False
    src_filter: str | None = None
    tgt_filter: str | None = None
    pre_sql: tuple = ()
    post_sql: tuple = ()
    upd_col: str = "AUD_UPD_DTS"
    ld_col: str = "AUD_LD_DTS"
    delete_sql: str | None = None          # all keys that still exist, for the hard delete
    delete_filter: str | None = None       # target rows the hard delete looks at (default: tgt_filter)
    order_cols: tuple = ()                 # of source rows with one key the latest by these counts (default: the stamps)
    evolve: str | None = None              # DDL of columns that the target gets where it lacks them
    extra: dict = field(default_factory=dict)

    def validate(self) -> "LoadConfig":
        """Q5: every required field must be present (any one missing raises)."""
        required = {"src_system": self.src_system, "src_tbl": self.src_tbl, "tgt_tbl": self.tgt_tbl,
                    "load_strategy": self.load_strategy}
        strategy = (self.load_strategy or "").upper()
        if strategy in (SCD1, MERGE) or self.hard_delete:
            required["merge_keys"] = self.merge_keys       # TRUNCATE and OVERWRITE match no keys
        if strategy == SCD1:
            required["hash_col"] = self.hash_col
        missing = [k for k, v in required.items() if not v]
        if missing:
            raise ValueError(f"missing load parameters: {missing}")
        if self.hard_delete and strategy == SCD1 and self.incremental and not self.delete_sql:
            raise ValueError("hard delete on an incremental load needs delete_sql: the increment does not hold "
                             "the keys that still exist")
        return self

    @property
    def incremental(self) -> bool:
        return bool(self.incremental_sql) and not self.full_load and self.strategy != TRUNCATE

    @property
    def strategy(self) -> str:
        return self.load_strategy.upper()


def source_query(cfg: LoadConfig) -> str | None:
    """Full query on a full load, otherwise the incremental one when given."""
    return cfg.incremental_sql if cfg.incremental else cfg.source_sql


# Columns of the config table, both spellings in use.
CONFIG_COLUMNS = {
    "src_system": ("src_system",), "src_tbl": ("src_tbl",), "tgt_tbl": ("tgt_tbl",),
    "load_strategy": ("load_strategy",), "merge_keys": ("tgt_merge_col_nm",),
    "source_sql": ("src_truncate_query", "src_select_logic_sql"),
    "incremental_sql": ("src_incr_query", "batch_sql_query"),
    "delete_sql": ("src_delete_query",), "delete_filter": ("tgt_delete_filter_condition",),
    "hard_delete": ("hard_delete_flag", "hard_delete_required"),
    "src_filter": ("src_merge_filter_condition",), "tgt_filter": ("tgt_merge_filter_condition",),
    "pre_sql": ("pre_sql_query",), "pre_sql_flag": ("pre_sql_flag",),
    "post_sql": ("post_sql_query",), "post_sql_flag": ("post_sql_flag",),
}


def config_from_row(row: Mapping[str, object], hash_col: str | None = None, full_load: bool = False,
                    order_cols: Sequence[str] = (), evolve: str | None = None, **extra) -> LoadConfig:
    """A load from one row of the config table (blank values count as absent).

    Flags are ``Y``/``N``; filters may carry the aliases ``tgt.``, ``src.`` or
    ``stg.``, which are taken off; SQL hooks run only where their flag is ``Y``.
    """
    lower = {str(k).lower(): v for k, v in row.items()}

    def value(name: str) -> str | None:
        texts = [str(lower[c]).strip() for c in CONFIG_COLUMNS[name] if lower.get(c) is not None]
        return next((t for t in texts if t), None)

    def flag(name: str) -> bool:
        return (value(name) or "").upper() == "Y"

    def condition(name: str) -> str | None:
        text = value(name)
        return re.sub(r"\b(?:tgt|src|stg)\.", "", text, flags=re.IGNORECASE) if text else None

    def hook(name: str) -> tuple:
        return (value(name),) if flag(f"{name}_flag") and value(name) else ()

    return LoadConfig(
        src_system=value("src_system"), src_tbl=value("src_tbl"), tgt_tbl=value("tgt_tbl"),
        load_strategy=value("load_strategy") or "",
        merge_keys=tuple(k.strip() for k in (value("merge_keys") or "").split(",") if k.strip()),
        hash_col=hash_col, source_sql=value("source_sql"), incremental_sql=value("incremental_sql"),
        full_load=full_load, hard_delete=flag("hard_delete"), src_filter=condition("src_filter"),
        tgt_filter=condition("tgt_filter"), delete_sql=value("delete_sql"), delete_filter=condition("delete_filter"),
        pre_sql=hook("pre_sql"), post_sql=hook("post_sql"), order_cols=tuple(order_cols), evolve=evolve,
        extra=extra).validate()


def missing_parameters(rows: DataFrame, hash_col: str | None = None, full_load: bool = False) -> DataFrame:
    """Q5 for a whole config table: ``rows`` with ``missing``, the load parameters each row lacks (sorted).

    The rule of :meth:`LoadConfig.validate` as one expression per row, so a
    config frame of any size is checked by the executors.  ``delete_sql`` is
    missing where an incremental SCD1 load deletes.
    """
    lower = {c.lower(): c for c in rows.columns}

    def value(name: str) -> Column:
        texts = [F.trim(F.col(f"`{lower[c]}`").cast("string")) for c in CONFIG_COLUMNS[name] if c in lower]
        return F.coalesce(*[F.when(t != "", t) for t in texts], F.lit(None).cast("string"))

    strategy = F.upper(F.coalesce(value("load_strategy"), F.lit("")))
    deletes = F.coalesce(F.upper(value("hard_delete")) == "Y", F.lit(False))
    scd1, by_key = strategy == SCD1, strategy.isin(SCD1, MERGE) | deletes
    keys = F.filter(F.split(F.coalesce(value("merge_keys"), F.lit("")), ","), lambda k: F.trim(k) != "")
    incremental = value("incremental_sql").isNotNull() & F.lit(not full_load)
    lacks = [*[F.when(value(n).isNull(), n) for n in ("load_strategy", "src_system", "src_tbl", "tgt_tbl")],
             F.when(by_key & (F.size(keys) == 0), "merge_keys"), F.when(scd1 & F.lit(not hash_col), "hash_col"),
             F.when(scd1 & deletes & incremental & value("delete_sql").isNull(), "delete_sql")]
    return rows.withColumn("missing", F.sort_array(F.array_compact(F.array(*lacks))))


def run_hooks(spark: SparkSession, statements: Sequence[str]) -> None:
    """Run each configured SQL statement in order."""
    for s in statements:
        if s and s.strip():
            spark.sql(s)


class LoadResult:
    """A configured load as frames: ``target`` is the new target, ``operation`` its kind.

    The source rows are counted by the pass that produces ``target`` (Spark
    observes them on their way), so nothing is read a second time to count it.
    ``save`` runs the load; ``counts`` and ``audit`` tell of it afterwards.
    """

    def __init__(self, target: DataFrame, operation: str, seen: Observation, note: Callable[..., DataFrame]):
        self.target, self.operation = target, operation
        self._seen, self._note, self._done, self._found = seen, note, False, {}

    def save(self, write: Callable[[DataFrame], None]) -> None:
        write(self.target)
        self._done = True

    @property
    def counts(self) -> dict[str, int]:
        """``source`` rows, and for a merge the rows by outcome.

        Runs the load into the no-op sink where nobody has saved it, or where
        the writer has not run the frame it was given (nothing is observed
        then, and waiting for it would never end).
        """
        def wait():
            self._found.update({k: v or 0 for k, v in self._seen.get.items()})

        if not self._found:
            run = lambda: self.save(lambda df: df.write.format("noop").mode("overwrite").save())
            if not self._done:
                run()
            waiting = threading.Thread(target=wait, daemon=True)
            waiting.start()
            waiting.join(OBSERVED_WITHIN)
            if waiting.is_alive():
                run()
                waiting.join()
        return self._found

    @property
    def audit(self) -> DataFrame:
        return self._note(self.counts["source"])


def audit_row(spark: SparkSession, cfg: LoadConfig, status: str, operation: str | None,
              src_count: Column | int | None, batch_id: int, filter_condition: str | None,
              as_of: Column | None = None, error: str | None = None) -> DataFrame:
    """Q4: one audit row (status, operation, source count, target, filter, error)."""
    ts = as_of if as_of is not None else F.current_timestamp()
    cnt = src_count if isinstance(src_count, Column) else F.lit(src_count).cast("bigint")
    return spark.range(1).select(
        F.lit(batch_id).cast("bigint").alias("batch_id"), F.lit(status).alias("status"),
        F.lit(cfg.src_system).alias("src_system"), F.lit(cfg.src_tbl).alias("src_tbl_nm"),
        F.lit(cfg.tgt_tbl).alias("tgt_tbl_nm"), F.lit(operation).cast("string").alias("operation"),
        cnt.alias("src_data_count"), F.lit(filter_condition).cast("string").alias("filter_condition"),
        ts.cast("timestamp").alias("audit_ts"), F.lit(error).cast("string").alias("error"))


def run_load(spark: SparkSession, cfg: LoadConfig, target: DataFrame, source: DataFrame | None = None,
             batch_id: int = 0, as_of: Column | None = None, delete_source: DataFrame | None = None) -> LoadResult:
    """One configured load as frames; see :class:`LoadResult`.

    Source and target are aligned by their common columns: a column that the
    source lacks keeps its value in updated rows and is NULL in new ones.
    ``source`` and ``delete_source`` override ``source_sql`` and
    ``delete_sql`` (used when the caller already holds the frames).  A full
    source also serves as the list of keys that still exist; an incremental
    one never does.  Post-SQL belongs after the write, so a config with
    ``post_sql`` runs through :func:`execute_load` only.
    """
    if cfg.post_sql:
        raise ValueError("post_sql runs after the write: use execute_load")
    return _load(spark, cfg, target, source, batch_id, as_of, delete_source)


def _fresh(src: DataFrame, target: DataFrame, cfg: LoadConfig, as_of: Column) -> DataFrame:
    """Source rows in the target's columns, those that the source lacks NULL, with the stamps of a first load."""
    rows, _, _ = align(src, target)
    return overwrite_load(ensure_columns(rows, target.schema), as_of, cfg.ld_col, cfg.upd_col).select(*target.columns)


def _gone(cfg: LoadConfig) -> bool:
    """Whether the merge itself tells which rows to delete: those in its scope that no source row matched."""
    return not cfg.src_filter and (cfg.delete_filter or cfg.tgt_filter) == cfg.tgt_filter


def _load(spark, cfg, target, source, batch_id, as_of, delete_source) -> LoadResult:
    cfg.validate()
    run_hooks(spark, cfg.pre_sql)
    given = source if source is not None else spark.sql(source_query(cfg))
    src = given.filter(cfg.src_filter) if cfg.src_filter else given
    ts = as_of if as_of is not None else merge.now_ms()
    strategy = cfg.strategy
    seen = Observation()
    op = "MERGE"
    if strategy in (OVERWRITE, TRUNCATE) or (cfg.full_load and cfg.hard_delete):
        # the rows in scope go, every source row comes in, whatever keys they share
        wide = ensure_columns(target, StructType.fromDDL(cfg.evolve)) if cfg.evolve else target
        new = _fresh(src.observe(seen, F.count(F.lit(1)).alias("source")), wide, cfg, ts)
        if cfg.tgt_filter:
            new = overwrite_where(new, wide, cfg.tgt_filter)
        if strategy == OVERWRITE:
            op = "WRITE" if cfg.tgt_filter else "CREATE OR REPLACE TABLE AS SELECT"
    else:
        mark = cfg.hash_col or "_h"                # without a fingerprint every matched row is updated
        both = (src, target) if cfg.hash_col else (src.withColumn(mark, F.lit(1)), target.withColumn(mark, F.lit(0)))
        res = merge.scd1_merge(*both, list(cfg.merge_keys), mark, tgt_filter=cfg.tgt_filter, upd_col=cfg.upd_col,
                               ld_col=cfg.ld_col, as_of=ts, order=list(cfg.order_cols) or None, evolve=cfg.evolve)
        there = delete_source
        if cfg.hard_delete and strategy == SCD1 and there is None and cfg.delete_sql:
            there = spark.sql(cfg.delete_sql)
        drop = cfg.hard_delete and strategy == SCD1
        within = drop and there is None and _gone(cfg)
        new = res.observed(seen, drop_untouched=within).drop(*([] if cfg.hash_col else [mark]))
        if drop and not within:
            new = merge.hard_delete(there if there is not None else given, new, list(cfg.merge_keys),
                                    scope=cfg.delete_filter or cfg.tgt_filter)

    def note(count: int) -> DataFrame:
        return audit_row(spark, cfg, COMPLETED, op, count, batch_id, cfg.tgt_filter, ts)
    return LoadResult(new, op, seen, note)


def execute_load(spark: SparkSession, cfg: LoadConfig, target: DataFrame, write: Callable[[DataFrame], None],
                 on_audit: Callable[[DataFrame], None] | None = None, source: DataFrame | None = None,
                 batch_id: int = 0, as_of: Column | None = None,
                 delete_source: DataFrame | None = None) -> LoadResult:
    """The whole run of one load.

    ``on_audit`` receives one row when the run starts (``running``) and one
    when it ends (``completed``, or ``failed`` with the error, which is raised
    again).  The audit's count comes from the pass that ``write`` runs.
    Post-SQL runs after the write and sees the written table.
    """
    note = on_audit or (lambda row: None)
    cfg.validate()
    note(audit_row(spark, cfg, RUNNING, None, None, batch_id, cfg.tgt_filter, as_of))
    try:
        run_hooks(spark, cfg.pre_sql)
        res = _load(spark, replace(cfg, pre_sql=()), target, source, batch_id, as_of, delete_source)
        res.save(write)
        run_hooks(spark, cfg.post_sql)
    except Exception as e:
        note(audit_row(spark, cfg, FAILED, None, None, batch_id, cfg.tgt_filter, as_of, f"{type(e).__name__}: {e}"))
        raise
    note(res.audit)
    return res


def load_files(files: Sequence[str], load_one: Callable[[str], None]) -> list[tuple[str, str, str]]:
    """Load file by file; a failure is recorded and the next file still runs.

    Returns ``(file_name, status, error)`` rows for the job log.  The loop is
    over file *names*; each call runs its own Spark job.
    """
    out = []
    for f in files:
        try:
            load_one(f)
            out.append((f, COMPLETED, ""))
        except Exception as e:  # recorded per file
            out.append((f, FAILED, f"{type(e).__name__}: {e}"))
    return out


CORRUPT, FILE = "_corrupt_record", "_file"


def scan_files(spark: SparkSession, path: str | Sequence[str], schema: StructType, fmt: str = "csv",
               options: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """I3 in one job: the rows of all whole files, and the job log of every file.

    All CSV or JSON files are parsed by one scan, each row with its file and
    with the raw text of a record that does not fit the schema, and written to
    the shared folder.  A file with such a record is ``failed`` (the log has
    the first of them and their number) and none of its rows are returned;
    the others are ``completed``, those with no rows included (a file of no
    byte at all is not listed: scans skip it).  The rows carry the file's path
    in ``_file``.
    """
    whole = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    raw = (spark.read.format(fmt).schema(whole).options(**dict(options or {}))
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).load(path))
    kept = scratch_path(spark, "files")
    raw.select("*", F.col("_metadata.file_path").alias(FILE)).write.parquet(kept)
    rows = spark.read.parquet(kept)
    bad = F.col(CORRUPT).isNotNull()
    per_file = rows.groupBy(F.col(FILE).alias("_read")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(bad).alias("n_bad"), F.min(CORRUPT).alias("first"))
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    failed = F.col("n_bad") > 0
    log = (listed.join(per_file, F.col("path") == F.col("_read"), "left")
           .select(F.col("path").alias("file_name"),
                   F.when(failed, FAILED).otherwise(COMPLETED).alias("status"),
                   F.when(failed, F.format_string("%d records do not fit, first: %s", "n_bad", "first")).otherwise("").alias("error"),
                   F.when(failed, 0).otherwise(F.coalesce("n_rows", F.lit(0))).cast("long").alias("n_rows")))
    lost = per_file.filter(failed).select(F.col("_read").alias(FILE))
    return rows.join(lost, FILE, "left_anti").select(*schema.names, FILE), log


def job_log(spark: SparkSession, rows: Sequence[tuple[str, str, str]]) -> DataFrame:
    """The outcome of :func:`load_files` as a job-log frame (file_name, status, error)."""
    return spark.createDataFrame(list(rows), "file_name string, status string, error string")
