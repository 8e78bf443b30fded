"""Tables in versions on plain files: bucketed copy-on-write, whole sets of tables, batches to stream from.

Parquet folders have no transactions; what makes a version whole here is one
small commit file, written when all data files are in place.  Readers start
from the newest commit, so a job that dies before its commit leaves the last
version as it was, and its files are never looked at.

* :class:`BucketedTable` (U1, U7, U9): rows in ``buckets`` by a hash of their
  keys; a merge reads and rewrites the buckets that hold a key of the source.
* :func:`publish_all` (S11, S12): several tables, all of them or none.
* :func:`append_version` and :func:`stream_versions` (T2): batches under
  numbered folders, streamed from any of them on.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerline.operators.merge import MergeResult, scd1_merge, upsert
from ledgerline.sources.io import Source, write_all

COMMITS = "_commits"
BUCKET = "_bucket"
COMMIT_SCHEMA = "batch_id long, query_id string, buckets int, bucket int, version long"
SET_SCHEMA = "set_id long, name string, folder string"
VERSION = "version"


def _read_json(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The rows below ``path``, or None where there is nothing."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _remove(spark: SparkSession, paths: Sequence[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


@dataclass(frozen=True)
class Commit:
    """A committed state: its number, who wrote it, the number of buckets, the version of each bucket with rows."""
    number: int
    tag: str | None
    buckets: int
    versions: Mapping[int, int]


@dataclass
class BucketedTable:
    """A keyed table under ``root``, rewritten bucket by bucket.

    ``buckets`` is fixed for the life of a table: choose it so that one bucket
    is a few hundred megabytes.  The last ``keep`` commits stay readable;
    bucket versions that none of them names are removed.  One writer at a
    time: a version left without a commit is taken for a job that died, and
    written over.
    """
    root: str
    keys: Sequence[str]
    schema: StructType
    buckets: int = 32
    keep: int = 2

    def newest(self, spark: SparkSession, n: int = 1) -> list[Commit]:
        """The last ``n`` commits, newest first (a few rows per bucket)."""
        rows = _read_json(spark, f"{self.root}/{COMMITS}/*", COMMIT_SCHEMA)
        if rows is None:
            return []
        ids = [r.batch_id for r in rows.select("batch_id").distinct().orderBy(F.desc("batch_id")).limit(n).collect()]
        out = []
        for i in ids:
            part = rows.filter(F.col("batch_id") == i).collect()
            out.append(Commit(i, part[0].query_id, part[0].buckets,
                              {r.bucket: r.version for r in part if r.bucket is not None}))
        return out

    def _folder(self, bucket: int, version: int) -> str:
        return f"{self.root}/v{version:012d}/{BUCKET}={bucket}"

    def read_buckets(self, spark: SparkSession, versions: Mapping[int, int]) -> DataFrame:
        paths = [self._folder(b, v) for b, v in sorted(versions.items())]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)

    def read(self, spark: SparkSession, number: int | None = None) -> DataFrame:
        """The newest state, or that of one of the last ``keep`` commits."""
        found = self.newest(spark, 1 if number is None else self.keep)
        if number is not None:
            found = [c for c in found if c.number == number]
            if not found:
                raise ValueError(f"commit {number} of {self.root} is not kept")
        return self.read_buckets(spark, found[0].versions if found else {})

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def rewrite(self, spark: SparkSession, touched: Sequence[int], make: Callable[[DataFrame], DataFrame],
                number: int, last: Commit | None, tag: str | None = None) -> Commit:
        """Replace the ``touched`` buckets by ``make(their rows)`` and commit as ``number``."""
        versions = dict(last.versions) if last else {}
        now = self.read_buckets(spark, {b: versions[b] for b in touched if b in versions})
        out = make(now).select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields],
                               self.bucket().alias(BUCKET))
        out.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.root}/v{number:012d}")
        there = self._made(spark, number)
        versions = {**{b: v for b, v in versions.items() if b not in set(touched)}, **{b: number for b in there}}
        rows = [(number, tag, self.buckets, b, v) for b, v in sorted(versions.items())]
        spark.createDataFrame(rows or [(number, tag, self.buckets, None, None)], COMMIT_SCHEMA) \
            .coalesce(1).write.mode("overwrite").json(f"{self.root}/{COMMITS}/batch={number}")
        self._retire(spark)
        return Commit(number, tag, self.buckets, versions)

    def _made(self, spark: SparkSession, number: int) -> list[int]:
        """Buckets written as version ``number`` (a bucket that lost all its rows has no folder)."""
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/v{number:012d}")
        names = [s.getPath().getName() for s in path.getFileSystem(conf).listStatus(path)]
        return [int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}=")]

    def _retire(self, spark: SparkSession) -> None:
        """Remove the commit before the last ``keep``, and the bucket versions that no later one names."""
        last = self.newest(spark, self.keep + 1)
        if len(last) <= self.keep:
            return
        held = {(b, v) for c in last[:-1] for b, v in c.versions.items()}
        old = [self._folder(b, v) for b, v in set(last[-1].versions.items()) - held]
        _remove(spark, [*old, f"{self.root}/{COMMITS}/batch={last[-1].number}"])

    # -- batch jobs ---------------------------------------------------------------
    def _last(self, spark: SparkSession) -> Commit | None:
        found = self.newest(spark)
        if found and found[0].buckets != self.buckets:
            raise ValueError(f"the target has {found[0].buckets} buckets, not {self.buckets}")
        return found[0] if found else None

    def _touched(self, rows: DataFrame) -> list[int]:
        return [r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect()]      # at most ``buckets``

    def store(self, df: DataFrame) -> Commit:
        """The whole table anew."""
        spark = df.sparkSession
        last = self._last(spark)
        return self.rewrite(spark, range(self.buckets), lambda now: df, last.number + 1 if last else 0, last)

    def merge(self, source: DataFrame, how: Callable[[DataFrame, DataFrame], MergeResult]) -> tuple[Commit, dict[str, int]]:
        """Merge ``source`` into the buckets that hold one of its keys; the commit, and the rows by outcome.

        ``how(source, rows)`` is one of the merges, for example
        ``lambda s, t: scd1_merge(s, t, keys, "md5_key")``.  The source's key
        columns must have the table's names and types, since they pick the
        buckets.  The counts come from the pass that writes.
        """
        spark, seen = source.sparkSession, Observation()
        last = self._last(spark)
        touched = self._touched(source.select(*[F.col(k).cast(self.schema[k].dataType).alias(k) for k in self.keys]))
        if not touched:
            return last or self.store(spark.createDataFrame([], self.schema)), {}
        commit = self.rewrite(spark, touched, lambda now: how(source, now).observed(seen),
                              last.number + 1 if last else 0, last)
        return commit, {k: v or 0 for k, v in seen.get.items()}

    def scd1(self, source: DataFrame, hash_col: str, **options) -> tuple[Commit, dict[str, int]]:
        return self.merge(source, lambda s, t: scd1_merge(s, t, list(self.keys), hash_col, **options))

    def upsert(self, source: DataFrame, **options) -> tuple[Commit, dict[str, int]]:
        return self.merge(source, lambda s, t: upsert(s, t, list(self.keys), **options))

    def hard_delete(self, there: DataFrame, scope: Column | str | None = None) -> Commit | None:
        """Drop the rows in ``scope`` whose key ``there`` does not hold; only buckets that lose rows are rewritten.

        The search for them reads the key columns and those of the scope.
        """
        spark = there.sparkSession
        last = self._last(spark)
        if last is None:
            return None
        within = F.lit(True) if scope is None else F.coalesce(F.expr(scope) if isinstance(scope, str) else scope, F.lit(False))
        keys = there.select(*[F.col(k).alias(f"_k_{k}") for k in self.keys]).distinct()

        def held(rows: DataFrame) -> Column:
            cond = F.lit(True)
            for k in self.keys:
                cond = cond & rows[k].eqNullSafe(keys[f"_k_{k}"])
            return cond
        now = self.read(spark)
        mine = now.filter(within).select(*self.keys)
        touched = self._touched(mine.join(keys, held(mine), "left_anti"))
        if not touched:
            return last

        def rest(rows: DataFrame) -> DataFrame:
            inside = rows.filter(within)
            return rows.filter(~within).unionByName(inside.join(keys, held(inside), "left_semi"))
        return self.rewrite(spark, touched, rest, last.number + 1, last)


# -- sets of tables -------------------------------------------------------------------

def _sets(spark: SparkSession, root: str) -> DataFrame | None:
    return _read_json(spark, f"{root}/{COMMITS}/*", SET_SCHEMA)


def publish_all(spark: SparkSession, frames: Mapping[str, DataFrame], root: str, parallel: int = 4, keep: int = 2) -> int:
    """Write all tables as one new set, or change nothing; the number of the set.

    Every table goes to a folder of its own; only when all are written, one
    manifest names them.  A table that fails raises, and readers stay with
    the last whole set.  Truncate-then-load is publishing a set: the old rows
    are gone for readers at the same moment as the new ones are there.
    Sets before the last ``keep`` are removed.
    """
    rows = _sets(spark, root)
    number = ((rows.agg(F.max("set_id")).first()[0] if rows is not None else None) or 0) + 1
    run = f"{number:012d}-{uuid.uuid4().hex[:8]}"
    folders = {name: f"{root}/{name}/{run}" for name in frames}
    try:
        write_all(frames, {n: Source("parquet", p) for n, p in folders.items()}, "errorifexists", parallel)
    except RuntimeError:
        _remove(spark, list(folders.values()))
        raise
    spark.createDataFrame([(number, n, p) for n, p in folders.items()], SET_SCHEMA).coalesce(1) \
        .write.mode("errorifexists").json(f"{root}/{COMMITS}/set={number}")
    old = _sets(spark, root).filter(F.col("set_id") <= number - keep).collect()
    _remove(spark, [*[r.folder for r in old], *{f"{root}/{COMMITS}/set={r.set_id}" for r in old}])
    return number


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the newest whole set."""
    rows = _sets(spark, root)
    found = None if rows is None else rows.filter(F.col("name") == name).orderBy(F.desc("set_id")).first()
    if found is None:
        raise ValueError(f"no published table {name} in {root}")
    return spark.read.parquet(found.folder)


# -- batches to stream from ---------------------------------------------------------------

def append_version(df: DataFrame, root: str, version: int) -> None:
    """Add a batch of rows as ``version``; it is visible as a whole, and a number is used once."""
    df.write.mode("errorifexists").parquet(f"{root}/{VERSION}={version}")


def stream_versions(spark: SparkSession, root: str, schema: StructType, start: int = 0,
                    options: Mapping[str, str] | None = None) -> DataFrame:
    """A stream of the batches from version ``start`` on, with their number in ``version``.

    The version is a partition column, so the files of earlier batches are
    listed and pruned, never read.  The start counts for a new checkpoint;
    a query that goes on from its own checkpoint is where it was.
    """
    whole = StructType([*schema.fields, StructField(VERSION, LongType())])
    reader = spark.readStream.schema(whole).options(**dict(options or {}))
    return reader.parquet(root).filter(F.col(VERSION) >= start)
