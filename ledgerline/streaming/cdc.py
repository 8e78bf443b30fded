"""Change streams into an SCD1 target.

``readStream`` → ``foreachBatch``: each micro-batch is reduced to the latest
change per key (partial aggregate, so a hot key costs one row per task) and
merged with :func:`ledgerline.operators.merge.scd1_merge`, with the
late-change guard on.  The target is kept in ``buckets`` by a hash of its
keys: a batch reads and rewrites only the buckets that hold a changed key, so
its cost follows the change and not the target (a
:class:`ledgerline.sources.versioned.BucketedTable`).  The new bucket files are
written beside the old ones and then committed by one small file per batch
that names the version of every bucket; a replayed batch (after a driver or
executor failure) finds its commit and is skipped, so each batch is applied
exactly once.  Versions that neither of the last two commits names are
removed.

The commit also holds the streaming query's id.  A new checkpoint numbers its
batches from 0 again, which would look like a replay; it raises instead.

Paths are on the shared folder the cluster names in ``spark.checkpoint.dir``
(or any shared path the caller gives); nothing is kept on a local disk.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.operators.dedupe import latest
from ledgerline.operators.merge import scd1_merge
from ledgerline.sources.versioned import BucketedTable


@dataclass
class Scd1StreamSink:
    """``foreachBatch`` handler keeping an SCD1 target under ``root``.

    ``target_schema`` fixes the target columns; ``order`` picks the latest
    change per key inside a batch; ``hash_col`` is the change fingerprint;
    ``guard_col`` is the source change time used to ignore late changes
    (``upd_col``/``ld_col``, when given, are stamped with the load time).
    ``buckets`` is fixed for the life of a target: choose it so that one
    bucket is a few hundred megabytes.
    """
    root: str
    keys: Sequence[str]
    hash_col: str
    target_schema: StructType
    order: Sequence[str]
    upd_col: str | None = None
    ld_col: str | None = None
    guard_col: str | None = None
    buckets: int = 32

    @property
    def table(self) -> BucketedTable:
        return BucketedTable(self.root, self.keys, self.target_schema, self.buckets)

    def committed(self, spark: SparkSession) -> tuple[int, dict[int, int]] | None:
        last = self.table.newest(spark)
        return (last[0].number, dict(last[0].versions)) if last else None

    def current(self, spark: SparkSession) -> DataFrame:
        return self.table.read(spark)

    # -- one micro-batch --------------------------------------------------------
    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        last = next(iter(self.table.newest(spark)), None)
        if last:
            if last.buckets != self.buckets:
                raise ValueError(f"the target has {last.buckets} buckets, not {self.buckets}")
            if query and last.tag and query != last.tag:
                raise ValueError(f"target {self.root} was written by stream {last.tag}; this is stream {query} with a "
                                 "checkpoint of its own, whose batch numbers cannot be compared")
            if batch_id <= last.number:
                return  # replayed batch: already applied
        changes = latest(batch, list(self.keys), list(self.order)).persist()
        try:
            touched = [r[0] for r in changes.select(self.table.bucket()).distinct().collect()]   # at most ``buckets``

            def merged(now: DataFrame) -> DataFrame:
                return scd1_merge(changes, now, list(self.keys), self.hash_col, upd_col=self.upd_col, ld_col=self.ld_col,
                                  ignore_older=True, guard_col=self.guard_col, on_duplicates="keep").target
            self.table.rewrite(spark, touched, merged, int(batch_id), last, query)
        finally:
            changes.unpersist()


def stream_source(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet",
                  options: dict | None = None) -> DataFrame:
    """A change stream.  For file sources the start position lives in the
    query checkpoint; for Delta change feeds pass ``startingVersion`` in
    ``options`` (needs the Delta package on the cluster)."""
    r = spark.readStream.format(fmt).schema(schema)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path)


def run_scd1_stream(changes: DataFrame, sink: Scd1StreamSink, checkpoint: str,
                    transform=None, available_now: bool = True, timeout_s: int | None = None):
    """Run the stream into the sink (``availableNow`` processes what is
    there and stops; otherwise it keeps running and the query is returned)."""
    df = transform(changes) if transform is not None else changes
    w = df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if available_now:
        q = w.trigger(availableNow=True).start()
        if q.awaitTermination(timeout_s) is False:
            q.stop()
            raise TimeoutError(f"the stream has not finished after {timeout_s} s; its committed batches stay")
        return q
    return w.start()


def batch_equivalent(changes: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The batch result a stream must reproduce from an empty target: the
    latest change per key (T4's batch companion)."""
    return latest(changes, list(keys), list(order))
