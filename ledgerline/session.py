"""Session construction and shared helpers.

On a cluster the session already exists and carries its own settings; the
helpers here only fill in what is unset, so cluster configuration wins.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Settings we rely on.  AQE re-plans joins at runtime (broadcast when a side is
# small after filtering, coalesced shuffle partitions, skew-join splitting of
# hot keys); UTC keeps timestamps comparable with the SQL oracle.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "ledgerline",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests and benches."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(sc) -> bool:
    return sc is not None and (sc.master == "local" or sc.master.startswith("local["))


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged writes.

    The cluster names it in ``spark.checkpoint.dir`` (or has set it on the
    SparkContext).  Only a ``local`` master, where driver and executors are
    one process, gets a temporary folder when neither is set; anywhere else a
    missing setting raises, because a folder made up here would exist on one
    machine only.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server reads spark.checkpoint.dir itself
        sc = None
    if not d and sc is not None and sc.getCheckpointDir():
        d = sc.getCheckpointDir()
    if not d:
        if not _is_local(sc):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{os.getpid()}-{next(_counter)}")


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()


def read_tables(spark: SparkSession, sf_dir: str,
                names: list[str] | tuple[str, ...] = TABLES) -> dict[str, DataFrame]:
    """Lazily bind the driver tables (one parquet file each)."""
    return {n: table(spark, sf_dir, n) for n in names}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
