"""Streaming SCD1 target fed from the ``events`` file.

The stream reads the events parquet file with ``availableNow``; each change
is (user_id → latest event); the final target must equal the batch result.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.catalog import register
from ledgerline.functions.keys import change_hash
from ledgerline.session import scratch_path
from ledgerline.streaming import cdc

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])

TARGET_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("event_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("changed_at", T.TimestampType()),
    T.StructField("md5_key", T.StringType()),
])


def _changes(df):
    return df.select("user_id", "event_id", "event_type", F.col("ts").cast("timestamp").alias("changed_at"),
                     change_hash(["event_type", "event_id"]).alias("md5_key"))


@register("stream_scd1_target", """
SELECT user_id, event_id, event_type,
  md5(concat_ws('-', COALESCE(event_type, '*~+'), COALESCE(CAST(event_id AS VARCHAR), '*~+'))) AS md5_key
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def stream_scd1_target(spark, d):
    root = scratch_path(spark, "stream-target")
    sink = cdc.Scd1StreamSink(root, ["user_id"], "md5_key", TARGET_SCHEMA, ["changed_at", "event_id"],
                              guard_col="changed_at")
    # a single file is streamed through a one-name glob (file sources list folders)
    src = cdc.stream_source(spark, f"{d}/{{events.parquet}}", EVENTS_SCHEMA)
    cdc.run_scd1_stream(src, sink, scratch_path(spark, "stream-ckpt"), transform=_changes, timeout_s=600)
    return sink.current(spark).select("user_id", "event_id", "event_type", "md5_key")
