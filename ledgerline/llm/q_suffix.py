"""op4: repeated 100-byte strings of all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.llm import suffix_dedup
from ledgerline.llm.common import read, register, text_of


@register("op4_suffix_dedup")
def op4_suffix_dedup(spark, sf_dir):
    done = suffix_dedup.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"])
    return done.select("doc_id", F.octet_length(text_of()).cast("long").alias("n_bytes"), gone.alias("n_removed"),
                       F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
