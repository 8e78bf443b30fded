"""op10: near-duplicate groups of all documents by SimHash."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.llm import simhash
from ledgerline.llm.common import read, register

WIDTH, MAX_BITS = 3, 2


@register("op10_simhash")
def op10_simhash(spark, sf_dir):
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), WIDTH, MAX_BITS)
    return found.select("doc_id", simhash.as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")
