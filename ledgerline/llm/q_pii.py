"""op2: personal data of every document."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.llm import pii
from ledgerline.llm.common import read, register


def of_kind(name):
    return lambda s: s["kind"] == name


@register("op2_pii")
def op2_pii(spark, sf_dir):
    found = pii.detect(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = [k.name for k in pii.BASE]
    count = [F.size(F.filter("spans", of_kind(k))).cast("long").alias(f"n_{k}") for k in base]
    return found.select(
        "doc_id", *count,
        F.sha2(pii.listed(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"))
