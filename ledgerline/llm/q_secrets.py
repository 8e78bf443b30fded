"""op7: secrets of every document."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.llm import secrets_scan as s
from ledgerline.llm.common import read, register


def listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))


def of_kinds(*names: str):
    return F.filter("spans", lambda x: x["kind"].isin(*names))


@register("op7_secrets")
def op7_secrets(spark, sf_dir):
    found = s.scan(read(spark, sf_dir, "documents"))
    base = [k.name for k in s.BASE]
    return found.select("doc_id", *[F.size(of_kinds(k)).cast("long").alias(f"n_{k}") for k in base],
                        F.sha2(listed(of_kinds(*base)), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"), "n_live", "n_spread", "n_example")
