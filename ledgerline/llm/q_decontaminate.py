"""op6: benchmark passages in every document."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.llm import decontaminate as d
from ledgerline.llm.common import read, register

SQL = r"""
WITH dw AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
bw AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bn AS (SELECT item, ws, least(10, len(ws)) AS n FROM bw WHERE len(ws) > 0),
win AS (SELECT DISTINCT item, n, array_to_string(list_slice(ws, i + 1, i + n), ' ') AS w
        FROM (SELECT item, ws, n, unnest(range(len(ws) - n + 1)) AS i FROM bn)),
occ AS (
  SELECT rid, i, n, item
  FROM (SELECT rid, ws, n, unnest(range(len(ws) - n + 1)) AS i
        FROM dw CROSS JOIN (SELECT DISTINCT n FROM win) WHERE len(ws) >= n) d
  JOIN win USING (n) WHERE array_to_string(list_slice(ws, i + 1, i + n), ' ') = win.w),
hit AS (SELECT rid, count(DISTINCT i + k) AS n_hit
        FROM (SELECT rid, i, unnest(range(n)) AS k FROM (SELECT DISTINCT rid, i, n FROM occ)) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT rid, item FROM occ WHERE item IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)
"""


@register("op6_decontaminate", SQL)
def op6_decontaminate(spark, sf_dir):
    found = d.find_leaks(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hit_ranges", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))
