"""op13: product codes of all embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.llm import vector_codes
from ledgerline.llm.common import read, register

# One CTE for each step: the integers by part, the first codebook, two rounds (assign, floored means), the last assignment.
_ASSIGN = """
d{k} AS (SELECT x.vec_id, x.part, b.entry, list_sum(list_transform(range(1, x.w + 1),
                lambda i: (x.v[i] - b.v[i]) * (x.v[i] - b.v[i])))::BIGINT AS gap
         FROM x JOIN b{k} b ON x.part = b.part),
a{k} AS MATERIALIZED (SELECT vec_id, part, min(gap) AS gap, arg_min(entry, gap * 64 + entry) AS entry
                      FROM d{k} GROUP BY vec_id, part)"""
_MEAN = """
m{k} AS (SELECT part, entry, list(mean ORDER BY i) AS v FROM (
           SELECT a.part, a.entry, i, floor(sum(x.v[i])::DOUBLE / count(*))::BIGINT AS mean
           FROM a{k} a JOIN x ON a.vec_id = x.vec_id AND a.part = x.part, unnest(range(1, x.w + 1)) AS r(i)
           GROUP BY a.part, a.entry, i) GROUP BY part, entry),
b{n} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.v, b.v) AS v
                      FROM b{k} b LEFT JOIN m{k} m ON b.part = m.part AND b.entry = m.entry)"""
SQL = f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS v,
                     len(embedding) // 16 AS w FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
x AS MATERIALIZED (SELECT vec_id, w, part, v[part * w + 1 : part * w + w] AS v
                   FROM kept, unnest(range(16)) AS p(part)),
b0 AS MATERIALIZED (SELECT part, dense_rank() OVER (ORDER BY vec_id) - 1 AS entry, v
                    FROM x WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64)),
{_ASSIGN.format(k=0)}, {_MEAN.format(k=0, n=1)}, {_ASSIGN.format(k=1)}, {_MEAN.format(k=1, n=2)}, {_ASSIGN.format(k=2)},
s AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b2),
e AS (SELECT vec_id, string_agg(printf('%02x', entry::INTEGER), '' ORDER BY part) AS code, sum(gap)::BIGINT AS error
      FROM a2 GROUP BY vec_id)
SELECT e.vec_id, e.code, e.error, (sum(e.error) OVER (PARTITION BY kept.label))::BIGINT AS label_error, s.codebooks_sha256
FROM e JOIN kept ON e.vec_id = kept.vec_id, s
"""


@register("op13_vector_codes", SQL)
def op13_vector_codes(spark, sf_dir):
    coded, books = vector_codes.compress(read(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", vector_codes.as_hex(F.col("codes")).alias("code"), "error", "label_error",
                        F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))
