"""op12: components of documents whose 3-word shingles are 90 % the same."""

from __future__ import annotations

from ledgerline.llm import ngram_join
from ledgerline.llm.common import read, register

WIDTH, PERCENT = 3, 90

SQL = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
               ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
               END AS grams FROM w),
t AS MATERIALIZED (SELECT rid, gram, n FROM (SELECT rid, unnest(grams) AS gram, len(grams) AS n FROM s)),
twice AS (SELECT gram FROM t GROUP BY gram HAVING count(*) > 1),
u AS MATERIALIZED (SELECT * FROM t WHERE gram IN (SELECT gram FROM twice)),
links AS MATERIALIZED (
  SELECT a.rid AS a, b.rid AS b FROM u a JOIN u b ON a.gram = b.gram AND a.rid <> b.rid
         AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
  GROUP BY a.rid, b.rid, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (SELECT rid, rid AS other FROM s UNION SELECT reach.rid, links.b FROM reach JOIN links ON reach.other = links.a)
SELECT s.doc_id, len(s.grams) AS n_shingles, c.component_id
FROM s JOIN (SELECT reach.rid, min(o.doc_id) AS component_id FROM reach JOIN s o ON reach.other = o.rid GROUP BY reach.rid) c
  ON s.rid = c.rid
"""


@register("op12_ngram_join", SQL)
def op12_ngram_join(spark, sf_dir):
    return ngram_join.join(read(spark, sf_dir, "documents"), WIDTH, PERCENT)
