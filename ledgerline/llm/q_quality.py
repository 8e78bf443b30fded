"""op8: the rule cascade over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.llm import quality_rules as q
from ledgerline.llm.common import read, register, text_of

SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
p AS (SELECT rid, unnest(ws) AS w0, unnest(range(len(ws))) AS i FROM w),
g AS (SELECT rid, i, w0, lead(w0, 1) OVER o AS w1, lead(w0, 2) OVER o AS w2
      FROM p WINDOW o AS (PARTITION BY rid ORDER BY i)),
t AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w0, w1, w2) AS n FROM g WHERE w2 IS NOT NULL),
c AS (SELECT rid, count(DISTINCT i + k) AS n FROM t CROSS JOIN (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY rid),
f AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) AS BIGINT) AS n_lines,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN c USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 30 * n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 100 * n_dup_lines > 50 * n_lines) AS kept
FROM b
"""


@register("op8_quality_rules", SQL)
def op8_quality_rules(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    order = [c.rule for c in q.plan_cascade(docs)]
    stats = q.measure(docs.select("doc_id", text_of().alias("text")))
    f = q.FromColumns()
    failed = F.lit(False)
    for r in q.BASE_RULES:
        failed = failed | r.rejects(f)
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        failed.alias("base_failed"), q.keep(f, order).alias("kept"))
