"""op1: line deduplication of all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.llm import line_dedup
from ledgerline.llm.common import read, register, text_of

SQL = r"""
WITH raw AS (SELECT row_number() OVER (ORDER BY doc_id) AS rid, doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS line,
             unnest(range(len(string_split(text, chr(10))))) AS i FROM raw),
n AS (SELECT *, sum(CASE WHEN regexp_matches(line, '[^\x20\x09-\x0D]') THEN 1 ELSE 0 END)
             OVER (PARTITION BY rid ORDER BY i) AS unit FROM l),
u AS (SELECT rid, doc_id, row_number() OVER (PARTITION BY rid ORDER BY unit) - 1 AS k,
             string_agg(line, chr(10) ORDER BY i) AS line FROM n GROUP BY rid, doc_id, unit),
b AS (SELECT *, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
             len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM u),
w AS (SELECT rid, doc_id, k, bare AS l0, lead(bare, 1) OVER o AS l1, lead(bare, 2) OVER o AS l2, words,
             words + lead(words, 1) OVER o AS words2 FROM b WINDOW o AS (PARTITION BY rid ORDER BY k)),
r AS (SELECT rid, k, 3 AS n, row_number() OVER (PARTITION BY l0, l1, l2 ORDER BY doc_id, k) AS nth
      FROM w WHERE l2 IS NOT NULL
      UNION ALL SELECT rid, k, 2, row_number() OVER (PARTITION BY l0, l1 ORDER BY doc_id, k)
      FROM w WHERE l1 IS NOT NULL AND words2 >= 50
      UNION ALL SELECT rid, k, 1, row_number() OVER (PARTITION BY l0 ORDER BY doc_id, k) FROM w WHERE words >= 50),
gone AS (SELECT DISTINCT rid, k + unnest(range(n)) AS k FROM r WHERE nth > 1),
m AS (SELECT u.rid, u.doc_id, u.k, u.line, gone.k IS NOT NULL AS removed,
             lag(gone.k IS NOT NULL) OVER (PARTITION BY u.rid ORDER BY u.k) AS before
      FROM u LEFT JOIN gone ON u.rid = gone.rid AND u.k = gone.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE removed) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT removed), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id
"""


# Repeated runs are deleted from three lines on, and from so many words on whatever their lines.
PASSAGE_WORDS = 50


@register("op1_line_dedup", SQL)
def op1_line_dedup(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    done = line_dedup.dedup(docs, passage_words=PASSAGE_WORDS)
    return done.select("doc_id", "n_lines", "n_removed", F.sha2(text_of(), 256).alias("kept_sha256"))
