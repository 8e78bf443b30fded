"""op9: every conversation rendered from each participant's perspective."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.llm import chat
from ledgerline.llm.common import read, register

SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(turn, 0) AS turn, turn IS NOT NULL AS numbered,
         CASE WHEN trim(coalesce(role, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) = ''
              THEN 'unknown' ELSE trim(role, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) END AS speaker,
         coalesce(text, '') AS content FROM conversations),
w AS (SELECT *, greatest(1048576, 256 * (length(speaker) + length(content))) AS weight FROM t),
u AS (SELECT *, sum(weight) OVER (PARTITION BY conv_id ORDER BY numbered, turn, speaker, content
                                  ROWS UNBOUNDED PRECEDING) AS upto FROM w),
p AS (SELECT * EXCLUDE (upto), CAST((upto - weight) // (1048576 * 256) AS BIGINT) AS piece FROM u),
c AS (SELECT DISTINCT conv_id, speaker AS perspective FROM p WHERE speaker <> 'system'),
s AS (
  SELECT p.conv_id, perspective, piece, numbered, turn, speaker, content, speaker = perspective AS trained,
         '<|im_start|>' || CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant'
           ELSE 'user name=' || replace(replace(speaker, '<|im_start|>', '<|im_start |>'), '<|im_end|>', '<|im_end |>')
           END || chr(10) AS head,
         replace(replace(content, '<|im_start|>', '<|im_start |>'), '<|im_end|>', '<|im_end |>') || '<|im_end|>' AS body
  FROM p JOIN c ON p.conv_id IS NOT DISTINCT FROM c.conv_id),
o AS (SELECT *, row_number() OVER w AS k, sum(length(head) + length(body) + 1) OVER w AS upto
      FROM s WINDOW w AS (PARTITION BY conv_id, perspective, piece ORDER BY numbered, turn, speaker, content
                          ROWS UNBOUNDED PRECEDING))
SELECT conv_id, perspective, piece, count(*) AS n_turns, string_agg(head || body || chr(10), '' ORDER BY k) AS text,
       coalesce(string_agg(CAST(upto - 1 - length(body) AS BIGINT) || ':' || CAST(upto - 1 AS BIGINT), ',' ORDER BY k)
                FILTER (WHERE trained), '') AS mask
FROM o GROUP BY conv_id, perspective, piece
"""


@register("op9_chat_perspectives", SQL)
def op9_chat_perspectives(spark, sf_dir):
    made = chat.rotate(read(spark, sf_dir, "conversations"), by_rows=True)
    spans = F.transform("mask", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return made.withColumn("mask", F.concat_ws(",", spans))
