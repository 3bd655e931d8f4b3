"""Query of operator 8 and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terraproof.llm.chat import END, MIDDLE, START, SYSTEM, rotate_dialogues
from terraproof.llm.common import table


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate_dialogues(table(spark, sf_dir, "conversations"))


_END = END.rstrip("\n")
SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS said FROM conversations),
r AS (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, said) - 1) // 64 AS block FROM t),
s AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> '{SYSTEM}'),
h AS (SELECT r.*, perspective, speaker = perspective AS own,
             '{START}' || CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = '{SYSTEM}' THEN '{SYSTEM}' ELSE 'user name=' || speaker END || '{MIDDLE}' AS head
      FROM r JOIN s ON r.conv_id IS NOT DISTINCT FROM s.conv_id),
n AS (SELECT *, row_number() OVER o AS k, length(head || said || '{_END}' || chr(10)) AS size FROM h
      WINDOW o AS (PARTITION BY conv_id, perspective, block ORDER BY turn NULLS FIRST, speaker, said)),
p AS (SELECT *, sum(size) OVER (PARTITION BY conv_id, perspective, block ORDER BY k) - size + length(head) AS pos FROM n)
SELECT conv_id, perspective, CAST(block AS BIGINT) AS block, count(*) AS n_turns, CAST(sum(size) AS BIGINT) AS n_chars,
       CAST(sum(CASE WHEN own THEN length(said) ELSE 0 END) AS BIGINT) AS n_masked,
       string_agg(head || said || '{_END}' || chr(10), '' ORDER BY k) AS text,
       coalesce(string_agg(CAST(pos AS BIGINT) || '+' || length(said), ',' ORDER BY k) FILTER (own), '') AS mask
FROM p GROUP BY conv_id, perspective, block"""
