"""Query of operator 2 and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terraproof.llm.common import table
from terraproof.llm.quality import MAX_REPEAT_PERCENT, MIN_WORDS, RULES, STOP_WORDS, score_quality


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), "doc_id", "text")


def rules_sql() -> str:
    """The threshold table as a SQL condition."""
    parts = []
    for r in RULES:
        ratio = f"(CASE WHEN {r.denominator} > 0 THEN CAST({r.numerator} AS DOUBLE) / CAST({r.denominator} AS DOUBLE) ELSE 0.0 END)"
        parts += [f"{ratio} >= CAST({r.least} AS DOUBLE)"] * (r.least > 0) + [f"{ratio} <= CAST({r.most} AS DOUBLE)"] * (r.most < float("inf"))
    return " AND ".join(parts)


def quality_sql(source: str) -> str:
    """Figures and verdicts of ``source`` (doc_id unique, text), without a trailing order."""
    stops = ", ".join(f"'{x}'" for x in sorted(set(STOP_WORDS.split())))
    return rf"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM {source}),
    w AS (SELECT doc_id, list_filter(string_split_regex(t, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS words,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines,
                 length(t) - length(regexp_replace(t, '[^ \t\n\x0B\f\r]', '', 'g')) AS word_chars,
                 length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                 length(t) - length(regexp_replace(t, '[!?]', '', 'g')) AS n_shouts,
                 length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) AS n_upper FROM d),
    e AS (SELECT doc_id, unnest(words) AS x, generate_subscripts(words, 1) AS i FROM w),
    g AS (SELECT doc_id, x, i, lead(x, 1) OVER o AS y, lead(x, 2) OVER o AS z FROM e WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    f AS (SELECT doc_id, x, i, z IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, x, y, z) > 1 AS twice FROM g),
    r AS (SELECT doc_id, x, bool_or(twice) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS inside FROM f),
    s AS (SELECT doc_id, count(*) FILTER (inside) AS n_repeat_words, count(*) FILTER (lower(x) IN ({stops})) AS n_stop_words FROM r GROUP BY doc_id),
    a AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
                 CAST(n_shouts AS BIGINT) AS n_shouts, CAST(n_upper AS BIGINT) AS n_upper, CAST(coalesce(n_stop_words, 0) AS BIGINT) AS n_stop_words,
                 CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                 CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
          FROM w LEFT JOIN s USING (doc_id)),
    b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM a)
    SELECT *, NOT base_failed AND {rules_sql()} AS kept FROM b"""


SQL = quality_sql("documents")
