"""Queries of discovery and download in rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraproof.functions import rules
from terraproof.operators import discovery, hydrate
from terraproof.operators.attachments import parse_attachments
from terraproof.plans.queries import _DECODE, ATTACH_SQL, hit
from terraproof.plans.registry import query
from terraproof.sources.adapters import TITLES, case, view, with_views

SITE = "https://portal.example"
ROUNDS = 3
_TEXT = lambda x: f"CAST({x} AS VARCHAR(20))"
_TITLE_A, _TITLE_B = case("page_id % 3", TITLES[:4:2] + [TITLES[13]]), case("page_id % 5", [TITLES[3], TITLES[0], TITLES[17], TITLES[5], TITLES[12]])
_ANCHOR = lambda image, title: f"""concat('<tr><td><a href="/docs/AttachmentShowServlet?ImageName=', {_TEXT(image)}, '">', {title}, '</a></td></tr>')"""
_TARGET = lambda k: "0" if k == 1 else f"page_id - page_id % 25 + (page_id * {2 * k + 1} + {k}) % 25"
_LINK = lambda k: f"""CASE WHEN page_id % 7 >= {k} AND {'page_id % 3 = 0' if k == 1 else 'true'} THEN concat('<a class="x" href="/app/', {_TEXT(_TARGET(k))}, '">View documents</a>') ELSE '' END"""
#: The driver's pages as an application portal: some show attachments, the others lead on, many of them to page 0.
PORTAL = {
    "page_id": "page_id",
    "url": f"concat('{SITE}/app/', {_TEXT('page_id')})",
    "html": "concat(html, " + ", ".join(_LINK(k) for k in range(1, 7)) + f", CASE WHEN page_id % 4 = 0 THEN concat('<table>', {_ANCHOR('page_id * 10 + 100', _TITLE_A)}, {_ANCHOR('page_id % 40', _TITLE_B)}, '</table>') ELSE '' END)",
}
_PORTAL_SQL = "portal AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in PORTAL.items()) + " FROM pages)"
VISITED_SQL = f"""WITH RECURSIVE {_PORTAL_SQL},
t AS (SELECT url AS base, regexp_extract_all(html, '(?is)<a(?:\\s[^>]*)?>.*?</a>') AS tags FROM portal),
u AS (SELECT base, unnest(tags) AS tag, generate_subscripts(tags, 1) - 1 AS position FROM t),
h AS (SELECT base, position, regexp_extract(tag, 'href\\s*=\\s*"([^"]+)"', 1) AS href, {_DECODE.format('tag')} AS text FROM u),
l AS (SELECT base, '{SITE}' || href AS target, min(position) AS position FROM h WHERE href LIKE '/%' AND NOT contains(href, 'AttachmentShowServlet') AND ({hit('text', rules.NAV_TEXT)} OR {hit('href', rules.NAV_HREF)}) GROUP BY ALL),
ways AS (SELECT * FROM (SELECT base, target, row_number() OVER (PARTITION BY base ORDER BY position) AS via FROM l) WHERE via <= 4 AND base NOT IN (SELECT url FROM portal WHERE page_id % 4 = 0)),
f AS (SELECT page_id AS application, url, 0 AS round FROM portal UNION SELECT f.application, ways.target, f.round + 1 FROM f JOIN ways ON f.url = ways.base WHERE f.round < {ROUNDS}),
v AS (SELECT application, url, min(round) AS round FROM f GROUP BY 1, 2),
w AS (SELECT c.application, c.url, c.round, min(ways.via) AS via FROM v c JOIN v p ON c.application = p.application AND p.round = c.round - 1 JOIN ways ON ways.base = p.url AND ways.target = c.url GROUP BY 1, 2, 3),
visited AS (SELECT v.application, v.url, v.round, CAST(coalesce(w.via, 0) AS INT) AS via FROM v LEFT JOIN w ON v.application = w.application AND v.url = w.url)"""


def _discovered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    portal = spark.read.parquet(f"{sf_dir}/pages.parquet").selectExpr(*(f"{e} AS {c}" for c, e in PORTAL.items()))
    return discovery.discover(portal.select(F.col("page_id").alias("application"), "url"), portal.select("url", "html"), ROUNDS)


@query(f"{VISITED_SQL} SELECT application, visited.url, round, via, portal.url IS NOT NULL AS fetched FROM visited LEFT JOIN portal ON visited.url = portal.url")
def discovery_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _discovered(spark, sf_dir)[0]


_ALL = f"""SELECT url, page_id * 10 + 100 AS image, {_TITLE_A} AS said FROM portal WHERE page_id % 4 = 0 UNION ALL SELECT url, page_id % 40, {_TITLE_B} FROM portal WHERE page_id % 4 = 0"""
_RANKED = ATTACH_SQL.split("\na AS", 1)[1].replace("FROM documents_meta", "FROM shown").replace("SELECT ordinal, url, title,", "SELECT image AS ordinal, url, title,", 1)


@query(f"""{VISITED_SQL}, shown AS (SELECT image, url, said || ' ' || said AS title FROM ({_ALL})), a AS{_RANKED},
o AS (SELECT application, CAST(r.ordinal AS VARCHAR) AS image, r.priority, round, via, visited.url AS page, row_number() OVER (PARTITION BY application, r.ordinal ORDER BY r.priority DESC, round, via, visited.url) AS k FROM visited JOIN ranked r ON visited.url = r.url)
SELECT application, image, priority, round, page FROM o WHERE k = 1""")
def discovery_attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _discovered(spark, sf_dir)[1].select("application", "image", "priority", "round", "page")


# Links outside anchors and rows ---------------------------------------------------------------------------------------

_HALF = "CAST(floor(length(html) / 2) AS INT)"
_RAW = f"concat('/x/AttachmentShowServlet?ImageName=', {_TEXT('page_id + 7')})"
_BEFORE = "CASE WHEN page_id % 3 = 0 THEN '<tr><td>Proposed site plan</td><td>' ELSE '<i>' END"
_BEHIND = "CASE WHEN page_id % 3 = 0 THEN '</td></tr>' ELSE '</i>' END"
_SCRIPTED = f"concat(substring(html, 1, {_HALF}), {_BEFORE}, 'open(\"', {_RAW}, '\")', {_BEHIND}, substring(html, {_HALF} + 1, length(html)))"
_AT = f"({_HALF} + length({_BEFORE}) + 6)"


@query(f"""WITH s AS (SELECT page_id, {_SCRIPTED} AS html, {_AT} AS place, page_id % 3 = 0 AS in_row, 'open(\"' || {_RAW} || '\")' AS said FROM pages),
t AS (SELECT *, CASE WHEN in_row THEN '<tr><td>Proposed site plan</td><td>' || said || '</td></tr>' ELSE substring(html, greatest(0, place - 500) + 1, place + 500 - greatest(0, place - 500)) END AS around FROM s)
SELECT page_id, CAST(page_id + 7 AS VARCHAR) AS image, {_DECODE.format('around')} AS row_text FROM t""")
def raw_attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses in scripts, in a table row for every third page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").selectExpr("page_id", f"'{SITE}/app' AS url", f"{_SCRIPTED} AS html")
    return parse_attachments(pages).select("page_id", "image", "row_text")


# Download -------------------------------------------------------------------------------------------------------------

RETRIES = 2
_SHA = "sha256(concat('file-', CAST(p_partkey AS VARCHAR(20))))"
_ENTRIES = {
    "id": "p_partkey",
    "file": "concat('files/', CAST(p_partkey AS VARCHAR(20)), '.pdf')",
    "url": f"CASE WHEN p_partkey % 41 = 0 THEN NULL ELSE concat('{SITE}/a/', CAST(p_partkey AS VARCHAR(20))) END",
    "transport_url": f"CASE p_partkey % 3 WHEN 0 THEN concat('{SITE.replace('https', 'http')}/a/', CAST(p_partkey AS VARCHAR(20))) WHEN 1 THEN concat('https://mirror.example/', CAST(p_partkey AS VARCHAR(20))) END",
    "tls_verification": f"CASE WHEN p_partkey % 6 = 0 THEN '{hydrate.LEGACY}' END",
    "bytes": "CASE WHEN p_partkey % 37 = 0 THEN CAST(0 AS BIGINT) ELSE p_size * 1000 END",
}
# what a made-up network answers, by the file and the number of the attempt
_CHANCE = "((id * 7 + attempts * 13 + length(address) * 3) % 12)"
_ANSWERS = {
    "error": f"CASE {_CHANCE} WHEN 0 THEN 'ETIMEDOUT' WHEN 1 THEN 'ENOTFOUND' END",
    "http_status": f"CASE {_CHANCE} WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 503 WHEN 3 THEN 404 WHEN 4 THEN 429 WHEN 5 THEN 500 ELSE 200 END",
    "final_url": f"CASE {_CHANCE} WHEN 6 THEN 'http://elsewhere.example/x' END",
    "declared_length": f"CASE WHEN {_CHANCE} = 7 THEN bytes + 1 END",
    "real_bytes": f"CASE {_CHANCE} WHEN 8 THEN NULL WHEN 9 THEN bytes - 1 ELSE bytes END",
}
_ANSWER_SQL = ", ".join(f"{e} AS {c}" for c, e in _ANSWERS.items())


def _network(attempts: DataFrame) -> DataFrame:
    numbered = attempts.withColumn("id", F.regexp_extract("file", r"(\d+)", 1).cast("long"))
    return numbered.selectExpr("*", *(f"CAST({e} AS {'STRING' if c in ('error', 'final_url') else 'INT' if c == 'http_status' else 'LONG'}) AS {c}" for c, e in _ANSWERS.items()), f"CASE WHEN {_CHANCE} = 10 THEN 'other' ELSE lower(sha256) END AS real_sha256")


@query(f"""WITH RECURSIVE e AS (SELECT {', '.join(f'{x} AS {c}' for c, x in _ENTRIES.items())} FROM part),
n AS (SELECT *, CASE WHEN id % 6 = 0 THEN [transport_url, url] WHEN id % 3 = 1 THEN [url, transport_url] ELSE [url] END AS addresses FROM e WHERE url IS NOT NULL AND bytes >= 1),
s(id, file, url, bytes, addresses, turn, k, attempts, address) AS (SELECT id, file, url, bytes, addresses, 0, 0, 1, addresses[1] FROM n
UNION ALL SELECT id, file, url, bytes, addresses, CASE WHEN k + 1 < len(addresses) THEN turn ELSE turn + 1 END, CASE WHEN k + 1 < len(addresses) THEN k + 1 ELSE 0 END, attempts + 1,
 addresses[(CASE WHEN k + 1 < len(addresses) THEN k + 1 + turn ELSE turn + 1 END) % len(addresses) + 1]
 FROM s WHERE {_CHANCE} IN (0, 2, 4, 5, 8) AND NOT (turn = {RETRIES} AND k + 1 = len(addresses))),
a AS (SELECT *, {_CHANCE} AS c, row_number() OVER (PARTITION BY id ORDER BY attempts DESC) AS last FROM s),
j AS (SELECT *, c IN (0, 2, 4, 5, 8) AS again, CASE c WHEN 0 THEN 'ETIMEDOUT' WHEN 1 THEN 'ENOTFOUND' WHEN 2 THEN 'HTTP_503' WHEN 3 THEN 'HTTP_404' WHEN 4 THEN 'HTTP_429' WHEN 5 THEN 'HTTP_500' WHEN 6 THEN 'UNSAFE_REDIRECT' WHEN 7 THEN 'CONTENT_LENGTH_EXCEEDS_MANIFEST'
 WHEN 8 THEN 'MISSING_RESPONSE_BODY' WHEN 9 THEN 'DOWNLOAD_BYTES_MISMATCH' WHEN 10 THEN 'DOWNLOAD_SHA256_MISMATCH' END AS code FROM a WHERE last = 1)
SELECT file, CASE WHEN code IS NULL THEN 'downloaded' ELSE 'failed' END AS status, CASE WHEN NOT again THEN address END AS address, CAST(attempts AS INT) AS attempts, CAST(turn AS INT) AS retries_used, code FROM j
UNION ALL SELECT file, 'failed', NULL, 0, 0, CASE WHEN url IS NULL THEN 'URL_NOT_HTTPS' ELSE 'INVALID_BYTES' END FROM e WHERE url IS NULL OR bytes < 1""")
def hydrate_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(*(f"{e} AS {c}" for c, e in _ENTRIES.items()))
    entries = entries.withColumn("sha256", F.sha2(F.concat(F.lit("file-"), F.col("id").cast("string")), 256))
    return hydrate.hydrate(entries, _network, RETRIES, allow_legacy=True)[0]
