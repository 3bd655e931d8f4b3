"""Queries of readers and small rules that had none, over rows that are made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraproof.functions import geo, text
from terraproof.operators import cache, documents, georef, matching, semantics
from terraproof.plans import planning_pass
from terraproof.plans.queries import BBOX, SELECTED_SQL
from terraproof.plans.registry import query
from terraproof.sources import sinks
from terraproof.sources.adapters import LABELS, case, view

_D = lambda x: f"CAST({x} AS DOUBLE)"
_T = lambda x: f"CAST({x} AS VARCHAR(20))"


def _rows(spark: SparkSession, sf_dir: str, table: str, *expressions: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").selectExpr(*expressions)


# Words ----------------------------------------------------------------------------------------------------------------

_TSV_HEAD = "\\t".join(("level", "page_num", "block_num", "par_num", "line_num", "word_num", "left", "top", "width", "height", "conf", "text"))
_LABEL = case("o_orderkey % 14", LABELS)
_CONF = "CASE WHEN o_orderkey % 9 = 0 THEN 'x' WHEN o_orderkey % 9 = 1 THEN '' ELSE CAST(o_custkey % 100 AS VARCHAR(9)) END"
_TSV_SPARK = f"concat('{_TSV_HEAD}', '\\n', '5\\t1\\t1\\t2\\t', {_T('o_orderkey % 7')}, '\\t1\\t', {_T('o_orderkey % 300')}, '\\t20\\t30\\t12\\t', {_CONF}, '\\t', {_LABEL}, '\\n', '\\n', '5\\t1\\t1\\t2\\t3\\t1\\t7\\t8\\t9\\t10\\t95\\tword')"


@query(f"""WITH w AS (SELECT o_orderkey AS id, '1:1:2:' || (o_orderkey % 7) AS line_id, 0 AS pos, trim({_LABEL}) AS text, {_D('o_orderkey % 300')} * 2 AS "left", {_D(20)} * 3 AS top, {_D(30)} * 2 AS width, {_D(12)} * 3 AS height,
 CASE WHEN o_orderkey % 9 = 0 THEN -1 WHEN o_orderkey % 9 = 1 THEN 0 ELSE o_custkey % 100 END AS conf FROM orders
UNION ALL SELECT o_orderkey, '1:1:2:3', 1, 'word', 14, 24, 18, 30, 95 FROM orders) SELECT id, line_id, CAST(pos AS INT) AS pos, text, "left", top, width, height, {_D('conf')} / 100 AS confidence FROM w WHERE conf >= 35 AND coalesce(text, '') <> ''""")
def ocr_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _rows(spark, sf_dir, "orders", "o_orderkey AS id", f"{_TSV_SPARK} AS tsv")
    return semantics.tsv_words(tables, scale_x=2, scale_y=3)


_XHTML = f"""concat('<page width="', {_T('500 + o_custkey % 3 * 100')}, '" height="800"><flow><block><line xMin="1"><word xMin="', {_T('o_orderkey % 90')}, '" yMin="10" xMax="', {_T('o_custkey % 120')}, '" yMax="20">Track &amp; station</word>\n<word xMin="5" yMin="5" xMax="6.5" yMax="4">upside</word></line></block></flow></page>')"""


@query(f"""SELECT o_orderkey AS id, CAST(0 AS INT) AS line_id, CAST(0 AS INT) AS pos, 'Track & station' AS text, round({_D('o_orderkey % 90')} * (1000 / {_D('500 + o_custkey % 3 * 100')}), 6) AS "left", {_D(10)} * 2 AS top,
round({_D('o_custkey % 120 - o_orderkey % 90')} * (1000 / {_D('500 + o_custkey % 3 * 100')}), 6) AS width, {_D(20)} AS height FROM orders WHERE o_custkey % 120 >= o_orderkey % 90""")
def embedded_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _rows(spark, sf_dir, "orders", "o_orderkey AS id", f"{_XHTML} AS xhtml").withColumns({"width": F.lit(1000.0), "height": F.lit(1600.0)})
    return semantics.bbox_words(pages).select("id", "line_id", "pos", "text", F.round("left", 6).alias("left"), "top", F.round("width", 6).alias("width"), "height")


_INFO = f"""CASE o_orderkey % 4 WHEN 0 THEN concat('Title: x\nPage size:      ', {_T('o_custkey')}, ' x 792.5 pts (letter)\n') WHEN 1 THEN concat('Page    1 size: 100 x 200 pts\nPage    2 size: ', {_T('o_custkey')}, '.25 x 300 pts\n') WHEN 2 THEN 'Page size: 0 x 5 pts' END"""


@query(f"""SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN nullif({_D('o_custkey')}, 0) WHEN 1 THEN {_D('o_custkey')} + 0.25 END AS width, CASE o_orderkey % 4 WHEN 0 THEN CASE WHEN o_custkey > 0 THEN {_D(792.5)} END WHEN 1 THEN {_D(300)} END AS height FROM orders""")
def page_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir, "orders", "o_orderkey AS id", f"{_INFO} AS info").select("id", text.page_size(F.col("info"), 2).alias("s")).select("id", "s.width", "s.height")


# Control points -------------------------------------------------------------------------------------------------------


@query(f"""SELECT o_orderkey AS id, k, CASE WHEN k >= 2 THEN {_D('o_custkey')} ELSE 0 END AS x, CASE WHEN k IN (1, 2) THEN {_D(700)} ELSE 0 END AS y, {_D('o_orderkey % 50')} + k AS lon, {_D('o_orderkey % 40')} - k AS lat
FROM orders, (VALUES (0), (1), (2), (3)) v(k) WHERE o_custkey % 5 <> 0 AND o_orderkey % 6 <> 0""")
def extent_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    corner = lambda k: f"named_struct('lon', {_D('o_orderkey % 50')} + {k}, 'lat', CASE WHEN o_orderkey % 6 = 0 AND {k} = 2 THEN NULL ELSE {_D('o_orderkey % 40')} - {k} END)"
    rows = _rows(spark, sf_dir, "orders", "o_orderkey AS id", "CASE WHEN o_custkey % 5 = 0 THEN 0D ELSE CAST(o_custkey AS DOUBLE) END AS width", f"array({', '.join(map(corner, range(5)))}) AS ring")
    points = geo.extent_controls(F.col("ring"), F.col("width"), F.lit(700.0))
    return rows.select("id", F.posexplode(points).alias("k", "p")).select("id", "k", "p.x", "p.y", "p.lon", "p.lat")



@query(f"""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 AND o_custkey % 400 <= 180 THEN {_D('o_custkey % 400')} WHEN o_custkey % 3 > 0 THEN {_D('o_custkey % 180')} END AS longitude,
CASE WHEN o_orderkey % 2 = 0 AND o_custkey % 400 <= 180 THEN {_D('o_orderkey % 90')} WHEN o_custkey % 3 > 0 THEN {_D(-12.5)} END AS latitude FROM orders""")
def location_priors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first place that may be a text or out of range, then a second that may be missing."""
    rows = _rows(spark, sf_dir, "orders", "o_orderkey AS id", "CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey % 400 AS STRING) ELSE 'east' END AS a", "CAST(o_orderkey % 90 AS STRING) AS b", "CASE WHEN o_custkey % 3 > 0 THEN o_custkey % 180 END AS c")
    return rows.select("id", geo.location_prior((F.col("a"), F.col("b")), (F.col("c"), F.lit(-12.5))).alias("p")).select("id", "p.longitude", "p.latitude")


@query("""SELECT o_orderkey AS id, CAST(CASE WHEN o_custkey % 4 >= 1 THEN o_custkey % 4 + 2 WHEN o_orderkey % 5 >= 3 THEN o_orderkey % 5 ELSE 0 END AS INT) AS points FROM orders""")
def explicit_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lists of points, some of the first of which are for another page."""
    point = "named_struct('x', 1D, 'y', 2D, 'lon', 3D, 'lat', 4D, 'page', {})"
    first = f"transform(sequence(1, CAST(o_custkey % 4 + 2 AS INT)), i -> {point.format('CASE WHEN o_custkey % 4 = 0 THEN 9 WHEN i = 1 THEN NULL ELSE 2 END')})"
    second = f"CASE WHEN o_orderkey % 5 > 0 THEN transform(sequence(1, CAST(o_orderkey % 5 AS INT)), i -> {point.format('2')}) END"
    rows = _rows(spark, sf_dir, "orders", "o_orderkey AS id", f"{first} AS a", f"{second} AS b")
    return rows.select("id", geo.explicit_controls(F.lit(2), F.col("a"), F.col("b")).alias("p")).select("id", F.when(F.col("p").isNotNull(), F.size("p")).otherwise(0).alias("points"))


# Documents ------------------------------------------------------------------------------------------------------------

_STATE = "CASE WHEN p_partkey % 5 = 0 THEN 'missing' WHEN p_partkey % 7 = 0 OR p_partkey % 11 = 0 THEN 'mismatch' ELSE 'reused' END"


def _verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "concat('f', CAST(p_partkey AS STRING))"
    entries = _rows(spark, sf_dir, "part", f"{name} AS file", "p_partkey AS id", f"CAST(length(p_name) + CASE WHEN p_partkey % 7 = 0 THEN 1 ELSE 0 END AS BIGINT) AS bytes", "upper(sha2(CASE WHEN p_partkey % 11 = 0 THEN 'other' ELSE p_name END, 256)) AS sha256")
    files = _rows(spark, sf_dir, "part", f"{name} AS file", "CAST(p_name AS BINARY) AS content", "p_partkey").filter("p_partkey % 5 <> 0").drop("p_partkey")
    return documents.verify_files(entries, files)


@query(f"SELECT p_partkey AS id, {_STATE} AS state FROM part")
def file_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verified(spark, sf_dir).select("id", "state")


@query(f"""SELECT count(*) AS entries, count(*) FILTER (s = 'reused') AS reused, count(*) FILTER (s = 'missing') AS missing, count(*) FILTER (s = 'mismatch') AS mismatch, CAST(coalesce(sum(b) FILTER (s = 'reused'), 0) AS BIGINT) AS reused_bytes
FROM (SELECT {_STATE} AS s, length(p_name) + CASE WHEN p_partkey % 7 = 0 THEN 1 ELSE 0 END AS b FROM part)""")
def hydrate_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.hydrate_stats(_verified(spark, sf_dir))


@query("SELECT p_brand AS application, count(*) AS documents, min(p_partkey) AS first, CAST(sum(p_size) AS BIGINT) AS bytes FROM part GROUP BY 1")
def grouped_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir, "part", "p_brand AS application", "p_partkey AS ordinal", "p_name AS url", "p_type AS title", "p_size AS bytes")
    return documents.group_applications(rows).select("application", F.size("documents").cast("long").alias("documents"), F.col("documents")[0]["ordinal"].alias("first"), "bytes")


@query(f"""SELECT o_orderkey AS id, CASE WHEN o_custkey % 3 = 0 THEN 'printed' ELSE 'visual-registration' END AS method, CAST(least(12, o_custkey % 20) AS INT) AS n, CAST(least(12, o_custkey % 20) AS INT) AS last_rank
FROM orders WHERE o_orderstatus IN ('O', 'F') AND o_orderkey % 4 <> 0""")
def kept_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir, "orders", "o_orderkey AS id", "CASE WHEN o_orderkey % 4 = 0 THEN 'rejected' WHEN o_orderstatus = 'O' THEN 'accepted' WHEN o_orderstatus = 'F' THEN 'candidate' END AS status", "CASE WHEN o_custkey % 3 = 0 THEN 'printed' END AS method", "CASE WHEN o_custkey % 20 > 0 THEN transform(sequence(1, CAST(o_custkey % 20 AS INT)), i -> CAST(i AS DOUBLE)) END AS alternatives")
    return documents.page_candidates(rows).select("id", "method", F.size("alternatives").alias("n"), F.coalesce(F.try_element_at("alternatives", F.lit(-1))["rank"], F.lit(0)).alias("last_rank"))


@query("SELECT p_partkey AS id FROM part WHERE p_partkey % 6 = 0 OR p_partkey % 10 = 0")
def invalid_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _rows(spark, sf_dir, "part", "p_partkey AS id", "p_name AS file", "CAST(p_size AS BIGINT) AS size", "p_partkey AS modified")
    files = _rows(spark, sf_dir, "part", "p_name AS file", "CAST(p_size + CASE WHEN p_partkey % 6 = 0 THEN 1 ELSE 0 END AS BIGINT) AS size", "p_partkey + CASE WHEN p_partkey % 10 = 0 THEN 1 ELSE 0 END AS modified")
    return cache.still_valid(stored, files).select("id")


_V = planning_pass.VERSIONS


@query(f"""WITH p AS (SELECT o_orderkey AS id, sha256(CAST(o_custkey AS VARCHAR)) AS s, o_orderkey % 9 AS page FROM orders)
SELECT id, 'planning-render-' || sha256('planning-render' || chr(0) || '{{"dpi":240,"page":' || page || ',"sha256":"' || s || '","version":"{_V['render']}"}}') AS render_key,
'planning-semantic-' || sha256('planning-semantic' || chr(0) || '{{"page_sha256":"' || upper(s) || '","version":"{_V['semantic']}"}}') AS semantic_key,
'planning-registration-' || sha256('planning-registration' || chr(0) || '{{"bbox":"1,2,3,4","page_sha256":"' || upper(s) || '","reference_hash":"r","version":"{_V['registration']}"}}') AS registration_key FROM p""")
def stage_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir, "orders", "o_orderkey AS id", "sha2(CAST(o_custkey AS STRING), 256) AS sha256", "o_orderkey % 9 AS page").withColumns({"page_sha256": F.upper("sha256"), "semantic_hash": F.lit("s"), "reference_hash": F.lit("r"), "transform_hash": F.lit("t")})
    return planning_pass.stage_keys(rows, "1,2,3,4").select("id", "render_key", "semantic_key", "registration_key")


@query("""SELECT o_orderkey AS id, coalesce(o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AND (o_custkey % 3 = 0 OR o_custkey % 4 <> 0), false) AS valid FROM orders""")
def artifact_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are not there, renders without a digest, sizes that are not told or told wrongly."""
    path = "concat('r/', CAST(o_orderkey AS STRING))"
    renders = _rows(spark, sf_dir, "orders", "o_orderkey AS id", f"{path} AS path", "CASE WHEN o_orderkey % 7 <> 0 THEN 'abc' END AS sha256", "CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_custkey + CASE WHEN o_custkey % 4 = 0 THEN 1 ELSE 0 END END AS bytes")
    files = _rows(spark, sf_dir, "orders", f"{path} AS path", "o_custkey AS length", "o_orderkey AS k").filter("k % 5 <> 0").drop("k")
    return documents.valid_artifacts(renders, files).select("id", "valid")


@query("SELECT o_orderkey AS id, CASE WHEN o_custkey % 2 = 0 THEN sha256('p' || o_custkey) ELSE sha256(CASE WHEN o_custkey % 3 = 0 THEN '{}' ELSE o_orderpriority END) END AS digest FROM orders")
def payload_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir, "orders", "o_orderkey AS id", "CASE WHEN o_custkey % 2 = 0 THEN upper(sha2(concat('p', CAST(o_custkey AS STRING)), 256)) WHEN o_custkey % 5 = 0 THEN 'no digest' END AS provided", "CASE WHEN o_custkey % 3 <> 0 THEN o_orderpriority END AS payload")
    return rows.select("id", text.payload_hash(F.col("provided"), F.col("payload")).alias("digest"))


@query(SELECTED_SQL + "SELECT m.application, count(*) FILTER (m.rank > 1) AS alternative_documents FROM m JOIN b ON m.application = b.application AND m.a_doc = b.a_doc AND m.a = b.a WHERE b.documents >= 2 GROUP BY 1")
def consensus_alternatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks begin with 1 here."""
    return georef.alternatives_used(georef.consensus(georef.variants(view(spark, sf_dir, "georef")))[1], first_rank=1)


# Reference and output -------------------------------------------------------------------------------------------------

_MID_LON, _MID_LAT = (BBOX[1] + BBOX[3]) / 2, (BBOX[0] + BBOX[2]) / 2
_UNIT = f"(CAST({geo.EARTH_RADIUS_M!r} AS DOUBLE) * pi() / 180)"
_LON, _LAT = f"({_D(repr(_MID_LON))} + {_D('s_suppkey % 50')} / 10000)", f"({_D(repr(_MID_LAT))} - {_D('s_suppkey % 30')} / 10000)"


@query(f"""SELECT 'osm:way:' || s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN 'building' WHEN s_suppkey % 3 = 1 THEN 'path' ELSE 'fence' END AS kind, CASE WHEN s_suppkey % 3 = 0 AND s_suppkey % 2 = 0 THEN 'Polygon' WHEN s_suppkey % 7 = 0 THEN 'Point' ELSE 'LineString' END AS form,
CAST(CASE WHEN s_suppkey % 3 = 0 AND s_suppkey % 2 = 0 THEN 4 WHEN s_suppkey % 7 = 0 THEN 1 ELSE 3 END AS INT) AS n, round(({_LON} - {_D(repr(_MID_LON))}) * (cos(radians({_D(repr(_MID_LAT))})) * {_UNIT}), 4) AS x, round(({_LAT} - {_D(repr(_MID_LAT))}) * {_UNIT}, 4) + 0.0 AS y
FROM supplier WHERE s_suppkey % 11 <> 0""")
def osm_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ways that close, ways that do not, nodes; a tag that is not mapped falls away."""
    point = lambda k: f"named_struct('lon', {_LON} + {k}, 'lat', {_LAT} - {k})"
    line = f"CASE WHEN s_suppkey % 3 = 0 AND s_suppkey % 2 = 0 THEN array({point('0D')}, {point('0.001D')}, {point('0.002D')}, {point('0D')}) WHEN s_suppkey % 7 = 0 THEN NULL ELSE array({point('0D')}, {point('0.001D')}, {point('0.002D')}) END"
    tags = "CASE WHEN s_suppkey % 11 = 0 THEN map('shop', 'yes') WHEN s_suppkey % 3 = 0 THEN map('building', 'yes') WHEN s_suppkey % 3 = 1 THEN map('highway', 'footway') ELSE map('barrier', 'fence') END"
    rows = _rows(spark, sf_dir, "supplier", "'way' AS type", "s_suppkey AS id", f"{tags} AS tags", f"{line} AS geometry", f"{_LON} AS lon", f"{_LAT} AS lat")
    found = matching.projected(matching.normalize_reference(rows), BBOX)
    return found.select("id", "kind", "form", F.size("points").alias("n"), F.round(F.col("points")[0]["x"], 4).alias("x"), (F.round(F.col("points")[0]["y"], 4) + 0.0).alias("y"))


@query(f"""SELECT '{{"type":"Feature","id":"' || o_orderkey || '","geometry":{{"type":"MultiLineString","coordinates":[[[' || {_D('o_custkey')} || ',1.5],[2.0,3.0]],[[4.0,' || {_D('o_orderkey % 9')} || '],[5.0,6.0]]]}},"properties":{{"kind":"' || o_orderstatus || '","n":' || o_custkey || '}}}}' AS value FROM orders""")
def geojson_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = lambda x, y: f"named_struct('lon', {x}, 'lat', {y})"
    parts = f"array(array(array({p('CAST(o_custkey AS DOUBLE)', '1.5D')}, {p('2D', '3D')})), array(array({p('4D', 'CAST(o_orderkey % 9 AS DOUBLE)')}, {p('5D', '6D')})))"
    return sinks.features_json(_rows(spark, sf_dir, "orders", "o_orderkey AS id", "'MultiLineString' AS form", f"{parts} AS parts", "o_orderstatus AS kind", "o_custkey AS n"))


@query("SELECT p_partkey AS id, trim(regexp_replace(lower(coalesce(p_name || ' #' || p_brand, '')), '[^a-z0-9]+', ' ', 'g')) AS name FROM part")
def normal_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir, "part", "p_partkey AS id", "concat(p_name, ' #', p_brand) AS name").select("id", text.normal_name(F.col("name")).alias("name"))


@query("SELECT p_brand AS application, CAST(count(DISTINCT p_brand) AS BIGINT) AS live_applications, count(*) AS documents_downloaded, CAST(sum(p_size) AS BIGINT) AS total_bytes FROM part WHERE p_size <> 5 AND p_brand = (SELECT min(p_brand) FROM part) GROUP BY 1")
def corpus_recount(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir, "part", "p_brand AS application", "p_size AS bytes")
    first = rows.agg(F.min("application").alias("first"))
    mine = documents.replace_in_corpus(rows, "bytes = 5", rows.limit(0), "bytes").join(F.broadcast(first), F.col("application") == F.col("first"), "left_semi")
    return documents.corpus_counts(mine).crossJoin(first.select(F.col("first").alias("application")))
