"""Queries of grid references and of page extents under affine transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraproof.functions import grid
from terraproof.operators import evidence, georef, registration
from terraproof.plans.queries import _PAD_LAT, _PAD_LON, BBOX, ELIGIBLE, GATE_BBOX, NORMAL_STATUS
from terraproof.plans.registry import query
from terraproof.sources.adapters import view, with_views


def place_sql(name: str, source: str) -> str:
    """WITH entries that end in ``name``: the rows of ``source`` (_e, _n) with _lon and _lat."""
    made = [f"{name}0 AS (SELECT * FROM {source})"]
    for k, (column, sql) in enumerate(grid.steps(), 1):
        made.append(f"{name}{k} AS (SELECT *, {sql} AS {column} FROM {name}{k - 1})")
    return ", ".join([*made, f"{name} AS (SELECT * FROM {name}{len(grid.steps())})"])


@query(f"{with_views('grid_points')}, g AS (SELECT id, east AS _e, north AS _n FROM grid_points), {place_sql('placed', 'g')} SELECT id, round(_lon, 8) AS lon, round(_lat, 8) AS lat FROM placed")
def grid_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = grid.with_place(view(spark, sf_dir, "grid_points"), F.col("east"), F.col("north"))
    return placed.select("id", F.when(F.col("north").isNotNull(), F.round("lon", 8)).alias("lon"), F.when(F.col("east").isNotNull(), F.round("lat", 8)).alias("lat"))


@query(f"""{with_views('grid_lines')}, g AS (SELECT page, x, y, CAST(east AS DOUBLE) AS _e, CAST(north AS DOUBLE) AS _n FROM grid_lines WHERE text LIKE '%0%' AND text NOT LIKE 'sheet%' OR regexp_matches(text, '[0-9]{{5,6}}')), {place_sql('placed', 'g')},
c AS (SELECT page, count(*) AS usable, count(DISTINCT (floor(x * 100 + 0.5), floor(y * 100 + 0.5))) AS pixels,
count(*) FILTER (_lat BETWEEN {BBOX[0]} - CAST({_PAD_LAT!r} AS DOUBLE) AND {BBOX[2]} + CAST({_PAD_LAT!r} AS DOUBLE) AND _lon BETWEEN {BBOX[1]} - CAST({_PAD_LON!r} AS DOUBLE) AND {BBOX[3]} + CAST({_PAD_LON!r} AS DOUBLE)) AS inside FROM placed GROUP BY 1)
SELECT page, x, y, round(_lon, 7) AS lon, round(_lat, 7) AS lat FROM placed JOIN c USING (page) WHERE usable >= 3 AND pixels >= 3 AND inside >= 3""")
def printed_grid_controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = registration.printed_controls(view(spark, sf_dir, "grid_lines").select("page", "x", "y", "text"), "page", BBOX)
    return found.select("page", "x", "y", F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"))


# Page extents ---------------------------------------------------------------------------------------------------------


def _tilted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose four control points, made by a rotation with shear, are fitted and projected again."""
    pages = view(spark, sf_dir, "tilted")
    at = [(x, y) for x in (0.0, 60.0) for y in (0.0, 40.0)]
    point = lambda x, y: F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), (F.col("lon_x") * x + F.col("lon_y") * y + F.col("lon_0")).alias("lon"), (F.col("lat_x") * x + F.col("lat_y") * y + F.col("lat_0")).alias("lat"))
    points = pages.select("page", F.explode(F.array(*(point(x, y) for x, y in at))).alias("p")).select("page", "p.*")
    slim = pages.select("page", "status", "confidence", "offset_m", "direct", "width", "height")
    return georef.page_extents(slim, points, GATE_BBOX)


_S, _W, _N, _E = GATE_BBOX
_DEPTH = "(sides[step + 1].a * {0}.x + sides[step + 1].b * {0}.y - sides[step + 1].c)"
_CUR, _PRE = "pts[i]", "pts[CASE WHEN i = 1 THEN len(pts) ELSE i - 1 END]"
_DC, _DP = _DEPTH.format(_CUR), _DEPTH.format(_PRE)
_CROSS = f"{{'x': {_PRE}.x + ({_CUR}.x - {_PRE}.x) * {_DP} / ({_DP} - {_DC}), 'y': {_PRE}.y + ({_CUR}.y - {_PRE}.y) * {_DP} / ({_DP} - {_DC})}}"
_AREA = "abs(list_sum(list_transform(range(1, len({0}) + 1), lambda i: {0}[i].x * {0}[i % len({0}) + 1].y - {0}[i % len({0}) + 1].x * {0}[i].y))) / 2"
_D = "CAST({0} AS DOUBLE)"
_CORNER = lambda x, y: f"{{'x': lon_x * {x} + lon_y * {y} + lon_0, 'y': lat_x * {x} + lat_y * {y} + lat_0}}"
_SIDES = "[" + ", ".join(f"{{'a': {_D.format(a)}, 'b': {_D.format(b)}, 'c': {_D.format(c)}}}" for a, b, c in ((1, 0, _W), (-1, 0, -_E), (0, 1, _S), (0, -1, -_N))) + "]"
CLIPPED_SQL = f"""{with_views('tilted').replace('WITH ', 'WITH RECURSIVE ', 1)},
c(page, step, pts, sides) AS (SELECT page, 0, [{_CORNER('0', '0')}, {_CORNER('width', '0')}, {_CORNER('width', 'height')}, {_CORNER('0', 'height')}], {_SIDES} FROM tilted WHERE height IS NOT NULL
UNION ALL SELECT page, step + 1, list_filter(flatten(list_transform(range(1, len(pts) + 1), lambda i: [CASE WHEN ({_DP} >= 0) <> ({_DC} >= 0) THEN {_CROSS} END, CASE WHEN {_DC} >= 0 THEN {_CUR} END])), lambda p: p IS NOT NULL), sides FROM c WHERE step < 4),
o AS (SELECT z.page, round(greatest(0, least(1, coalesce({_AREA.format('z.pts')}, 0) / ({_AREA.format('w.pts')}))), 6) AS overlap FROM c z JOIN c w ON z.page = w.page AND z.step = 4 AND w.step = 0)"""


@query(f"{CLIPPED_SQL} SELECT page, overlap FROM tilted LEFT JOIN o USING (page)")
def projected_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tilted(spark, sf_dir).select("page", F.round("overlap", 6).alias("overlap"))


@query(f"""{CLIPPED_SQL}, g AS (SELECT *, trim(coalesce(status, '')) <> '' AS given, {NORMAL_STATUS.format('status')} AS st FROM tilted LEFT JOIN o USING (page)),
r AS (SELECT page, direct, given AND NOT {ELIGIBLE.format('st')} AS r1, confidence < CAST(0.86 AS DOUBLE) AS r2, overlap IS NULL AS r6, coalesce(overlap < CAST(0.18 AS DOUBLE), false) AS r3, NOT direct AND offset_m IS NULL AS r4, coalesce(NOT direct AND offset_m > 25, false) AS r5 FROM g)
SELECT page, NOT (r1 OR r2 OR r3 OR r4 OR r5 OR r6) AS accepted, concat_ws(',', CASE WHEN r1 THEN 'application-status-not-world-authority-eligible' END, CASE WHEN r2 THEN 'confidence-below-authority-gate' END, CASE WHEN r6 THEN 'build-geofence-overlap-unavailable' END,
CASE WHEN r3 THEN 'build-geofence-overlap-below-authority-gate' END, CASE WHEN r4 THEN 'registration-offset-unavailable' END, CASE WHEN r5 THEN 'registration-offset-above-authority-gate' END) AS reasons FROM r""")
def projected_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _tilted(spark, sf_dir).withColumn("overlap", F.round("overlap", 6))
    return evidence.page_gate(rows).select("page", "accepted", F.array_join("reasons", ",").alias("reasons"))
