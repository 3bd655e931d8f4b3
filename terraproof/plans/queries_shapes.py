"""Queries of drawn shapes: closing, borders, lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraproof.operators import contours, raster
from terraproof.plans.registry import query
from terraproof.sources.adapters import view, with_views

_W, _H, _B = 60, 51, contours.COLUMN_BITS
_OFFSETS = "(VALUES (-1), (0), (1)) a(dx), (VALUES (-1), (0), (1)) b(dy)"
_CLOSED = f"""{with_views('strokes').replace('WITH ', 'WITH RECURSIVE ', 1)}, px AS (SELECT DISTINCT page, x, y FROM strokes WHERE x IS NOT NULL AND y IS NOT NULL),
wide AS (SELECT DISTINCT page, x + dx AS x, y + dy AS y FROM px, {_OFFSETS} WHERE x + dx BETWEEN 0 AND {_W - 1} AND y + dy BETWEEN 0 AND {_H - 1}),
shut AS (SELECT w.page, w.x, w.y FROM (SELECT page, x, y, x + dx AS nx, y + dy AS ny FROM wide, {_OFFSETS}) w JOIN wide n ON w.page = n.page AND w.nx = n.x AND w.ny = n.y GROUP BY 1, 2, 3
 HAVING count(*) = (least(w.x + 1, {_W - 1}) - greatest(w.x - 1, 0) + 1) * (least(w.y + 1, {_H - 1}) - greatest(w.y - 1, 0) + 1))"""
_SIDES = ", ".join(f"({d}, {a[0]}, {a[1]}, {o[0]}, {o[1]})" for d, (a, o) in enumerate(zip(contours.ALONG, contours.OUTWARD, strict=True)))
_NUMBER = lambda x, y, d: f"((CAST({y} AS BIGINT) * {1 << _B} + {x}) * 4 + {d})"
_BORDERS = f"""{_CLOSED}, s AS (SELECT page, x, y, d, ax, ay, ox, oy FROM shut, (VALUES {_SIDES}) v(d, ax, ay, ox, oy) WHERE NOT EXISTS (SELECT 1 FROM shut n WHERE n.page = shut.page AND n.x = shut.x + ox AND n.y = shut.y + oy)),
n AS (SELECT s.page, {_NUMBER('s.x', 's.y', 'd')} AS id, CASE WHEN l.page IS NOT NULL THEN {_NUMBER('s.x + ax + ox', 's.y + ay + oy', '(d + 3) % 4')} WHEN h.page IS NOT NULL THEN {_NUMBER('s.x + ax', 's.y + ay', 'd')} ELSE {_NUMBER('s.x', 's.y', '(d + 1) % 4')} END AS after
 FROM s LEFT JOIN shut l ON l.page = s.page AND l.x = s.x + ax + ox AND l.y = s.y + ay + oy LEFT JOIN shut h ON h.page = s.page AND h.x = s.x + ax AND h.y = s.y + ay),
w(page, start, before, pos, k) AS (SELECT page, id, id, after, 1 FROM n UNION ALL SELECT w.page, w.start, w.pos, n.after, k + 1 FROM w JOIN n ON w.page = n.page AND w.pos = n.id WHERE w.pos > w.start),
c AS (SELECT w.page, w.start, k, before // 4 AS p, pos // 4 AS q FROM w JOIN (SELECT DISTINCT page, start FROM w WHERE pos = start) f ON w.page = f.page AND w.start = f.start),
m AS (SELECT page, start, k, sqrt(((q % {1 << _B}) - (p % {1 << _B})) * ((q % {1 << _B}) - (p % {1 << _B})) + ((q // {1 << _B}) - (p // {1 << _B})) * ((q // {1 << _B}) - (p // {1 << _B}))) AS step FROM c WHERE p <> q),
b AS (SELECT page, start AS contour, CAST(count(*) AS INT) AS pixels, round(sum(step) - max_by(step, k), 6) AS length FROM m GROUP BY 1, 2 UNION ALL SELECT page, start, 1, CAST(0 AS DOUBLE) FROM c GROUP BY 1, 2 HAVING bool_and(p = q))"""


def _strokes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "strokes").withColumns({"width": F.lit(_W), "height": F.lit(_H)})


@query(f"{_CLOSED} SELECT page, x, y FROM shut")
def closed_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contours.closed(_strokes(spark, sf_dir), 32).select("page", "x", "y")


@query(f"{_BORDERS} SELECT page, contour, pixels, length FROM b")
def contour_borders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of 32 pixels cut every page into four."""
    found = contours.contours(_strokes(spark, sf_dir), 32, close=True, lines=False)
    return found.select("page", "contour", "pixels", F.round("length", 6).alias("length"))


# Rasters --------------------------------------------------------------------------------------------------------------

_SIZE = 300
_PIXELS = f"""segs AS (SELECT page, thick, x0, y0, x1, y1, greatest(abs(x1 - x0), abs(y1 - y0)) AS n FROM strips),
ks AS (SELECT *, unnest(range(0, n + 1)) AS k FROM segs),
st AS (SELECT page, thick, CASE WHEN n = 0 THEN x0 ELSE x0 + CAST(floor(CAST(2 * (x1 - x0) * k + n AS DOUBLE) / (2 * n)) AS BIGINT) END AS x, CASE WHEN n = 0 THEN y0 ELSE y0 + CAST(floor(CAST(2 * (y1 - y0) * k + n AS DOUBLE) / (2 * n)) AS BIGINT) END AS y FROM ks),
px AS (SELECT DISTINCT page, x + i AS x, y + j AS y FROM st, (VALUES (0), (1)) a(i), (VALUES (0), (1)) b(j) WHERE i < thick AND j < thick AND x + i BETWEEN 0 AND {_SIZE - 1} AND y + j BETWEEN 0 AND {_SIZE - 1})"""


def _strips(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "strips")
    point = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    return rows.select("page", F.array(point("x0", "y0"), point("x1", "y1")).alias("pixels"), F.lit(False).alias("closed"), F.col("thick").alias("thickness"))


@query(f"{with_views('strips')}, {_PIXELS} SELECT page, x, y FROM px")
def raster_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.pixel_rows(raster.draw(_strips(spark, sf_dir), _SIZE, "page"), "page")


@query(f"{with_views('strips')}, {_PIXELS} SELECT page, y, x // 64 AS word, CAST(bit_count(bit_or(CAST(1 AS UBIGINT) << CAST(x % 64 AS INT))) AS INT) AS pixels FROM px GROUP BY ALL")
def raster_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = raster.draw(_strips(spark, sf_dir), _SIZE, "page")
    return drawn.select("page", "y", "word", F.bit_count("bits").alias("pixels"))
