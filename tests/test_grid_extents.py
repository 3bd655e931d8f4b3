"""Grid references against published places, page extents against a plain clip."""

from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from terraproof.functions.geo import haversine_m
from terraproof.functions.grid import steps, with_place
from terraproof.operators import georef
from terraproof.operators.registration import printed_controls

# published control points of the national transformation: easting, northing, latitude, longitude
PUBLISHED = [
    (91492.146, 11318.804, 49.92226393730, -6.29977752014), (170370.718, 11572.405, 49.96006137820, -5.20304609998), (250359.811, 62016.569, 50.43885825610, -4.10864563561),
    (449816.371, 75335.861, 50.57563665000, -1.29782277240), (438710.920, 114792.250, 50.93127937910, -1.45051433700), (292184.870, 168003.465, 51.40078220140, -3.55128349240),
    (639821.835, 169565.858, 51.37447025550, 1.44454730409), (530624.974, 178388.464, 51.48936564950, -0.11992557180), (389544.190, 261912.153, 52.25529381630, -2.15458614387),
    (454002.834, 340834.943, 52.96219109410, -1.19747655922), (357455.843, 383290.436, 53.34480280190, -2.64049320810),
]


def test_places_of_published_points(spark):
    df = spark.createDataFrame(PUBLISHED, "e double, n double, want_lat double, want_lon double")
    got = with_place(df, F.col("e"), F.col("n")).select(haversine_m(F.col("lon"), F.col("lat"), F.col("want_lon"), F.col("want_lat")).alias("apart")).collect()
    assert max(r["apart"] for r in got) < 5


def test_the_series_on_its_own_ellipsoid(spark):
    """The worked example of the published guide: before the shift of datum."""
    df = spark.createDataFrame([(651409.903, 313177.270)], "_e double, _n double")
    for name, sql in steps():
        df = df.withColumn(name, F.expr(sql))
    r = df.first()
    assert abs(math.degrees(r["_phi"]) - (52 + 39 / 60 + 27.2531 / 3600)) < 2e-8 and abs(math.degrees(r["_lambda"]) - (1 + 43 / 60 + 4.5177 / 3600)) < 2e-8


def test_places_of_odd_rows(spark):
    df = spark.createDataFrame([(None, 1.0, 7), (400000.0, None, 8), (400000.0, 300000.0, 9)], "e double, n double, lat int")
    out = with_place(df, F.col("e"), F.col("n"))
    rows = {r["e"] is not None and r["n"] is not None: r for r in out.collect()}
    assert out.columns == ["e", "n", "lon", "lat"] and rows[True]["lon"] is not None and abs(rows[True]["lon"] + 2) < 0.01
    # a filter on the place is not written out for every step
    plan = out.filter("lat > 52 AND lon < 0")._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 40_000 and out.filter("lat > 52 AND lon < 0").count() == 1
    assert with_place(df.limit(0), F.col("e"), F.col("n")).count() == 0


def test_printed_grid_references(spark):
    box = (52.97, -1.90, 53.00, -1.85)
    lines = [(1, 10.0, 10.0, "E 407000 N 343000"), (1, 90.0, 10.0, "Easting: 408000, Northing: 343000"), (1, 10.0, 90.0, "-1.889 52.980"), (1, 5.0, 5.0, "sheet 1 of 3"), (2, 1.0, 1.0, "E 407000 N 343000"), (2, 2.0, 2.0, None)]
    got = printed_controls(spark.createDataFrame(lines, "page int, x double, y double, text string"), "page", box).collect()
    assert sorted((r["page"], r["x"], r["y"]) for r in got) == [(1, 10.0, 10.0), (1, 10.0, 90.0), (1, 90.0, 10.0)]
    first = next(r for r in got if (r["x"], r["y"]) == (10.0, 10.0))
    assert abs(first["lat"] - 52.984) < 0.003 and abs(first["lon"] + 1.897) < 0.003


def plain_clip(points, box):
    south, west, north, east = box
    for a, b, c in ((1, 0, west), (-1, 0, -east), (0, 1, south), (0, -1, -north)):
        out = []
        for k, p in enumerate(points):
            q = points[k - 1]
            dp, dq = a * p[0] + b * p[1] - c, a * q[0] + b * q[1] - c
            if (dp >= 0) != (dq >= 0):
                t = dq / (dq - dp)
                out.append((q[0] + (p[0] - q[0]) * t, q[1] + (p[1] - q[1]) * t))
            if dp >= 0:
                out.append(p)
        points = out
    return points


def area(points):
    return abs(sum(points[k - 1][0] * p[1] - p[0] * points[k - 1][1] for k, p in enumerate(points))) / 2


def test_overlap_of_turned_and_sheared_extents(spark):
    rng, box = random.Random(4), (-1.0, -2.0, 1.5, 2.0)
    rows, want = [], {}
    for i in range(300):
        ox, oy, ax, ay, bx, by = (rng.uniform(-3, 3) for _ in range(6))
        quad = [(ox, oy), (ox + ax, oy + ay), (ox + ax + bx, oy + ay + by), (ox + bx, oy + by)]
        rows.append((i, [{"lon": x, "lat": y} for x, y in quad]))
        want[i] = area(plain_clip(quad, box)) / area(quad)
    rows += [(900, None), (901, [{"lon": 0.0, "lat": 0.0}] * 4), (902, [{"lon": None, "lat": 0.0}] * 4), (903, [])]
    df = spark.createDataFrame(rows, "id int, c array<struct<lon:double,lat:double>>")
    out = df.select("id", georef.geofence_overlap(F.col("c"), box).alias("o"))
    got = {r["id"]: r["o"] for r in out.collect()}
    assert all(abs(got[i] - w) < 1e-9 for i, w in want.items()) and {got[i] for i in (900, 901, 902, 903)} == {None}
    assert 0.0 in got.values() and 1.0 in [round(v, 9) for v in got.values() if v is not None] and "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_page_extents(spark):
    pages = spark.createDataFrame([(1, 100, 50), (2, 100, 50), (3, 100, None), (4, 0, 50), (5, 10, 10)], "page int, width int, height int")
    points = [(p, x, y, 0.01 * x, -0.01 * y) for p in (1, 3, 4) for x, y in ((0.0, 0.0), (100.0, 0.0), (0.0, 50.0), (100.0, 50.0))] + [(2, 0.0, 0.0, 1.0, 1.0), (2, 1.0, 1.0, 2.0, 2.0), (2, 2.0, 2.0, 3.0, 3.0)]
    got = georef.page_extents(pages, spark.createDataFrame(points, "page int, x double, y double, lon double, lat double"), (-0.25, 0.25, 1.0, 5.0))
    assert got.columns == ["page", "width", "height", "overlap"]
    found = {r["page"]: r["overlap"] for r in got.collect()}
    assert abs(found[1] - 0.75 * 0.5) < 1e-9 and {found[p] for p in (2, 3, 4, 5)} == {None}
