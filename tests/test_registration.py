from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraproof.functions import geo
from terraproof.operators import matching, registration

BBOX = (52.975, -1.905, 52.995, -1.875)
SHAPE = "id string, kind string, name string, form string, points array<struct<x:double,y:double,part:int,ring:int>>"


def ring(at, n, part=0, k=0):
    return [(float(x), float(y), part, k) for x, y in ((at, at), (at + n, at), (at + n, at + n), (at, at + n))]


def match(spark, a, b, form_a, form_b):
    p, r = (spark.createDataFrame([(i, "building" if "Poly" in f else "path", None, f, pts)], SHAPE) for i, f, pts in (("p", form_a, a), ("r", form_b, b)))
    return matching.feature_matches(p, r).first()


def test_holes_and_parts(spark):
    solid, holed = ring(0, 40), ring(0, 40) + ring(5, 30, 0, 1)
    assert match(spark, solid, solid, "Polygon", "MultiPolygon")["equivalent"]
    got = match(spark, solid, holed, "Polygon", "Polygon")
    assert got["planning_share"] == pytest.approx(700 / 1600, abs=0.02) and got["reference_share"] == pytest.approx(1, abs=0.04)
    two = ring(0, 20) + ring(100, 20, 1)
    assert match(spark, two, ring(100, 20), "MultiPolygon", "Polygon")["planning_share"] == pytest.approx(0.5, abs=0.02)
    assert match(spark, ring(5, 30), holed, "Polygon", "Polygon") is None  # wholly inside the hole
    assert match(spark, solid, [(0.0, 0.0, 0, 0), (40.0, 0.0, 0, 0)], "Polygon", "LineString") is None


def test_lines_of_several_parts_are_not_joined(spark):
    lines = [(0.0, 0.0, 0, 0), (100.0, 0.0, 0, 0), (0.0, 500.0, 1, 0), (100.0, 500.0, 1, 0)]
    got = match(spark, lines, [(0.0, 500.0, 0, 0), (100.0, 500.0, 0, 0)], "MultiLineString", "LineString")
    assert (got["planning_share"], got["reference_share"]) == (0.5, 1.0)


def test_mapped_elements_in_metres(spark):
    f = spark.createDataFrame([("a", [(-1.89, 52.985), (-1.89, 52.986)])], "id string, points array<struct<lon:double,lat:double>>")
    first, second = matching.projected(f, BBOX).first()["points"]
    assert abs(first["x"]) < 1e-6 and abs(first["y"]) < 1e-6 and second["y"] == pytest.approx(111.195, abs=0.01)


def test_area_columns(spark):
    parts = F.array(F.array(*(F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y, *_ in r)) for r in (ring(0, 10), ring(2, 4)))))
    row = spark.range(1).select(geo.net_area(parts).alias("a"), geo.point_in_parts(F.lit(1.0), F.lit(1.0), parts).alias("i"), geo.point_in_parts(F.lit(3.0), F.lit(3.0), parts).alias("h")).first()
    assert tuple(row) == (84.0, True, False)


def test_edges_against_a_distance_table(spark):
    rng = np.random.default_rng(1)
    p, r = ({tuple(map(int, v)) for v in rng.integers(0, 60, (n, 2))} for n in (120, 70))
    steps = lambda a, b: min(abs(a[0] - b[0]), abs(a[1] - b[1])) * 1.3693 + abs(abs(a[0] - b[0]) - abs(a[1] - b[1])) * 0.955
    share = lambda one, other: sum(any(steps(a, b) <= 4 for b in other) for a in one) / len(one)
    rows = lambda s: spark.createDataFrame([("c", *v) for v in s] + [("c", *next(iter(s))), ("c", None, 1), (None, 1, 1), ("few", 1, 1)], "candidate string, x int, y int")
    got = {x["candidate"]: x for x in registration.edge_scores(rows(p), rows(r)).collect()}
    assert (got["c"]["precision"], got["c"]["recall"]) == (share(p, r), share(r, p)) and got["few"]["f1"] is None and set(got) == {"c", "few"}


def test_alternatives_and_costs(spark):
    m = {"a": 0.3, "b": 0.0, "c": 0.0, "d": 0.0, "e": 0.3, "f": 0.0}
    off = {**m, "c": 5000.0}
    rows = [("p", i, s, 0.8, 0.7, 0.9, x, 0.0, t, 0.0, 0.0, 1000.0, 800.0, o) for i, s, x, t, o in ((0, 0.9, 0.0, m, None), (1, 0.8, 34.0, m, None), (2, 0.7, 35.0, m, 400.0), (3, 0.95, 300.0, off, None), (4, 0.6, 200.0, m, 0.0))]
    schema = "page string, ordinal int, score double, f1 double, precision double, recall double, anchor_x double, anchor_y double, matrix struct<a:double,b:double,c:double,d:double,e:double,f:double>, crop_x double, crop_y double, width double, height double, offset_m double"
    got = registration.alternatives(spark.createDataFrame(rows, schema), "page", BBOX, (400, 400)).orderBy("rank").collect()
    assert [(g["ordinal"], g["rank"], round(g["confidence"], 9)) for g in got] == [(0, 1, 0.8), (2, 2, 0.83), (4, 3, 0.8)]
    assert len(got[0]["points"]) == 8 and BBOX[1] < got[0]["center"]["lon"] < BBOX[3]
    costs = spark.createDataFrame([("k", float(40 * i), 0.0, float(i)) for i in range(10)] + [("k", 1.0, 0.0, 0.5), ("k", 2.0, 0.0, None), ("k", 2.0, 0.0, float("nan"))], "k string, x double, y double, cost double")
    assert [r["cost"] for r in registration.lowest_costs(costs, "k").orderBy("cost").collect()] == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0]


def test_drawn_lines(spark):
    g = lambda *p: [{"lon": a, "lat": b} for a, b in p]
    rows = [("way", 1, {"building": ""}, g((-1.905, 52.995), (-1.875, 52.975)), None), ("relation", 2, {"natural": "water"}, None, [{"geometry": g((-1.9, 52.98), (-1.89, 52.98), (None, 1.0))}, {"geometry": None}]), ("way", 3, {"name": "x"}, g((-1.9, 52.98), (-1.89, 52.98)), None), ("way", 4, {"highway": "path"}, g((-1.9, 52.98), (9.0, 52.98)), None)]
    df = spark.createDataFrame(rows, "type string, id int, tags map<string,string>, geometry array<struct<lon:double,lat:double>>, members array<struct<geometry:array<struct<lon:double,lat:double>>>>")
    got = {r["id"]: r for r in registration.drawn_lines(df, BBOX, 1600).collect()}
    assert set(got) == {1, 2} and [tuple(p) for p in got[1]["pixels"]] == [(0, 0), (1599, 1599)]
    assert (got[1]["closed"], got[1]["thickness"], got[2]["closed"], got[2]["thickness"], len(got[2]["pixels"])) == (True, 2, True, 1, 2)


def test_printed_controls(spark):
    rows = [("a", t, float(i), float(i * i)) for i, t in enumerate(("-1.8851, 52.9876", "-1.8900 52.9800", "-1.8800 52.9850", "no pair"))] + [("b", "-1.8851, 52.9876", 1.0, 1.0)]
    got = registration.printed_controls(spark.createDataFrame(rows, "page string, text string, x double, y double"), "page", BBOX).collect()
    assert sorted((r["page"], r["lon"], r["lat"]) for r in got) == [("a", -1.89, 52.98), ("a", -1.8851, 52.9876), ("a", -1.88, 52.985)]
    # two numbers that can be longitude and latitude are read in that order, so this page lies far off
    swapped = spark.createDataFrame([("d", "52.9800 -1.8900", float(i), float(i * i)) for i in range(4)], "page string, text string, x double, y double")
    assert registration.printed_controls(swapped, "page", BBOX).count() == 0
    grid = spark.createDataFrame([("c", "403000 344000", float(i), float(i)) for i in range(4)], "page string, text string, x double, y double")
    assert registration.printed_controls(grid, "page", BBOX).count() == 0
