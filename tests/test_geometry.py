from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from terraproof.functions import geo
from terraproof.operators import georef, matching

SHAPE = "id string, kind string, name string, form string, points array<struct<x:double,y:double>>"
PLAN = SHAPE + ", confidence double, status string, eligible boolean"


def line(*xy):
    return [{"x": float(x), "y": float(y)} for x, y in xy]


def judge(spark, plan, refs, **kw):
    p = spark.createDataFrame([plan], PLAN)
    return matching.judge_features(p, matching.feature_matches(p, spark.createDataFrame(refs, SHAPE)), **kw).first()


A = line((0, 0), (100, 0))


def test_feature_authority(spark):
    plan = ("p", "path", None, "LineString", A, 0.9, None, None)
    ref = lambda i, dy, kind="path", form="LineString": (i, kind, None, form, line((0, dy), (100, dy)))
    got = judge(spark, plan, [ref("osm:way:10", 0)])
    assert (got["action"], got["target"]) == ("planning-authority-corroborated", "osm:way:10")
    assert judge(spark, plan, [ref("a", 11)])["action"] == "planning-authority-replaces-reference"
    assert judge(spark, plan, [ref("a", 39)])["action"] == "planning-authority-gap-fill"
    two = judge(spark, plan, [ref("b", 0), ref("a", 0)])
    assert (two["action"], two["target"], two["alternate"]) == ("ambiguous-reference-withheld", "a", "b")
    assert judge(spark, plan, [ref("a", 0, "wall")])["action"] == "planning-authority-gap-fill"
    assert judge(spark, plan, [ref("a", 0, "wall")], gap_fill=False)["reasons"] == ["compatible-reference-target-required"]
    assert judge(spark, plan, [ref("a", 0, form="Polygon")])["action"] == "planning-authority-gap-fill"
    assert judge(spark, (*plan[:5], 0.859, None, None), [ref("a", 0)])["reasons"] == ["confidence-below-authority-gate"]
    assert judge(spark, (*plan[:5], 0.9, "withdrawn", False), [ref("a", 0)])["action"] == "withheld"
    assert judge(spark, (*plan[:5], 0.9, "withdrawn", True), [ref("a", 0)])["accepted"]
    assert judge(spark, (*plan[:5], 0.9, "approved", False), [ref("a", 0)])["accepted"]


def test_areas_and_points(spark):
    square = lambda d: line((d, 0), (d + 40, 0), (d + 40, 40), (d, 40), (d, 0))
    plan = ("p", "building", "Big Hall", "Polygon", square(0), 0.9, None, None)
    assert judge(spark, plan, [("r", "building", None, "Polygon", square(1))])["action"] == "planning-authority-corroborated"
    assert judge(spark, plan, [("r", "building", None, "Polygon", square(20))])["action"] == "planning-authority-replaces-reference"
    point = ("p", "rock", "Big Rock", "Point", line((0, 0)), 0.9, None, None)
    assert judge(spark, point, [("r", "rock", "big-rock", "Point", line((20, 0)))])["target"] == "r"
    assert judge(spark, point, [("r", "rock", None, "Point", line((20, 0)))])["target"] is None


def test_pairs_against_all_pairs(spark):
    import random

    rng = random.Random(3)
    shapes = [(str(i), "path", None, "LineString", line(*((rng.uniform(0, 900), rng.uniform(0, 900)) for _ in range(2)))) for i in range(60)]
    p, r = spark.createDataFrame(shapes[:30], SHAPE), spark.createDataFrame(shapes[30:], SHAPE)
    got = [(x["p_id"], x["r_id"]) for x in matching.candidate_pairs(p, r).select("p_id", "r_id").collect()]

    def box(s, w):
        xs, ys = [q["x"] for q in s[4]], [q["y"] for q in s[4]]
        return min(xs) - w, min(ys) - w, max(xs) + w, max(ys) + w

    want = {(a[0], b[0]) for a in shapes[:30] for b in shapes[30:] for u, v in [(box(a, 0), box(b, 25))] if u[0] <= v[2] and v[0] <= u[2] and u[1] <= v[3] and v[1] <= u[3]}
    assert len(got) == len(set(got)) and set(got) == want


def test_reference_features(spark):
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    as_geo = lambda pts: [{"lon": a, "lat": b} for a, b in pts]
    rows = [("way", 1, {"building": "yes", "name": "n"}, as_geo(ring), None, None), ("way", 2, {"highway": "footway"}, as_geo(ring), None, None), ("node", 3, {"natural": "rock"}, None, 1.0, 2.0), ("way", 4, {"building": ""}, as_geo(ring), None, None), ("node", 5, {"barrier": "bollard"}, None, None, None)]
    df = spark.createDataFrame(rows, "type string, id long, tags map<string,string>, geometry array<struct<lon:double,lat:double>>, lon double, lat double")
    assert {r["id"]: (r["kind"], r["form"]) for r in matching.normalize_reference(df).collect()} == {"osm:way:1": ("building", "Polygon"), "osm:way:2": ("path", "LineString"), "osm:node:3": ("rock", "Point")}


def test_overlap(spark):
    box = lambda w, s, e, n: [{"lon": float(a), "lat": float(b)} for a, b in ((w, s), (e, s), (e, n), (w, n))]
    df = spark.createDataFrame([(box(-9, 0, 1, 1),), (box(0, 0, 1, 1),), (box(5, 5, 6, 6),), (None,), (box(0, 0, 0, 0),)], "c array<struct<lon:double,lat:double>>")
    got = [r[0] for r in df.select(georef.geofence_overlap(F.col("c"), (0.0, 0.0, 1.0, 1.0))).collect()]
    assert got[0] == pytest.approx(0.1, abs=1e-9) and got[1:] == [1.0, 0.0, None, None]


def test_controls(spark):
    p = lambda x, y, lon=-1.89, lat=52.98: {"x": x, "y": y, "lon": lon, "lat": lat}
    bbox = (52.975, -1.905, 52.995, -1.875)
    cases = {None: [p(0.0, 0.0), p(1.0, 0.0), p(0.0, 1.0)], "insufficient-control-points": [p(0.0, 0.0), p(1.0, 0.0), p(None, 1.0)], "duplicate-control-pixels": [p(0.0, 0.0), p(0.001, 0.0), p(1.0, 1.0)], "control-points-outside-park-geofence": [p(0.0, 0.0), p(1.0, 0.0), p(0.0, 1.0, 3.0)]}
    df = spark.createDataFrame([(v,) for v in cases.values()], "c array<struct<x:double,y:double,lon:double,lat:double>>")
    assert [r[0]["reason"] for r in df.select(geo.check_controls(F.col("c"), bbox)).collect()] == list(cases)


def test_affine(spark):
    rows = [(1, x, y, 2 * x - y + 5, 0.5 * y + 1) for x, y in ((0.0, 0.0), (10.0, 0.0), (0.0, 10.0), (7.0, 3.0))] + [(2, x, x, x, x) for x in (0.0, 1.0, 2.0)]
    got = {r["k"]: r for r in georef.affine_fit(spark.createDataFrame(rows, "k int, x double, y double, lon double, lat double"), "k").collect()}
    assert [round(got[1][c], 9) for c in ("lon_x", "lon_y", "lon_0", "lat_x", "lat_y", "lat_0")] == [2, -1, 5, 0, 0.5, 1]
    assert got[2]["lon_x"] is None


def test_variants_and_consensus(spark):
    schema = "application long, document string, rank int, ordinal long, lon double, lat double, confidence double, f1 double"
    many = [(1, "a", i, i, -1.88 + i * 0.001, 52.98, 0.9, 0.8) for i in range(20)]
    kept = georef.variants(spark.createDataFrame(many, schema)).collect()
    assert len(kept) == 12 and min(r["rank"] for r in kept) == 0
    close = [(1, "a", 0, 0, -1.88, 52.98, 0.9, 0.8), (1, "a", 1, 1, -1.88001, 52.98, 0.9, 0.8), (1, "a", 2, 2, -1.87, 52.98, 0.71, 0.8)]
    assert [r["rank"] for r in georef.variants(spark.createDataFrame(close, schema)).collect()] == [0]
    pair = [(1, "a", 0, 0, -1.90, 52.98, 0.9, 0.8), (1, "a", 1, 1, -1.8800, 52.98, 0.8, 0.7), (1, "b", 0, 2, -1.92, 52.98, 0.9, 0.8), (1, "b", 1, 3, -1.8802, 52.98, 0.8, 0.7)]
    evidence, members = georef.consensus(georef.variants(spark.createDataFrame(pair, schema)))
    assert evidence.first()["accepted"] and {(r["document"], r["rank"]) for r in members.collect()} == {("a", 1), ("b", 1)}


def test_consensus_at_the_edge_of_the_reach(spark):
    """Pairs just within the reach, wherever they lie on the grid, north to south, east to west and across 180 degrees."""
    import math

    schema = "application long, document string, rank int, ordinal long, lon double, lat double, confidence double, f1 double"
    degree, rows, app = 6371008.8 * math.pi / 180, [], 0
    for k in range(60):
        lat, lon = (52.98, -70.0, 89.999)[k % 3] + k * 0.00002, (10.0, 179.9995, -180.0)[k // 3 % 3]
        for dlat, dlon in ((139.9 / degree, 0.0), (0.0, 139.9 / degree / max(math.cos(math.radians(lat)), 0.01))):
            app += 1
            other = (lon + dlon + 180) % 360 - 180
            rows += [(app, "a", 0, 0, lon, lat, 0.9, 0.8), (app, "b", 0, 1, other, min(lat + dlat, 90.0), 0.9, 0.8)]
    # a pair that spans three bands where a band is a hair narrower than the reach
    app, low = app + 1, (math.floor(52.98 * 111320 / 140) + 1) * 140 / 111320 - 0.02 / degree
    rows += [(app, "a", 0, 0, 10.0, low, 0.9, 0.8), (app, "b", 0, 1, 10.0, low + 139.9 / degree, 0.9, 0.8)]
    evidence, _ = georef.consensus(spark.createDataFrame(rows, schema))
    assert {r["application"] for r in evidence.collect() if r["documents"] == 2} == set(range(1, app + 1))


def test_consensus_queries_keep_every_usable_candidate(spark, small, monkeypatch):
    from terraproof.plans import queries

    schema = "application long, document string, rank int, ordinal long, lon double, lat double, confidence double, f1 double"
    # the agreement with the other document is the 1,100th of the first
    rows = [(1, "a", i, i, -1.88 + i * 0.01, 52.98, 0.9, 0.8) for i in range(1100)] + [(1, "b", 0, 5000, -1.88 + 1099 * 0.01, 52.98, 0.9, 0.8), (1, "b", 1, 5001, 0.0, 0.0, 0.7, 0.8)]
    df = spark.createDataFrame(rows, schema)
    monkeypatch.setattr(queries, "view", lambda *_: df)
    r = queries.consensus_evidence(spark, small).first()
    assert (r["candidates"], r["variants"], r["documents"], r["accepted"]) == (2, 1101, 2, True)
    assert {(m["document"], m["ordinal"]) for m in queries.consensus_members(spark, small).collect()} == {("a", 1099), ("b", 5000)}


def test_controls_as_rows(spark):
    p = lambda x, y, lon=-1.89, lat=52.98: (x, y, lon, lat)
    bbox = (52.975, -1.905, 52.995, -1.875)
    cases = [[p(0.0, 0.0), p(1.0, 0.0), p(0.0, 1.0)], [p(0.0, 0.0), p(1.0, 0.0), p(None, 1.0)], [p(0.0, 0.0), p(0.001, 0.0), p(1.0, 1.0)], [p(0.0, 0.0), p(1.0, 0.0), p(0.0, 1.0, 3.0)], [p(0.0, None)] * 3, [p(0.0, 0.0)] * 9]
    df = spark.createDataFrame([(k, *q) for k, c in enumerate(cases) for q in c], "k int, x double, y double, lon double, lat double")
    want = {r["k"]: (r["c"]["accepted"], r["c"]["reason"]) for r in df.groupBy("k").agg(F.collect_list(F.struct("x", "y", "lon", "lat")).alias("c")).select("k", geo.check_controls(F.col("c"), bbox).alias("c")).collect()}
    assert {r["k"]: (r["accepted"], r["reason"]) for r in geo.checked_controls(df, "k", bbox).collect()} == want and len(want) == 6
