"""Crowded shapes: geometry travels by block, shares equal those of every distance, and the best matches decide alone."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from terraproof.operators import matching, near_lines
from terraproof.plans import queries


def test_shares_equal_all_distances(monkeypatch):
    monkeypatch.setattr(near_lines, "FEW", 0)
    rng = np.random.default_rng(3)
    made = lambda n: [[rng.normal(0, s, (k, 2)) + rng.uniform(-60, 60, 2)] for s, k in zip(rng.choice([0.0, 2.0, 15.0, 4000.0], n), rng.integers(1, 9, n), strict=True)]
    a, b = near_lines.Lines(made(30)), near_lines.Lines(made(25))
    wanted = rng.random((30, 25)) < 0.7
    for tolerance in (25.0, 3.0):
        got = near_lines.shares(a, b, wanted, tolerance)
        x, y, weight, at, whole = a.sampled(tolerance)
        for i in range(30):
            for j in range(25):
                line, cut = b.segments(j), slice(at[i], at[i + 1])
                there = wanted[i, j] and at[i + 1] > at[i] and len(line[0])
                want = min(1.0, (weight[cut] * (near_lines.distance(x[cut], y[cut], *line) <= tolerance)).sum() / whole[i]) if there else 0.0
                assert abs(got[i, j] - want) < 1e-12


def test_few_points_of_a_crowd_are_measured(monkeypatch):
    rng = np.random.default_rng(5)
    made = lambda n: near_lines.Lines([[rng.normal(0, 12.5, (32, 2)) + rng.uniform(0, 90, 2)] for _ in range(n)])
    a, b, measured = made(60), made(60), []
    squares = near_lines.squares
    monkeypatch.setattr(near_lines, "squares", lambda dx, dy, vx, vy: measured.append(dx.size) or squares(dx, dy, vx, vy))
    for tolerance in (25.0, 3.0):
        measured.clear()
        near_lines.shares(a, b, np.ones((60, 60), bool), tolerance)
        assert sum(measured) * 10 < len(a.sampled(tolerance)[0]) * len(b.start)  # cells and points, of all points against all segments


def test_geometry_travels_by_block(spark, small, monkeypatch):
    planning, reference = queries._sides(spark, small)
    want = {tuple(r) for r in matching.feature_matches(planning, reference).collect()}
    blocks = matching.block_pairs(matching.in_parts(planning), matching.in_parts(reference)).count()
    assert blocks * 20 < len(want)  # a row for each pair had both shapes' points
    monkeypatch.setattr(matching, "BLOCK_POINTS", 256)
    assert {tuple(r) for r in matching.feature_matches(planning, reference).collect()} == want


def test_best_matches_alone_decide(spark, small, monkeypatch):
    monkeypatch.setattr(matching, "BLOCK_POINTS", 256)
    planning, reference = queries._sides(spark, small)
    both = [matching.judge_features(planning, matching.feature_matches(planning, reference)), matching.match_and_judge(planning, reference)]
    one, two = (df.withColumn("reasons", F.array_join("reasons", ",")).toPandas().sort_values("id").reset_index(drop=True) for df in both)
    assert one.equals(two)


def test_rounded_ties_go_by_rank():
    score = np.array([0.5000004, 0.5, 0.4999996, 0.3, 0.4999994])
    assert matching._best(score, np.array([4, 3, 0, 1, 2]), 2).tolist() == [2, 1]


def test_contenders_hold_the_best():
    rng = np.random.default_rng(7)
    made = lambda n: near_lines.Lines([[rng.normal(0, rng.choice([2.0, 12.5, 60.0]), (9, 2)) + rng.uniform(0, 80, 2)] for _ in range(n)])
    p, r, line, rank = made(40), made(50), rng.random((40, 50)) < 0.9, rng.permutation(50)
    named = line & (rng.random((40, 50)) < 0.02)
    one, two, chosen = matching._line_contenders(p, r, line, named, rank, 2)
    ones, twos = near_lines.shares(p, r, line, 25.0), near_lines.shares(r, p, line.T, 25.0).T
    assert np.allclose(one[chosen], ones[chosen], atol=1e-12) and np.allclose(two[chosen], twos[chosen], atol=1e-12)
    assert chosen.sum() * 4 < line.sum()
    score = np.round(np.maximum(np.minimum(ones, twos), np.where(named, 0.45, 0)), 6)
    for a in range(40):
        match = np.flatnonzero(line[a] & (named[a] | (np.maximum(ones[a], twos[a]) >= 0.18)))
        assert chosen[a, match[np.lexsort((rank[match], -score[a, match]))[:2]]].all()


def test_later_blocks_meet_only_what_lacks_whole_matches(spark, monkeypatch):
    monkeypatch.setattr(matching, "BLOCK_POINTS", 256)
    far = lambda k, dx: [(dx, 0.0), (dx + 10.0 + k % 3, 5.0)]
    made = lambda rows: spark.createDataFrame([(i, "path", None, "LineString", [{"x": x, "y": y} for x, y in line]) for i, line in rows], "id int, kind string, name string, form string, points array<struct<x:double,y:double>>")
    planning = made([(k, far(k, 0.0)) for k in range(5)] + [(9, far(0, 160.0))])
    reference = made([(k, far(k, 0.0)) for k in range(100, 160)] + [(200, far(0, 165.0))])
    got = sorted((r["planning_id"], r["reference_id"], r["score"]) for r in matching.best_matches(planning, reference).collect())
    assert got[:10] == [(k, i, 1.0) for k in range(5) for i in (100, 101)] and got[10:] == [(9, 200, 1.0)]
