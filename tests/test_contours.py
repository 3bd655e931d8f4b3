"""Shapes from edge pixels: closing, borders, lines, against plain versions; cuts into tiles show nowhere."""

from __future__ import annotations

import math
import random

import numpy as np

from terraproof.operators import contours as C

SIZE = (90, 70)


def drawing(seed: int) -> set[tuple[int, int]]:
    """A frame, a filled box with a hole, strokes that cross, lone pixels and some noise."""
    rng = random.Random(seed)
    px = {(x, y) for x in range(5, 60) for y in (4, 40)} | {(x, y) for x in (5, 59) for y in range(4, 41)}
    px |= {(x, y) for x in range(66, 86) for y in range(10, 30) if not (72 <= x < 78 and 16 <= y < 22)}
    px |= {(10 + k, 45 + k // 2) for k in range(40)} | {(50 - k, 45 + k // 2) for k in range(40)} | {(0, 0), (89, 69), (0, 69), (1, 68)}
    return px | {(rng.randrange(SIZE[0]), rng.randrange(SIZE[1])) for _ in range(200)}


def plain_closed(px: set) -> set:
    near = [(dx, dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]
    inside = lambda p: 0 <= p[0] < SIZE[0] and 0 <= p[1] < SIZE[1]
    wide = {q for x, y in px for dx, dy in near if inside(q := (x + dx, y + dy))}
    return {(x, y) for x, y in wide if all((x + dx, y + dy) in wide or not inside((x + dx, y + dy)) for dx, dy in near)}


def plain_borders(px: set) -> dict[int, list[tuple[int, int]]]:
    """Walks along the sides one at a time: left over a corner, straight on, or round the pixel."""
    todo = {(y, x, d) for x, y in px for d, (ox, oy) in enumerate(C.OUTWARD) if (x + ox, y + oy) not in px}
    out = {}
    while todo:
        first = at = min(todo)
        places = []
        while True:
            todo.discard(at)
            y, x, d = at
            places.append((x, y))
            (ax, ay), (ox, oy) = C.ALONG[d], C.OUTWARD[d]
            if (x + ax + ox, y + ay + oy) in px:
                at = (y + ay + oy, x + ax + ox, (d + 3) % 4)
            elif (x + ax, y + ay) in px:
                at = (y + ay, x + ax, d)
            else:
                at = (y, x, (d + 1) % 4)
            if at == first:
                break
        line = [p for k, p in enumerate(places) if k == 0 or p != places[k - 1]]
        if len(line) > 1 and line[0] == line[-1]:
            line.pop()
        out[((first[0] << C.COLUMN_BITS) + first[1]) * 4 + first[2]] = line
    return out


def plain_line(points: list, stray: float) -> list:
    """Recursive: the farthest point from the chord splits it."""
    if len(points) < 3:
        return points
    (x0, y0), (x1, y1) = points[0], points[-1]
    size = math.hypot(x1 - x0, y1 - y0)
    apart = [abs((y1 - y0) * (x - x0) - (x1 - x0) * (y - y0)) / size if size else math.hypot(x - x0, y - y0) for x, y in points[1:-1]]
    far = max(range(len(apart)), key=lambda k: apart[k])
    return plain_line(points[: far + 2], stray)[:-1] + plain_line(points[far + 1 :], stray) if apart[far] > stray else [points[0], points[-1]]


def as_rows(spark, pages: dict):
    rows = [(p, x, y, *SIZE) for p, px in pages.items() for x, y in sorted(px)]
    return spark.createDataFrame(rows + rows[:7] + [("a", None, 1, *SIZE), ("a", 500, 1, *SIZE), ("a", -1, 1, *SIZE), (None, 1, 1, *SIZE)], "page string, x int, y int, width int, height int")


def test_lines_equal_a_plain_version_however_they_are_cut(spark):
    pages = {"a": drawing(1), "b": drawing(2), "dot": {(3, 3)}}
    for tile in (8, 13, 256):
        got = C.contours(as_rows(spark, pages), tile).collect()
        assert len(got) == len({(r["page"], r["contour"]) for r in got})
        for page, px in pages.items():
            want, mine = plain_borders(px), {r["contour"]: r for r in got if r["page"] == page}
            assert mine.keys() == want.keys()
            for name, line in want.items():
                r = mine[name]
                length = sum(math.dist(p, q) for p, q in zip(line, line[1:], strict=False))
                assert r["pixels"] == len(line) and [(p["x"], p["y"]) for p in r["points"]] == line and abs(r["length"] - length) < 1e-9
                assert [(p["x"], p["y"]) for p in r["line"]] == plain_line(line, max(1.5, 0.008 * length))


def test_closing_equals_a_plain_version_however_it_is_cut(spark):
    pages = {"a": drawing(1), "b": drawing(2)}
    for tile in (8, 256):
        got = C.closed(as_rows(spark, pages), tile).collect()
        assert len(got) == len(set(got)) and {(r["page"], r["x"], r["y"]) for r in got} == {(p, x, y) for p, px in pages.items() for x, y in plain_closed(px)}


def test_a_border_that_winds_through_many_tiles(spark):
    spiral, x, y, step = set(), 0, 0, 88
    for dx, dy in [(1, 0), (0, 1), (-1, 0), (0, -1)] * 6:
        for _ in range(min(step, 68) if dy else step):
            spiral.add((x, y))
            x, y = x + dx, y + dy
        step -= 4
    spiral = {(x, y) for x, y in spiral if 0 <= x < SIZE[0] and 0 <= y < SIZE[1]}
    (want,) = [v for v in [plain_borders(spiral)]]
    got = {r["contour"]: r["pixels"] for r in C.contours(as_rows(spark, {"s": spiral}), 8).collect() if r["page"] == "s"}
    assert got == {k: len(v) for k, v in want.items()}


def test_simplified():
    line = np.array([[0, 0], [1, 0.4], [2, 0], [3, 3], [4, 0]], float)
    assert C.simplified(line, 0.5).tolist() == [[0, 0], [2, 0], [3, 3], [4, 0]] and C.simplified(line, 9).tolist() == [[0, 0], [4, 0]]
    assert C.simplified(line[:1], 1).tolist() == [[0, 0]]
    loop = np.array([[0, 0], [5, 0], [0, 0]], float)
    assert C.simplified(loop, 1).tolist() == loop.tolist()


def test_vectorize(spark):
    frame = {(x, y) for x in range(20, 80) for y in (20, 60)} | {(x, y) for x in (20, 79) for y in range(20, 61)} - {(50, 20)}  # a gap that closes
    pixels = as_rows(spark, {"a": frame | {(5, 5)}, "b": frame, "c": frame})
    anchors = spark.createDataFrame([("a", 1, 50.0, 40.0, 0.9, "building", "Station"), ("a", 2, 50.0, 39.0, 0.1, None, "x"), ("b", 1, 900.0, 900.0, 0.5, "path", "far")], "page string, id int, x double, y double, confidence double, role string, label string")
    candidates = spark.createDataFrame([(p, {"a": 1.0, "b": 0.0, "c": 10.0, "d": 0.0, "e": 1.0, "f": 5.0}, 0.0, 0.0, 0.8) for p in "abc"], "page string, matrix struct<a:double,b:double,c:double,d:double,e:double,f:double>, crop_x double, crop_y double, confidence double")
    box = (52.0, -2.0, 53.0, -1.0)
    got = C.vectorize(pixels, anchors, candidates, box, (101, 101), tile=16).collect()
    assert {(r["page"], r["role"], r["label"], r["confidence"]) for r in got} == {("a", "building", "Station", 0.9)} and len(got) == 2  # outer and inner border
    for r in got:
        xs, ys = [round((p["lon"] + 2) * 100, 6) for p in r["points"]], [round((53 - p["lat"]) * 100, 6) for p in r["points"]]
        assert min(xs) in (30, 31) and max(xs) in (88, 89) and min(ys) in (25, 26) and max(ys) in (64, 65) and 4 <= len(xs) <= 8
    assert C.contours(as_rows(spark, {"a": {(1, 1)}}).limit(0)).count() == 0


def test_measures_of_closed_shapes_need_no_sides(spark, monkeypatch):
    monkeypatch.setattr(C, "STACK", 1)  # a tile at a time
    monkeypatch.setattr(C, "BLOCK", 2)  # several rounds of blocks
    pages = {"a": drawing(3), "dot": {(3, 3)}, "rest": {(x, y) for x in range(90) for y in range(70) if x % 9 and y % 11}}
    want = {}
    for page, px in pages.items():
        for name, line in plain_borders(plain_closed(px)).items():
            want[page, name] = (len(line), round(sum(math.dist(p, q) for p, q in zip(line, line[1:], strict=False)), 9))
    for tile in (8, 13, 65, 256):
        assert "sides" not in C.chains(as_rows(spark, pages), tile, close=True, sides=False).columns
        got = C.contours(as_rows(spark, pages), tile, close=True, lines=False).collect()
        assert len(got) == len(want) and {(r["page"], r["contour"]): (r["pixels"], round(r["length"], 9)) for r in got} == want


def test_contours_leave_a_task_many_to_a_batch():
    import pyarrow as pa

    n = 500
    rows = pa.RecordBatch.from_pydict({"page": ["a"] * n, "border": list(range(0, 4 * n, 4)), "start": list(range(0, 4 * n, 4)), "after": pa.array([None] * n, pa.int64()), "sides": [[k * 4 + d for d in range(4)] for k in range(n)]})
    got = list(C._assembled(iter([rows]), ["page", "contour", "pixels", "length", "points", "line"]))
    assert len(got) == 1 and got[0].column("contour").to_pylist() == list(range(0, 4 * n, 4))  # a batch for each contour before
