"""Rasters against plain stepping, and their files against a plain decoder."""

from __future__ import annotations

import math
import random
import struct
import zlib

from terraproof.operators import raster


def plain(lines: list, size: int) -> set:
    out = set()
    for page, points, closed, thick in lines:
        ring = points + points[:1] if (closed and len(points) > 2) or len(points) == 1 else points
        for (x0, y0), (x1, y1) in zip(ring, ring[1:], strict=False):
            n = max(abs(x1 - x0), abs(y1 - y0))
            for k in range(n + 1):
                x, y = (x0, y0) if n == 0 else (x0 + math.floor((2 * (x1 - x0) * k + n) / (2 * n)), y0 + math.floor((2 * (y1 - y0) * k + n) / (2 * n)))
                out |= {(page, x + i, y + j) for i in range(thick) for j in range(thick) if 0 <= x + i < size and 0 <= y + j < size}
    return out


def decoded(data: bytes) -> tuple[int, int, set]:
    """Width, height and black pixels of a two-coloured PNG without filters."""
    assert data[:8] == b"\x89PNG\r\n\x1a\n"
    at, chunks = 8, {}
    while at < len(data):
        (n,), kind = struct.unpack(">I", data[at : at + 4]), data[at + 4 : at + 8]
        body = data[at + 8 : at + 8 + n]
        assert struct.unpack(">I", data[at + 8 + n : at + 12 + n])[0] == zlib.crc32(kind + body)
        chunks[kind], at = body, at + 12 + n
    w, h, depth, colour = struct.unpack(">IIBB", chunks[b"IHDR"][:10])
    raw, line = zlib.decompress(chunks[b"IDAT"]), -(-w // 8) + 1
    assert (depth, colour) == (1, 0) and len(raw) == h * line and all(raw[y * line] == 0 for y in range(h))
    return w, h, {(x, y) for y in range(h) for x in range(w) if not raw[y * line + 1 + x // 8] >> (7 - x % 8) & 1}


def made(seed: int) -> list:
    rng = random.Random(seed)
    any_point = lambda: (rng.randrange(-60, 400), rng.randrange(-60, 400))
    lines = [(rng.choice("ab"), [any_point() for _ in range(rng.randrange(1, 6))], rng.random() < 0.5, rng.choice([1, 2, 3])) for _ in range(60)]
    return lines + [("a", [(-10**6, 5), (10**6, 9)], False, 2), ("a", [(5, 10**6), (5, -(10**6))], False, 1), ("c", [(1, 1), (1, 1)], True, 1), ("d", [(900, 900)], False, 2)]


def rows(spark, lines: list):
    return spark.createDataFrame([(p, [{"x": x, "y": y} for x, y in pts], c, t) for p, pts, c, t in lines] + [("a", [], False, 1), ("a", None, None, None)], "page string, pixels array<struct<x:int,y:int>>, closed boolean, thickness int")


def test_pixels_equal_plain_stepping(spark):
    lines = made(1)
    drawn = raster.draw(rows(spark, lines), 300, "page")
    got = [(r["page"], r["x"], r["y"]) for r in raster.pixel_rows(drawn, "page").collect()]
    assert len(got) == len(set(got)) and set(got) == plain(lines, 300)
    # of the two lines that are far longer than the raster only the steps on it are made
    far = [x for x in lines if max(abs(v) for p in x[1] for v in p) > 10**5]
    assert raster.stepped(raster.segments(rows(spark, far), "page"), 300, "page").count() < 2000
    assert "Python" not in drawn._jdf.queryExecution().executedPlan().toString()


def test_files_of_tiles(spark):
    lines = made(2)
    for size, tile in ((300, 256), (300, 128), (64, 64)):
        got = raster.tiles(raster.draw(rows(spark, lines), size, "page"), size, "page", tile=tile).collect()
        pixels = set()
        for r in got:
            w, h, black = decoded(bytes(r["png"]))
            assert (w, h) == (r["width"], r["height"]) == (min(tile, size - r["i"] * tile), min(tile, size - r["j"] * tile))
            pixels |= {(r["page"], x + r["i"] * tile, y + r["j"] * tile) for x, y in black}
        assert pixels == plain(lines, size)


def test_nothing_drawn(spark):
    none = rows(spark, [("d", [(900, 900)], False, 2)])
    assert raster.tiles(raster.draw(none, 300, "page"), 300, "page").count() == 0
