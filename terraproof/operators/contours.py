"""Outlines of drawn shapes, from rows of edge pixels to simplified lines.

Pixels travel as bits, a word for a stretch of a row. A drawing is dealt to square tiles with a margin, so that no task holds
more than a tile's pixels at a time. A border runs along the sides between a pixel that is set and one that is not; what
follows a side is decided by the two pixels ahead of it, shapes being joined over corners. In a tile, sides are walked to whole
borders or to chains that leave it; chains are joined in blocks of tiles, and those that leave a block in blocks of blocks. A
border's name and its first pixel are its first side in reading order, so that the cut into tiles shows nowhere. Pixels and
length are sums over chains; only lines need the sides themselves, and one border's are put together in one task.

Pixels (page, x, y, width, height) count once each; rows with a null or outside their raster are none. A page has one size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terraproof.functions import rules as R
from terraproof.operators.registration import Box, contour_anchors, through, to_wgs84
from terraproof.operators.state import shared_folder, written

TILE = 256
#: Pixels of tiles, or points of lines, that a task works on at a time; tiles to a block's side, blocks to the next block's.
STACK, BLOCK = 1 << 19, 8
#: Bits of a side's number: row, column, direction (top, right, bottom, left).
COLUMN_BITS = 26
# What is too small to be a shape, and how far a line may stray from its border.
MIN_PIXELS, MIN_LENGTH, LEAST_STRAY, STRAY_SHARE = 12, 35.0, 1.5, 0.008
ALONG = ((1, 0), (0, 1), (-1, 0), (0, -1))
OUTWARD = ((0, -1), (1, 0), (0, 1), (-1, 0))
CHAIN = "start long, after long, home long, straight long, diagonal long"
CONTOUR = "contour long, pixels int, length double, points array<struct<x:double,y:double>>, line array<struct<x:double,y:double>>"


def _word(tile: int) -> int:
    """Pixels in a word: a tile's rows are cut into words of at most 64, the last of them a little shorter, but no margin's width."""
    if tile < 8:
        raise ValueError("a tile is at least 8 pixels wide")
    return next(w for n in range(-(-tile // 64), tile) if tile - (n - 1) * (w := -(-tile // n)) >= 3)


def _dealt(pixels: DataFrame, tile: int, margin: int) -> DataFrame:
    """Words in each tile whose square, widened by ``margin``, holds a pixel of theirs: place in the tile widened by a word, bits."""
    word, most = _word(tile), -(-tile // _word(tile)) - 1
    c = lambda n: F.col(n).cast("long").alias(n)
    ok = pixels.select("page", *map(c, ("x", "y", "width", "height"))).filter("x >= 0 AND y >= 0 AND x < width AND y < height AND page IS NOT NULL")
    at = ok.withColumns({"i": F.expr(f"x div {tile}"), "k": F.expr(f"x % {tile} div {word}")})
    rows = at.groupBy("page", "i", "k", "y").agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(x % {tile} % {word} AS INT))")).alias("bits"), F.max("width").alias("width"), F.max("height").alias("height"))
    first, last = (1 << margin) - 1, ((1 << margin) - 1) << (tile - most * word - margin)
    last -= 1 << 64 if last >= 1 << 63 else 0
    beside = F.array(F.col("i"), F.when(F.expr(f"k = 0 AND bits & {first}L <> 0"), F.col("i") - 1), F.when(F.expr(f"k = {most} AND bits & {last}L <> 0"), F.col("i") + 1))
    above, below = F.expr(f"(y + {tile - margin}) div {tile} - 1"), F.expr(f"(y + {margin}) div {tile}")
    each = rows.withColumn("_i", F.explode(beside)).withColumn("j", F.explode(F.array(below, F.when(above < below, above))))
    each = each.filter(f"_i >= 0 AND j >= 0 AND _i * {tile} < width AND j * {tile} < height")
    place = F.expr(f"CAST((y - j * {tile} + {margin}) * {tile + 2 * word} + (i - _i) * {tile} + k * {word} + {word} AS INT)").alias("at")
    return each.groupBy("page", F.col("_i").alias("i"), "j").agg(F.collect_list(F.struct(place, "bits")).alias("words"), F.max("width").alias("width"), F.max("height").alias("height"))


def _flat(lists: pa.Array, *fields: str) -> list[np.ndarray]:
    """The lengths of lists of structs, and their fields one after another."""
    rows = lists.flatten()
    return [np.diff(lists.offsets.to_numpy()), *(rows.field(f).to_numpy(zero_copy_only=False) for f in fields)]


def _by_tile(dealt: DataFrame, tile: int, margin: int, run, schema: StructType) -> DataFrame:
    """``run`` on stacks of tiles: i, j, width, height and the grids; gives each row's tile in the stack, then the columns after the page."""
    word, side = _word(tile), tile + 2 * margin
    stack = max(1, STACK // (side * side))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, stack) for k in range(0, batch.num_rows, stack)):
                n, at, bits = _flat(part.column("words"), "at", "bits")
                grids = np.zeros((part.num_rows * side, tile + 2 * word), bool)
                row, start = np.divmod(np.repeat(np.arange(part.num_rows), n) * side * grids.shape[1] + at, grids.shape[1])
                held = np.unpackbits(bits.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                w, b = np.nonzero(held[:, :word])
                grids[row[w], start[w] + b] = True
                grids = grids[:, word - margin : word + tile + margin].reshape(-1, side, side)
                tiles, *found = run(*(part.column(c).to_numpy() for c in ("i", "j", "width", "height")), grids)
                if len(tiles):
                    yield pa.RecordBatch.from_arrays([part.column("page").take(pa.array(tiles)), *found], names=schema.names)

    return dealt.mapInArrow(each, schema)


def _shut(i: np.ndarray, j: np.ndarray, width: np.ndarray, height: np.ndarray, grids: np.ndarray, tile: int, margin: int) -> np.ndarray:
    """Grids whose gaps of a pixel are closed, with a margin that is smaller by two."""
    place = np.arange(grids.shape[1]) - margin
    xs, ys = place + i[:, None] * tile, place + j[:, None] * tile
    inside = ((ys >= 0) & (ys < height[:, None]))[:, :, None] & ((xs >= 0) & (xs < width[:, None]))[:, None, :]

    def near(g: np.ndarray, op: np.ufunc) -> np.ndarray:
        rows = op(op(g[:, :-2], g[:, 1:-1]), g[:, 2:])
        return op(op(rows[:, :, :-2], rows[:, :, 1:-1]), rows[:, :, 2:])

    wide = near(grids, np.logical_or) | ~inside[:, 1:-1, 1:-1]
    return near(wide, np.logical_and) & inside[:, 2:-2, 2:-2]


def closed(pixels: DataFrame, tile: int = TILE) -> DataFrame:
    """``pixels`` with gaps of a pixel closed: widened by one pixel all round, then narrowed; beyond the raster counts as set."""

    def run(i: np.ndarray, j: np.ndarray, width: np.ndarray, height: np.ndarray, grids: np.ndarray) -> list:
        t, y, x = np.nonzero(_shut(i, j, width, height, grids, tile, 2))
        return [t, pa.array(x + i[t] * tile), pa.array(y + j[t] * tile), pa.array(width[t]), pa.array(height[t])]

    dealt = _dealt(pixels, tile, 2)
    return _by_tile(dealt, tile, 2, run, StructType([dealt.schema["page"], *StructType.fromDDL("x long, y long, width long, height long")]))


def _chained(after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of the chains that ``after`` (-1: leads out) makes of them, and where in it a chain begins: rings last, each from its least place."""
    led = np.zeros(len(after), bool)
    led[after[after >= 0]] = True
    step, todo, order, begins = after.tolist(), [True] * len(after), [], []
    for first in (*np.flatnonzero(~led).tolist(), *np.flatnonzero(led).tolist()):
        if todo[first]:
            begins.append(len(order))
            at = first
            while at >= 0 and todo[at]:
                todo[at] = False
                order.append(at)
                at = step[at]
    return np.array(order, np.int64), np.array(begins, np.int64)


def _sides(grids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(side, the side after it, step on the way: 0 none, 1 straight, 2 diagonal) of the pixels inside a margin of one, by flat place."""
    flat, wide, found = grids.ravel(), grids.shape[2], []
    own = np.zeros_like(grids)
    own[:, 1:-1, 1:-1] = grids[:, 1:-1, 1:-1]
    at = np.flatnonzero(own)
    for d, ((ax, ay), (ox, oy)) in enumerate(zip(ALONG, OUTWARD, strict=True)):
        along, out = ay * wide + ax, oy * wide + ox
        p = at[~flat[at + out]]
        left, ahead = flat[p + along + out], flat[p + along]
        q = p + np.where(left | ahead, along, 0) + np.where(left, out, 0)
        found.append((p * 4 + d, q * 4 + np.where(left, (d + 3) % 4, np.where(ahead, d, (d + 1) % 4)), np.where(left, 2, ahead)))
    sides, after, step = (np.concatenate(v) for v in zip(*found, strict=True))
    order = np.argsort(sides)
    return sides[order], after[order], step[order]


def _last_step(grids: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """The step (as in ``_sides``) on which a walk that ends at a side comes to its pixel; 0 for a lone pixel."""
    flat, wide, (p, d) = grids.ravel(), grids.shape[2], np.divmod(sides, 4)
    along, out = (np.array([y * wide + x for x, y in v]) for v in (ALONG, OUTWARD))
    last, todo = np.zeros(len(sides), np.int64), np.ones(len(sides), bool)
    for _ in ALONG:
        left, ahead = flat[p + out[d] - along[d]], flat[p - along[d]]
        last[todo & ahead] = 1
        last[todo & left] = 2
        todo &= ~(left | ahead)
        d = (d + 3) % 4
    return last


def chains(pixels: DataFrame, tile: int = TILE, close: bool = False, sides: bool = True) -> DataFrame:
    """The borders of the pixels, cut where they leave a tile: CHAIN and, if wanted, the sides in order.

    after: the side that follows the last, null for a whole border; home: the least side times 4, and the step by which a
    walk comes to it.
    """
    margin = 3 if close else 1

    def run(i: np.ndarray, j: np.ndarray, width: np.ndarray, height: np.ndarray, grids: np.ndarray) -> list:
        grids = np.ascontiguousarray(_shut(i, j, width, height, grids, tile, margin) if close else grids)
        side, follows, step = _sides(grids)
        known = np.full(grids.size * 4, -1, np.int32)
        known[side] = np.arange(len(side))
        after = known[follows]
        order, begins = _chained(after)
        if not len(begins):
            return [begins]

        def number(s: np.ndarray) -> np.ndarray:
            t, y, x = np.unravel_index(s >> 2, grids.shape)
            return ((y + j[t] * tile - 1 << COLUMN_BITS) + x + i[t] * tile - 1) * 4 + s % 4

        least = np.minimum.reduceat(side[order], begins)
        ends = np.append(begins[1:], len(order)) - 1
        count = lambda kind: pa.array(np.add.reduceat((step[order] == kind).astype(np.int64), begins))
        found = [pa.array(number(side[order[begins]])), pa.array(number(follows[order[ends]]), mask=after[order[ends]] >= 0), pa.array(number(least) * 4 + _last_step(grids, least)), count(1), count(2)]
        if sides:
            found.append(pa.ListArray.from_arrays(pa.array(np.append(begins, len(order)), pa.int32()), pa.array(number(side[order]))))
        return [side[order[begins]] // (4 * grids.shape[1] * grids.shape[2]), *found]

    dealt = _dealt(pixels, tile, margin)
    return _by_tile(dealt, tile, margin, run, StructType([dealt.schema["page"], *StructType.fromDDL(CHAIN + (", sides array<long>" if sides else ""))]))


def joined(cut: DataFrame, reach: int) -> DataFrame:
    """Chains that lead into each other inside square blocks of ``reach`` pixels as one: CHAIN and, if given, the ``parts`` in order.

    Every chain lies in one block. What stays open crosses a block's edge, so that the next, larger blocks get few of them.
    """
    parts = "parts" in cut.columns
    column, row = F.col("start").bitwiseAND(F.lit((1 << COLUMN_BITS + 2) - 1)) / 4, F.shiftright("start", COLUMN_BITS + 2)
    fields = [*StructType.fromDDL(CHAIN).names, *(["parts"] if parts else [])]
    each = cut.groupBy("page", F.floor(column / reach).alias("i"), F.floor(row / reach).alias("j")).agg(F.collect_list(F.struct(*fields)).alias("chains"))
    schema = StructType([cut.schema["page"], *(cut.schema[f] for f in fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, start, follows, home, straight, diagonal = _flat(batch.column("chains"), *fields[:5])
            block, bound = np.repeat(np.arange(len(n)), n), np.append(0, np.cumsum(n)).tolist()
            after, starts, ends = [], start.tolist(), follows.tolist()
            for a, b in zip(bound, bound[1:], strict=False):
                known = dict(zip(starts[a:b], range(a, b), strict=True))
                after += [known.get(e, -1) for e in ends[a:b]]
            after = np.array(after, np.int64)
            order, begins = _chained(after)
            last = order[np.append(begins[1:], len(order)) - 1]
            total = lambda v: pa.array(np.add.reduceat(v[order], begins))
            found = [pa.array(start[order[begins]]), pa.array(follows[last], mask=after[last] >= 0), pa.array(np.minimum.reduceat(home[order], begins)), total(straight), total(diagonal)]
            if parts:
                held = batch.column("chains").flatten().field("parts").take(pa.array(order))
                found.append(pa.ListArray.from_arrays(held.offsets.take(pa.array(np.append(begins, len(order)))), held.flatten()))
            yield pa.RecordBatch.from_arrays([batch.column("page").take(pa.array(block[order[begins]])), *found], names=schema.names)

    return each.mapInArrow(run, schema)


def simplified(points: np.ndarray, stray: float) -> np.ndarray:
    """The points that a line needs to stray no farther than ``stray`` from all of them: the farthest from each chord, in turn."""
    keep, todo = np.zeros(len(points), bool), [(0, len(points) - 1)]
    keep[[0, -1]] = True
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        (px, py), (dx, dy) = points[a], points[b] - points[a]
        rest = points[a + 1 : b]
        size = np.hypot(dx, dy)
        apart = np.abs(dy * (rest[:, 0] - px) - dx * (rest[:, 1] - py)) / size if size else np.hypot(rest[:, 0] - px, rest[:, 1] - py)
        far = int(apart.argmax())
        if apart[far] > stray:
            keep[a + 1 + far] = True
            todo += [(a, a + 1 + far), (a + 1 + far, b)]
    return points[keep]


def outline(sides: np.ndarray) -> tuple[int, int, float, np.ndarray, np.ndarray]:
    """(name, pixels, length, pixels in order, simplified line) of a border's sides in order."""
    first = int(sides.argmin())
    turned = np.concatenate([sides[first:], sides[:first]])
    places = turned >> 2
    places = places[np.append(True, places[1:] != places[:-1])]
    if len(places) > 1 and places[0] == places[-1]:
        places = places[:-1]
    points = np.stack([places & ((1 << COLUMN_BITS) - 1), places >> COLUMN_BITS], 1).astype(np.float64)
    length = float(np.hypot(*np.diff(points, axis=0).T).sum()) if len(points) > 1 else 0.0
    return int(turned[0]), len(points), length, points, simplified(points, max(LEAST_STRAY, STRAY_SHARE * length))


def _assembled(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Contours of chains sorted by page, contour and place in it; many to a batch."""
    pages, held, size = [], [], 0
    key, page, order = None, None, []

    def packed() -> pa.RecordBatch:
        name, n, length, points, line = zip(*held, strict=True)

        def lists(each: tuple[np.ndarray, ...]) -> pa.Array:
            x, y = np.concatenate(each).T
            return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(p) for p in each])), pa.int32()), pa.StructArray.from_arrays([pa.array(x), pa.array(y)], ["x", "y"]))

        return pa.RecordBatch.from_arrays([pa.concat_arrays(pages), pa.array(name), pa.array(n, pa.int32()), pa.array(length), lists(points), lists(line)], names=names)

    for batch in batches:
        for k, at in enumerate(zip(batch.column("page").to_pylist(), batch.column("border").to_pylist(), strict=True)):
            if order and at != key:
                pages.append(page)
                held.append(outline(np.concatenate(order)))
                size, order = size + held[-1][1], []
                if size >= STACK:
                    yield packed()
                    pages, held, size = [], [], 0
            key, page = at, batch.column("page").slice(k, 1)
            order.append(batch.column("sides")[k].values.to_numpy())
    if order:
        pages.append(page)
        held.append(outline(np.concatenate(order)))
        yield packed()


def contours(pixels: DataFrame, tile: int = TILE, close: bool = False, lines: bool = True) -> DataFrame:
    """(page, contour, pixels, length and, with ``lines``, points, line) of each border of the pixels, outer ones and those of holes.

    With ``close``, of the pixels that ``closed`` makes of them, in the same pass over the tiles.
    """
    home = shared_folder(pixels.sparkSession, "contours")
    cut = written(chains(pixels, tile, close, lines), f"{home}/chains")
    state = cut.drop("sides").withColumn("parts", F.array("start")) if lines else cut
    rings, reach = [state.filter("after IS NULL")], tile
    while not (state := state.filter("after IS NOT NULL")).isEmpty():
        if reach >= 1 << COLUMN_BITS:
            raise ValueError("a border does not close: a page has more than one size")
        reach *= BLOCK
        state = written(joined(state, reach), f"{home}/{reach}")
        rings.append(state.filter("after IS NULL"))
    whole = reduce(DataFrame.unionByName, rings)
    if not lines:
        steps = F.col("straight") + F.col("diagonal")
        last = F.expr("CASE home & 3 WHEN 2 THEN sqrt(2D) ELSE CAST(home & 3 AS DOUBLE) END")
        return whole.select("page", F.shiftright("home", 2).alias("contour"), F.greatest(steps, F.lit(1)).cast("int").alias("pixels"), (F.col("straight") + F.col("diagonal") * F.sqrt(F.lit(2.0)) - last).alias("length"))
    names = StructType([cut.schema["page"], *StructType.fromDDL(CONTOUR)])
    run = lambda batches: _assembled(batches, names.names)
    parts = reduce(DataFrame.unionByName, rings[1:], rings[0].limit(0)).select("page", F.shiftright("home", 2).alias("border"), F.posexplode("parts").alias("k", "start"))
    dealt = parts.join(cut.filter("after IS NOT NULL").select("page", "start", "sides"), ["page", "start"]).repartition("page", "border").sortWithinPartitions("page", "border", "k")
    alone = cut.filter("after IS NULL").select("page", F.col("start").alias("border"), "sides")
    return alone.mapInArrow(run, names).unionByName(dealt.select(*alone.columns).mapInArrow(run, names))


def vectorize(pixels: DataFrame, anchors: DataFrame, candidates: DataFrame, bbox: Box, reference: tuple[int, int], within: float = R.ANCHOR_DISTANCE_PX, tile: int = TILE) -> DataFrame:
    """Lines on earth (page, contour, role, label, confidence, distance, points) of the shapes that an anchor is near to.

    Pixels are closed first; borders of few pixels or little length are none. candidates: page, matrix, crop_x, crop_y,
    confidence, one for each page. Points off the reference raster fall away, and lines of fewer than two points with them.
    """
    found = contours(pixels, tile, close=True).filter((F.col("pixels") >= MIN_PIXELS) & (F.col("length") >= MIN_LENGTH))
    found = written(found, shared_folder(pixels.sparkSession, "shapes"))
    named = contour_anchors(found.select("page", "contour", "points"), anchors, within)
    sure = anchors.groupBy("page", F.col("id").alias("anchor")).agg(F.max("confidence").alias("_sure"))
    rows = found.select("page", "contour", "line").join(named, ["page", "contour"]).join(sure, ["page", "anchor"]).join(candidates, "page")

    def place(p: Column) -> Column:
        x, y = through(F.col("matrix"), p["x"], p["y"], F.col("crop_x"), F.col("crop_y"))
        lon, lat = to_wgs84(x, y, bbox, *reference)
        return F.when((x >= 0) & (x < reference[0]) & (y >= 0) & (y < reference[1]), F.struct(lon.alias("lon"), lat.alias("lat")))

    out = rows.withColumn("on_earth", F.array_compact(F.transform("line", place))).filter(F.size("on_earth") >= 2)
    sure = F.greatest(F.coalesce("_sure", F.lit(0.0)), F.coalesce("confidence", F.lit(0.0)))
    return out.select("page", "contour", "role", "label", sure.alias("confidence"), F.round("distance", 1).alias("distance"), F.col("on_earth").alias("points"))
