"""Registration of drawings on a reference raster: pixel and world coordinates, edge agreement, alternatives, contours.

Rasters arrive as rows of edge pixels and candidates as rows; what finds them (rendering, template matching) is outside.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraproof.functions import rules as R
from terraproof.functions.geo import bounds, center, contour_distance, haversine_m
from terraproof.operators.georef import registration_confidence

Box = tuple[float, float, float, float]


def to_reference(lon: Column, lat: Column, bbox: Box, width: int, height: int) -> tuple[Column, Column]:
    """Pixel of a place on a raster that spans a (south, west, north, east) box."""
    south, west, north, east = bbox
    return (lon - west) / (east - west) * max(1, width - 1), (north - lat) / (north - south) * max(1, height - 1)


def to_wgs84(x: Column, y: Column, bbox: Box, width: int, height: int) -> tuple[Column, Column]:
    """Place (lon, lat) of a pixel."""
    south, west, north, east = bbox
    return west + x / max(1, width - 1) * (east - west), north - y / max(1, height - 1) * (north - south)


def metres_per_pixel(bbox: Box, width: int, height: int) -> tuple[float, float]:
    """Size of a pixel at the middle of the box."""
    south, west, north, east = bbox
    across = 2 * R.EARTH_RADIUS_M * math.asin(abs(math.cos(math.radians((south + north) / 2)) * math.sin(math.radians(east - west) / 2)))
    along = R.EARTH_RADIUS_M * math.radians(north - south)
    return max(1e-6, across / max(1, width - 1)), max(1e-6, along / max(1, height - 1))


def offset_m(x: Column, y: Column, lon: Column, lat: Column, bbox: Box, width: int, height: int) -> Column:
    """Metres between a pixel and a place; null without a place."""
    return haversine_m(*to_wgs84(x, y, bbox, width, height), lon, lat)


def through(matrix: Column, x: Column, y: Column, crop_x: Column, crop_y: Column) -> tuple[Column, Column]:
    """Reference pixel of a page pixel; the matrix is a struct (a, b, c, d, e, f) of two rows, applied inside the crop."""
    u, v = x - crop_x, y - crop_y
    return matrix["a"] * u + matrix["b"] * v + matrix["c"], matrix["d"] * u + matrix["e"] * v + matrix["f"]


def _samples(matrix: Column, crop_x: Column, crop_y: Column, width: Column, height: Column, reference: tuple[int, int]) -> list[tuple[Column, Column, Column, Column, Column]]:
    """(x, y, reference x, reference y, whether that is on the reference raster) of fixed places of the page."""
    made = []
    for fx, fy in R.CONTROL_SAMPLES:
        x, y = width * fx, height * fy
        rx, ry = through(matrix, x, y, crop_x, crop_y)
        made.append((x, y, rx, ry, (rx >= 0) & (rx < reference[0]) & (ry >= 0) & (ry < reference[1])))
    return made


def sample_controls(matrix: Column, crop_x: Column, crop_y: Column, width: Column, height: Column, bbox: Box, reference: tuple[int, int]) -> Column:
    """Control points (x, y, lon, lat) at fixed places of the page, those that fall on the reference raster."""
    made = []
    for x, y, rx, ry, on in _samples(matrix, crop_x, crop_y, width, height, reference):
        lon, lat = to_wgs84(rx, ry, bbox, *reference)
        made.append(F.when(on, F.struct(F.round(x, 3).alias("x"), F.round(y, 3).alias("y"), lon.alias("lon"), lat.alias("lat"))))
    return F.array_compact(F.array(*made))


def count_controls(matrix: Column, crop_x: Column, crop_y: Column, width: Column, height: Column, reference: tuple[int, int]) -> Column:
    """How many points ``sample_controls`` gives, without making them."""
    return sum((F.coalesce(on, F.lit(False)).cast("int") for *_, on in _samples(matrix, crop_x, crop_y, width, height, reference)), F.lit(0))


def apart(rows: Column, kind: str, x: str, y: str, distance: float, most: int | None = None) -> Column:
    """Of an array of structs, in its order, those no nearer than ``distance`` to one taken before; at most ``most``."""
    near = lambda taken, r: F.exists(taken, lambda t: F.sqrt((r[x] - t[x]) * (r[x] - t[x]) + (r[y] - t[y]) * (r[y] - t[y])) < distance)
    full = lambda taken: F.size(taken) >= most if most else F.lit(False)
    return F.aggregate(rows, F.array().cast(kind), lambda taken, r: F.when(full(taken) | near(taken, r), taken).otherwise(F.concat(taken, F.array(r))))


def edge_scores(plan: DataFrame, reference: DataFrame) -> DataFrame:
    """Agreement of edge pixels (candidate, x, y) of drawings and of the reference under them.

    A pixel is met if one of the other side lies within four pixels, counted in straight and diagonal steps. Precision
    is the share of the drawing's pixels that are met, recall that of the reference's. Candidates with few pixels on
    either side have no scores. Repeated pixels count once; rows with a null are no pixels. Both sides are dealt to
    square cells, so that a crowded candidate is many small joins.
    """
    cell = lambda v: F.floor(v / R.EDGE_REACH_PX)
    p, r = (df.select("candidate", F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y")).dropna().distinct() for df in (plan, reference))

    def met(one: DataFrame, other: DataFrame, n: str, hits: str) -> DataFrame:
        spread = other.select(F.col("candidate").alias("c"), F.col("x").alias("ox"), F.col("y").alias("oy"), F.explode(F.array(*(F.struct((cell(F.col("x")) + i).alias("i"), (cell(F.col("y")) + j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))).alias("k"))
        dx, dy = F.abs(F.col("x") - F.col("ox")), F.abs(F.col("y") - F.col("oy"))
        steps = F.least(dx, dy) * R.DIAGONAL_STEP + F.abs(dx - dy) * R.STRAIGHT_STEP
        same = (F.col("candidate") == F.col("c")) & (cell(F.col("x")) == F.col("k.i")) & (cell(F.col("y")) == F.col("k.j"))
        hit = one.join(spread, same & (steps <= R.EDGE_REACH_PX), "left_semi").groupBy("candidate").agg(F.count(F.lit(1)).alias(hits))
        return one.groupBy("candidate").agg(F.count(F.lit(1)).alias(n)).join(hit, "candidate", "left")

    both = met(p, r, "edges", "_p").join(met(r, p, "reference_edges", "_r"), "candidate", "full").fillna(0)
    enough = (F.col("edges") >= R.MIN_PLAN_EDGES) & (F.col("reference_edges") >= R.MIN_REFERENCE_EDGES)
    scored = both.withColumns({"precision": F.when(enough, F.col("_p") / F.col("edges")), "recall": F.when(enough, F.col("_r") / F.col("reference_edges"))})
    return scored.select("candidate", "edges", "reference_edges", "precision", "recall", edge_f1(F.col("precision"), F.col("recall")).alias("f1"))


def edge_f1(precision: Column, recall: Column) -> Column:
    return precision * 2 * recall / F.greatest(F.lit(1e-9), precision + recall)


def registration_score(f1: Column, offset: Column) -> Column:
    """F1 and what the distance from the expected place, if one is known, adds or takes."""
    return f1 + F.when(offset.isNull(), F.lit(0.0)).otherwise(F.greatest(F.lit(-0.06), F.lit(0.05) - offset / 10000.0))


def lowest_costs(costs: DataFrame, key: str, most: int = R.LOWEST_COSTS, distance: float = R.ANCHOR_SEPARATION_PX) -> DataFrame:
    """Of each key's placements (x, y, cost) the cheapest few, then greedily those that stand apart.

    Ties go to the upper, then the left placement; null and NaN costs are none. The few are picked before the shuffle.
    """
    w = Window.partitionBy(key).orderBy("cost", "y", "x")
    few = costs.filter("cost IS NOT NULL AND NOT isnan(cost)").withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= most)
    lists = few.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("cost", "y", "x"))).alias("all"))
    return lists.select(key, F.explode(apart(F.col("all"), lists.schema["all"].dataType.simpleString(), "x", "y", distance)).alias("v")).select(key, "v.x", "v.y", "v.cost")


def alternatives(candidates: DataFrame, key: str, bbox: Box, reference: tuple[int, int], most: int = R.MAX_VARIANTS) -> DataFrame:
    """Registrations of each key's page, best first and apart from each other, with their rank, confidence and centre.

    Candidates carry ordinal, score, f1, precision, recall, anchor_x, anchor_y, matrix, crop_x, crop_y, width, height and
    offset_m (null without an expected place). Those with fewer than five control points on the reference are passed
    over. The search bounds the candidates of a page (a few placements for each angle and scale). Points are made for the
    registrations that are taken; a candidate travels with its matrix alone.
    """
    place = ("matrix", "crop_x", "crop_y", "width", "height")
    usable = candidates.filter(count_controls(*map(F.col, place), reference) >= R.MIN_REGISTRATION_POINTS)
    # an offset of exactly zero counts as none
    supported = F.coalesce((F.col("offset_m") > 0) & (F.col("offset_m") <= R.SUPPORT_M), F.lit(False)).cast("double")
    unit = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(c, F.lit(0.0))))
    row = F.struct(*((-F.coalesce(c, F.lit(0.0))).alias("o_" + c) for c in ("score", "f1", "precision", "recall")), "ordinal", "anchor_x", "anchor_y", registration_confidence(unit("f1"), unit("precision"), unit("recall"), supported).alias("confidence"), *place)
    lists = usable.groupBy(key).agg(F.sort_array(F.collect_list(row)).alias("all"))
    taken = apart(F.col("all"), lists.schema["all"].dataType.simpleString(), "anchor_x", "anchor_y", R.ANCHOR_SEPARATION_PX, most)
    out = lists.select(key, F.posexplode(taken).alias("at", "v"))
    out = out.withColumn("points", sample_controls(*(F.col(f"v.{c}") for c in place), bbox, reference))
    return out.select(key, (F.col("at") + 1).alias("rank"), "v.ordinal", (-F.col("v.o_score")).alias("score"), "v.confidence", "points", center(F.col("points")).alias("center"))


def contour_anchors(contours: DataFrame, anchors: DataFrame, within: float = R.ANCHOR_DISTANCE_PX) -> DataFrame:
    """Contours (page, contour, points) with the nearest anchor (page, id, x, y, confidence, role, label) within reach.

    The distance is that to the closed contour, inside or outside; ties go to the more confident anchor, then the
    smaller id. Contours without an anchor fall away, as do anchors without a role. A contour is dealt to the square
    cells of its box widened by the reach, an anchor to its own.
    """
    cell = lambda v: F.floor(v / within)
    box = contours.withColumn("_b", bounds(F.col("points")))
    dealt = box.withColumn("ci", F.explode(F.sequence(cell(F.col("_b.min_x") - within), cell(F.col("_b.max_x") + within)))).withColumn("cj", F.explode(F.sequence(cell(F.col("_b.min_y") - within), cell(F.col("_b.max_y") + within)))).drop("_b")
    named = anchors.filter("role IS NOT NULL").select("page", "id", F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("confidence").alias("ac"), "role", "label", cell(F.col("x")).alias("ci"), cell(F.col("y")).alias("cj"))
    pairs = dealt.join(named, ["page", "ci", "cj"]).withColumn("distance", contour_distance(F.col("ax"), F.col("ay"), F.col("points"))).filter(F.col("distance") <= within)
    best = pairs.groupBy("page", "contour").agg(F.min(F.struct("distance", (-F.coalesce("ac", F.lit(0.0))).alias("c"), "id", "role", "label")).alias("b"))
    return best.select("page", "contour", F.col("b.id").alias("anchor"), F.col("b.role").alias("role"), F.col("b.label").alias("label"), F.col("b.distance").alias("distance"))


def relevant(tag) -> Column:
    """True if a mapped element has one of the tags that are drawn; ``tag`` gives the column of a tag, null if absent."""
    return F.coalesce(*(tag(k) for k in R.DRAWN_TAGS)).isNotNull()


def thickness(tag) -> Column:
    """Pixels a mapped element's line is drawn with."""
    return F.when(F.coalesce(*(tag(k) for k in R.THICK_TAGS)).isNotNull(), 2).otherwise(1)


def drawn_lines(elements: DataFrame, bbox: Box, size: int) -> DataFrame:
    """Polylines (type, id, line, closed, thickness, pixels) of mapped elements on a square reference raster.

    Elements carry type, id, tags, geometry and members (each with a geometry); an element's own line and those of its
    members count. Pixels are rounded half to even; those over 32 pixels off the raster fall away, and lines of fewer
    than two points with them.
    """
    size = max(256, min(4096, size))
    tag = lambda k: F.try_element_at("tags", F.lit(k))
    no_line = F.array().cast(elements.schema["geometry"].dataType.simpleString())
    lines = F.filter(F.concat(F.array(F.coalesce("geometry", no_line)), F.transform(F.coalesce("members", F.array().cast(elements.schema["members"].dataType.simpleString())), lambda m: F.coalesce(m["geometry"], no_line))), lambda g: F.size(g) > 0)
    has = lambda k, v: F.coalesce(tag(k) == v, F.lit(False))
    closed = tag("building").isNotNull() | tag("water").isNotNull() | has("area", "yes") | has("natural", "water")

    def pixel(p: Column) -> Column:
        x, y = to_reference(p["lon"], p["lat"], bbox, size, size)
        return F.struct(F.rint(x).cast("int").alias("x"), F.rint(y).cast("int").alias("y"))

    near = lambda v: (v >= -32) & (v < size + 32)
    each = elements.filter(relevant(tag)).select("type", "id", F.posexplode(lines).alias("line", "g"), closed.alias("closed"), thickness(tag).alias("thickness"))
    pixels = F.filter(F.transform(F.filter("g", lambda p: p["lon"].isNotNull() & p["lat"].isNotNull()), pixel), lambda p: near(p["x"]) & near(p["y"]))
    return each.withColumn("pixels", pixels).filter(F.size("pixels") >= 2).drop("g")


def compact_metrics(*columns: str) -> list[Column]:
    """Metrics to three decimals, halves up."""
    return [(F.floor(F.col(c) * 1000 + 0.5) / 1000).alias(c) for c in columns]


def printed_controls(lines: DataFrame, key: str, bbox: Box) -> DataFrame:
    """Control points (key, x, y, lon, lat) printed on a page, as grid references or as longitude and latitude.

    Lines carry text and x, y of their middle. A page has points if three or more pass the checks near the box.
    """
    from terraproof.functions.geo import checked_controls
    from terraproof.functions.grid import with_place
    from terraproof.functions.text import coordinate_pair

    found = lines.withColumn("_c", coordinate_pair(F.col("text"))).filter("_c IS NOT NULL").select(key, "x", "y", "_c.kind", "_c.first", "_c.second")
    on_grid = F.col("kind") == "osgb"
    placed = with_place(found, F.when(on_grid, F.col("first")), F.when(on_grid, F.col("second")))
    world = lambda c, n: F.when(on_grid, F.col(c)).otherwise(F.col(n)).alias(c)
    points = placed.select(key, "x", "y", world("lon", "first"), world("lat", "second"))
    good = checked_controls(points, key, bbox).filter("accepted").select(key)
    return points.filter("lon IS NOT NULL AND lat IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL").join(good, key, "left_semi")
