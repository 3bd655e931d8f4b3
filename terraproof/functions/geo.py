"""Geometry as column expressions. Points are structs (x, y) in metres or (lon, lat) in degrees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraproof.functions.rules import CONTROL_PADDING_M, EARTH_RADIUS_M, METRES_PER_DEGREE


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance; null if a coordinate is."""
    rad = lambda d: d * 0.017453292519943295
    dlat, dlon = F.sin(rad(lat2 - lat1) / 2), F.sin(rad(lon2 - lon1) / 2)
    h = dlat * dlat + F.cos(rad(lat1)) * F.cos(rad(lat2)) * dlon * dlon
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def local_xy(lon: Column, lat: Column, bbox: tuple[float, float, float, float]) -> tuple[Column, Column]:
    """Metres east and north of the middle of a (south, west, north, east) box."""
    import math

    south, west, north, east = bbox
    unit = EARTH_RADIUS_M * math.pi / 180
    return (lon - (west + east) / 2) * (math.cos(math.radians((south + north) / 2)) * unit), (lat - (south + north) / 2) * unit


def bounds(points: Column) -> Column:
    """Struct (min_x, min_y, max_x, max_y) of an array of points."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("min_x"), F.array_min(ys).alias("min_y"), F.array_max(xs).alias("max_x"), F.array_max(ys).alias("max_y"))


def edges(points: Column) -> Column:
    """Neighbouring points as structs (a, b)."""
    n = F.size(points)
    return F.when(n > 1, F.zip_with(F.slice(points, F.lit(1), n - 1), F.slice(points, F.lit(2), n - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).otherwise(F.slice(F.zip_with(points, points, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), 1, 0))


def polyline_length(points: Column) -> Column:
    return F.aggregate(edges(points), F.lit(0.0), lambda s, e: s + F.hypot(e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]))


def ring_area(points: Column) -> Column:
    """Shoelace area; the ring closes itself."""
    closed = F.concat(points, F.slice(points, 1, 1))
    return F.abs(F.aggregate(edges(closed), F.lit(0.0), lambda s, e: s + (e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]))) / 2


def point_in_ring(x: Column, y: Column, points: Column) -> Column:
    """Even-odd rule."""
    closed = F.concat(points, F.slice(points, 1, 1))
    crosses = lambda e: ((e["a"]["y"] > y) != (e["b"]["y"] > y)) & (x < (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / F.nullif(e["b"]["y"] - e["a"]["y"], F.lit(0.0)) + e["a"]["x"])
    return F.size(F.filter(edges(closed), lambda e: F.coalesce(crosses(e), F.lit(False)))) % 2 == 1


def net_area(parts: Column) -> Column:
    """Area of parts, each an array of rings: the first ring's less that of its holes, at least zero."""
    holes = lambda rings: F.aggregate(F.slice(rings, F.lit(2), F.greatest(F.size(rings) - 1, F.lit(0))), F.lit(0.0), lambda s, r: s + ring_area(r))
    one = lambda rings: F.when(F.size(rings) > 0, F.greatest(F.lit(0.0), ring_area(F.get(rings, F.lit(0))) - holes(rings))).otherwise(0.0)
    return F.aggregate(parts, F.lit(0.0), lambda s, rings: s + one(rings))


def point_in_parts(x: Column, y: Column, parts: Column) -> Column:
    """True inside some part's first ring and in none of its holes."""
    holes = lambda rings: F.slice(rings, F.lit(2), F.greatest(F.size(rings) - 1, F.lit(0)))
    return F.exists(parts, lambda rings: F.when(F.size(rings) > 0, point_in_ring(x, y, F.get(rings, F.lit(0))) & ~F.exists(holes(rings), lambda r: point_in_ring(x, y, r))).otherwise(False))


def contour_distance(x: Column, y: Column, points: Column) -> Column:
    """Distance of a point from a contour, which closes itself; inside or outside alike."""
    return distance_to_line(x, y, F.concat(points, F.slice(points, 1, 1)))


def segment_distance(x: Column, y: Column, e: Column) -> Column:
    """Distance of a point from a segment (a, b)."""
    vx, vy = e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]
    square = vx * vx + vy * vy
    t = F.when(square <= 2.220446049250313e-16, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - e["a"]["x"]) * vx + (y - e["a"]["y"]) * vy) / F.nullif(square, F.lit(0.0)))))
    return F.hypot(x - (e["a"]["x"] + vx * t), y - (e["a"]["y"] + vy * t))


def distance_to_line(x: Column, y: Column, points: Column) -> Column:
    return F.array_min(F.transform(edges(points), lambda e: segment_distance(x, y, e)))


def _near_box(lon: Column, lat: Column, bbox: tuple[float, float, float, float]) -> Column:
    import math

    south, west, north, east = bbox
    pad_lat = CONTROL_PADDING_M / METRES_PER_DEGREE
    pad_lon = CONTROL_PADDING_M / max(1000.0, METRES_PER_DEGREE * math.cos(math.radians((south + north) / 2)))
    return lat.between(south - pad_lat, north + pad_lat) & lon.between(west - pad_lon, east + pad_lon)


def _control_verdict(usable: Column, pixels: Column, inside: Column) -> Column:
    reason = F.when(usable < 3, "insufficient-control-points").when(pixels < 3, "duplicate-control-pixels").when(inside < 3, "control-points-outside-park-geofence")
    return F.struct(reason.isNull().alias("accepted"), reason.alias("reason"))


def check_controls(points: Column, bbox: tuple[float, float, float, float]) -> Column:
    """Struct (accepted, reason) of control points (x, y, lon, lat): three usable, three distinct, three near the box."""
    usable = F.filter(points, lambda p: p["x"].isNotNull() & p["y"].isNotNull() & p["lon"].isNotNull() & p["lat"].isNotNull())
    pixels = F.array_distinct(F.transform(usable, lambda p: F.struct(F.round(p["x"], 2).alias("x"), F.round(p["y"], 2).alias("y"))))
    inside = F.filter(usable, lambda p: _near_box(p["lon"], p["lat"], bbox))
    return _control_verdict(F.size(usable), F.size(pixels), F.size(inside))


def checked_controls(points: DataFrame, key: str, bbox: tuple[float, float, float, float]) -> DataFrame:
    """(key, accepted, reason) as ``check_controls`` has it, from points as rows; counts combine before the shuffle."""
    ok = F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("lon").isNotNull() & F.col("lat").isNotNull()
    pixel = F.when(ok, F.struct(F.round("x", 2).alias("x"), F.round("y", 2).alias("y")))
    rows = points.select(key, pixel.alias("pixel"), (ok & _near_box(F.col("lon"), F.col("lat"), bbox)).alias("inside"))
    each = rows.groupBy(key, "pixel").agg(F.count("pixel").alias("usable"), F.count_if("inside").alias("inside"))
    sums = each.groupBy(key).agg(F.sum("usable").alias("usable"), F.count("pixel").alias("pixels"), F.sum("inside").alias("inside"))
    verdict = _control_verdict(F.col("usable"), F.col("pixels"), F.col("inside"))
    return sums.select(key, verdict.alias("c")).select(key, "c.accepted", "c.reason")


def location_prior(*pairs: tuple[Column, Column]) -> Column:
    """Struct (longitude, latitude) of the first pair of texts or numbers that is a place on earth."""
    made = [F.struct(a.try_cast("double").alias("longitude"), b.try_cast("double").alias("latitude")) for a, b in pairs]
    return F.coalesce(*(F.when(p["longitude"].between(-180, 180) & p["latitude"].between(-90, 90), p) for p in made))


def explicit_controls(page: Column, *candidates: Column) -> Column:
    """The first list of control points (x, y, lon, lat, page) with three or more for the page; a point without a page counts for any."""
    mine = [F.filter(c, lambda p: F.coalesce(p["page"], page) == page) for c in candidates]
    return F.coalesce(*(F.when(F.size(m) >= 3, m) for m in mine))


def extent_controls(ring: Column, width: Column, height: Column) -> Column:
    """Control points (x, y, lon, lat) of a raster's footprint, whose ring runs upper left, lower left, lower right, upper right."""
    zero = F.lit(0.0)
    pixels = F.array(*(F.struct(x.alias("x"), y.alias("y")) for x, y in ((zero, zero), (zero, height), (width, height), (width, zero))))
    made = F.zip_with(pixels, F.slice(ring, 1, 4), lambda p, q: F.struct(p["x"].alias("x"), p["y"].alias("y"), q["lon"].alias("lon"), q["lat"].alias("lat")))
    whole = (F.size(ring) >= 4) & (width > 0) & (height > 0) & ~F.exists(F.slice(ring, 1, 4), lambda q: q["lon"].isNull() | q["lat"].isNull())
    return F.when(whole, made)


def center(points: Column) -> Column:
    """Struct (lon, lat): the mean of control points."""
    n = F.nullif(F.size(points), F.lit(0))
    mean = lambda c: F.aggregate(points, F.lit(0.0), lambda s, p: s + p[c]) / n
    return F.struct(mean("lon").alias("lon"), mean("lat").alias("lat"))


def unit(value: Column) -> Column:
    """A number between 0 and 1; null and NaN are 0."""
    return F.when(value.isNull() | F.isnan(value.cast("double")), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value.cast("double"))))


def valid_box(south: Column, west: Column, north: Column, east: Column) -> Column:
    """Struct (south, west, north, east) of numbers or texts, null unless all are finite and the box has an extent."""
    s, w, n, e = (F.nanvl(c.try_cast("double"), F.lit(None).cast("double")) for c in (south, west, north, east))
    far = F.lit(float("inf"))
    finite = (F.abs(s) < far) & (F.abs(w) < far) & (F.abs(n) < far) & (F.abs(e) < far)
    return F.when(finite & (s < n) & (w < e), F.struct(s.alias("south"), w.alias("west"), n.alias("north"), e.alias("east")))
