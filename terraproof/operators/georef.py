"""Georeference candidates: variants, consensus between documents, affine fits, extents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraproof.functions import rules as R
from terraproof.functions.geo import haversine_m, ring_area
from terraproof.operators.state import shared_folder, written


def variant_score(confidence: Column, f1: Column, precision: Column, recall: Column) -> Column:
    z = lambda c: F.coalesce(c, F.lit(0.0))
    return z(confidence) * 2 + z(f1) + z(precision) * 0.25 + z(recall) * 0.25


def registration_confidence(f1: Column, precision: Column, recall: Column, support: Column) -> Column:
    return F.least(F.lit(0.99), f1 * 0.6 + precision * 0.2 + recall * 0.2 + support * 0.03)


def usable(candidates: DataFrame, min_confidence: float = R.CONSENSUS_CONFIDENCE) -> DataFrame:
    """The candidates with enough confidence and a place, all of them."""
    ok = (F.col("confidence") >= min_confidence) & F.col("lon").isNotNull() & F.col("lat").isNotNull()
    return candidates.filter(ok).select("application", "document", "rank", "ordinal", "lon", "lat", "confidence", "f1")


def variants(candidates: DataFrame, min_confidence: float = R.CONSENSUS_CONFIDENCE, apart_m: float = R.VARIANT_SEPARATION_M, most: int = R.MAX_VARIANTS) -> DataFrame:
    """The usable candidates (application, document, rank, ordinal, lon, lat, confidence, f1) of each document.

    In order of rank, greedily: a candidate nearer than ``apart_m`` to one taken before is passed over; a document
    keeps ``most``. The fold runs over one document's candidates, which the registration bounds.
    """
    row = F.struct("rank", "ordinal", "lon", "lat", "confidence", "f1")
    lists = usable(candidates, min_confidence).groupBy("application", "document").agg(F.array_sort(F.collect_list(row)).alias("all"))
    kind = lists.schema["all"].dataType.simpleString()
    near = lambda acc, x: F.exists(acc, lambda y: haversine_m(x["lon"], x["lat"], y["lon"], y["lat"]) < apart_m)
    taken = F.aggregate("all", F.array().cast(kind), lambda acc, x: F.when(near(acc, x) | (F.size(acc) >= most), acc).otherwise(F.concat(acc, F.array(x))))
    return lists.select("application", "document", F.explode(taken).alias("v")).select("application", "document", "v.*")


#: Less than a degree of latitude has, so that cells are wider than counted; the reaches a cell is wide, and cells around the
#: globe below which a band is one cell.
METRES_PER_DEGREE_LOW, REACHES, LEAST_ACROSS = 110000.0, 4, 16


def _cell(lon: Column, across: Column, shift: float = 0.0) -> Column:
    return F.pmod(F.floor((lon + 180) / 360 * across + shift), across)


def consensus(found: DataFrame, within_m: float = R.CONSENSUS_M, min_documents: int = R.CONSENSUS_DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """(evidence by application, members of accepted applications) from variants.

    Every variant is an anchor; of each document the nearest variant within reach is its member. Most documents win,
    then quality, then the smaller spread; ties go to the first anchor. Anchors are compared within their application
    and within cells of four reaches, which meet across the 180th meridian; an anchor is dealt to the cells that its reach
    touches, two and a quarter on average.
    """
    high = within_m / METRES_PER_DEGREE_LOW
    height = REACHES * high
    # cells of a band around the globe: their width holds within reach of the band too
    far = F.least(F.lit(90.0), F.greatest(F.abs("band"), F.abs(F.col("band") + 1)) * height + high)
    fit = F.floor(F.cos(F.radians(far)) * (360 / height))
    across = F.when(fit < LEAST_ACROSS, F.lit(1).cast("long")).otherwise(fit)
    score = F.round(variant_score(F.col("confidence"), F.col("f1"), F.lit(None).cast("double"), F.lit(None).cast("double")), 6)
    # read twice below: as anchors and as what lies near them
    v = written(found.select("application", "document", "rank", "ordinal", "lon", "lat", score.alias("score")), shared_folder(found.sparkSession, "consensus"))
    v = v.withColumn("band", F.floor(F.col("lat") / height)).withColumn("cell", _cell(F.col("lon"), across))
    bands = F.array_distinct(F.array(F.floor((F.col("lat") - high) / height), F.floor((F.col("lat") + high) / height)))
    a = v.select("application", F.col("document").alias("a_doc"), F.col("ordinal").alias("a"), F.col("lon").alias("a_lon"), F.col("lat").alias("a_lat"), F.explode(bands).alias("band"))
    a = a.withColumn("cell", F.explode(F.array_distinct(F.array(*(_cell(F.col("a_lon"), across, w / REACHES) for w in (-1, 1))))))
    d = haversine_m(F.col("a_lon"), F.col("a_lat"), F.col("lon"), F.col("lat"))
    near = a.join(v, ["application", "band", "cell"]).withColumn("d", F.round(d, 6)).filter(F.col("d") <= within_m)
    # dealt once by anchor, which serves its documents and its sums
    near = near.select("application", "a_doc", "a", "document", "d", "score", "ordinal", "rank").repartition("application", "a_doc", "a")
    members = near.groupBy("application", "a_doc", "a", "document").agg(F.min(F.struct("d", (-F.col("score")).alias("s"), "ordinal", "rank")).alias("m"))
    sums = F.count(F.lit(1)).alias("documents"), F.sum(-F.col("m.s")).alias("quality"), F.max("m.d").alias("spread")
    total = F.round(F.col("documents") * 10000 + F.col("quality") * 100 - F.col("spread"), 4)

    def best(*more: str) -> DataFrame:
        lists = [F.collect_list(F.struct("document", "m.ordinal", "m.d", "m.rank")).alias(c) for c in more]
        groups = members.groupBy("application", "a_doc", "a").agg(*sums, *lists)
        return groups.groupBy("application").agg(F.min(F.struct((-total).alias("t"), "a_doc", "a", "documents", "spread", *more)).alias("b"))

    sizes = v.groupBy("application").agg(F.count_distinct("document").alias("candidates"), F.count(F.lit(1)).alias("variants"))
    accepted = F.col("b.documents") >= min_documents
    evidence = sizes.join(best(), "application").select("application", "candidates", "variants", F.col("b.documents").alias("documents"), accepted.alias("accepted"), F.round("b.spread", 1).alias("spread_m"))
    # an anchor brings its members along, so that they are not sought again
    chosen = best("members").filter(accepted & F.col("b.a_doc").isNotNull() & F.col("b.a").isNotNull()).select("application", F.explode("b.members").alias("m"))
    return evidence, chosen.select("application", F.col("m.document").alias("document"), F.col("m.ordinal").alias("ordinal"), F.round("m.d", 1).alias("distance_m"), F.col("m.rank").alias("rank"))


def alternatives_used(members: DataFrame, first_rank: int = 0) -> DataFrame:
    """(application, alternative_documents): members of a consensus that an alternative stands for, not the first registration."""
    return members.groupBy("application").agg(F.count_if(F.col("rank") > first_rank).alias("alternative_documents"))


def affine_fit(points: DataFrame, key: str) -> DataFrame:
    """Least-squares affine transform (x, y) -> (lon, lat) of each key's points, null where they determine none.

    Sums of products combine before the shuffle; the 3 x 3 systems are solved by Cramer's rule around the means, for
    which the means come first.
    """
    ok = points.filter("x IS NOT NULL AND y IS NOT NULL AND lon IS NOT NULL AND lat IS NOT NULL")
    s = {n: F.sum(e) for n, e in (("n", F.lit(1.0)), ("x", F.col("x")), ("y", F.col("y")), ("o", F.col("lon")), ("a", F.col("lat")))}
    means = ok.groupBy(key).agg(*(e.alias("s" + n) for n, e in s.items())).select(key, F.col("sn").alias("n"), *((F.col("s" + c) / F.col("sn")).alias("m" + c) for c in "xyoa"))
    dx, dy, do, da = (F.col(c) - F.col(m) for c, m in (("x", "mx"), ("y", "my"), ("lon", "mo"), ("lat", "ma")))
    sums = ok.join(means, key).groupBy(key).agg(*(F.first(c).alias(c) for c in ("n", "mx", "my", "mo", "ma")), *(F.sum(a * b).alias(n) for n, a, b in (("xx", dx, dx), ("xy", dx, dy), ("yy", dy, dy), ("xo", dx, do), ("yo", dy, do), ("xa", dx, da), ("ya", dy, da))))
    det = F.col("xx") * F.col("yy") - F.col("xy") * F.col("xy")
    good = (F.col("n") >= 3) & (F.abs(det) > 1e-9)
    slope = lambda a, b, c, d: F.when(good, (F.col(a) * F.col(b) - F.col(c) * F.col(d)) / F.when(det != 0, det))
    fit = sums.select(key, "n", "mx", "my", "mo", "ma", slope("xo", "yy", "yo", "xy").alias("lon_x"), slope("yo", "xx", "xo", "xy").alias("lon_y"), slope("xa", "yy", "ya", "xy").alias("lat_x"), slope("ya", "xx", "xa", "xy").alias("lat_y"))
    return fit.select(key, F.col("n").cast("long").alias("points"), "lon_x", "lon_y", (F.col("mo") - F.col("lon_x") * F.col("mx") - F.col("lon_y") * F.col("my")).alias("lon_0"), "lat_x", "lat_y", (F.col("ma") - F.col("lat_x") * F.col("mx") - F.col("lat_y") * F.col("my")).alias("lat_0"))


def clip_to_box(points: Column, bbox: tuple[float, float, float, float]) -> Column:
    """A polygon, array of (x, y), cut to a (south, west, north, east) box: a fold over the box's four sides.

    Each side keeps what lies on its inner side of the polygon and the places where the polygon's edges cross it.
    """
    south, west, north, east = bbox
    sides = F.array(*(F.struct(F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b"), F.lit(float(c)).alias("c")) for a, b, c in ((1, 0, west), (-1, 0, -east), (0, 1, south), (0, -1, -north))))
    kind = "array<struct<x:double,y:double>>"
    depth = lambda side, p: side["a"] * p["x"] + side["b"] * p["y"] - side["c"]

    def cut(acc: Column, side: Column) -> Column:
        before = F.concat(F.slice(acc, F.lit(-1), F.lit(1)), F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))

        def step(q: Column, p: Column) -> Column:
            t = depth(side, q) / F.nullif(depth(side, q) - depth(side, p), F.lit(0.0))
            cross = F.struct((q["x"] + (p["x"] - q["x"]) * t).alias("x"), (q["y"] + (p["y"] - q["y"]) * t).alias("y"))
            return F.array(F.when((depth(side, q) >= 0) != (depth(side, p) >= 0), cross), F.when(depth(side, p) >= 0, F.struct(p["x"].alias("x"), p["y"].alias("y"))))

        return F.array_compact(F.flatten(F.zip_with(before, acc, step))).cast(kind)

    return F.aggregate(sides, points.cast(kind), cut)


def geofence_overlap(corners: Column, bbox: tuple[float, float, float, float]) -> Column:
    """Share of an extent, array of (lon, lat), inside a (south, west, north, east) box; null without an area."""
    points = F.transform(corners, lambda p: F.struct(p["lon"].cast("double").alias("x"), p["lat"].cast("double").alias("y")))
    bad = lambda c: F.exists(c, lambda p: p["x"].isNull() | p["y"].isNull())
    # transform over a one-element array binds a value to a name, so that it is computed once
    bound = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))
    share = lambda c, whole: F.when(whole > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), bound(clip_to_box(c, bbox), ring_area) / F.nullif(whole, F.lit(0.0)))))
    return F.when(corners.isNotNull(), bound(points, lambda c: F.when(~bad(c) & (F.size(c) > 2), bound(ring_area(c), lambda whole: share(c, whole)))))


def extent_corners(width: Column, height: Column, fit: dict[str, Column]) -> Column:
    """Corners (lon, lat) of a page of that size under an affine fit, in order around it; null without a size or a fit."""
    zero = F.lit(0.0)
    at = lambda x, y: F.struct((fit["lon_x"] * x + fit["lon_y"] * y + fit["lon_0"]).alias("lon"), (fit["lat_x"] * x + fit["lat_y"] * y + fit["lat_0"]).alias("lat"))
    return F.when((width > 0) & (height > 0) & fit["lon_x"].isNotNull(), F.array(at(zero, zero), at(width, zero), at(width, height), at(zero, height)))


def page_extents(pages: DataFrame, points: DataFrame, bbox: tuple[float, float, float, float], key: str = "page") -> DataFrame:
    """``pages`` (key, width, height, ...) and ``overlap``: the share of the page that its control points (key, x, y, lon,
    lat) put into the box; null where they determine no transform."""
    fit = affine_fit(points, key).drop("points")
    joined = pages.join(fit, key, "left")
    corners = extent_corners(F.col("width").cast("double"), F.col("height").cast("double"), {c: F.col(c) for c in fit.columns})
    return joined.withColumn("_corners", corners).withColumn("overlap", geofence_overlap(F.col("_corners"), bbox)).select(*(F.col(c) for c in pages.columns), "overlap")


def strongest(embedded: Column, explicit: Column, printed: Column) -> Column:
    """Struct (method, confidence) of the first direct georeference there is: embedded, explicit, printed."""
    make = lambda c, m, n: F.when(c.isNotNull(), F.struct(F.lit(m).alias("method"), F.lit(n).alias("confidence")))
    return F.coalesce(make(embedded, "embedded-geospatial", 1.0), make(explicit, "explicit-control-points", 1.0), make(printed, "printed-coordinates", 0.98))


def choose_registrations(direct: DataFrame, agreed: DataFrame) -> DataFrame:
    """Union of direct and consensus registrations by document; a direct one takes precedence, then the better score, then the first page."""
    both = direct.withColumn("way", F.lit(0)).unionByName(agreed.withColumn("way", F.lit(1)))
    best = both.groupBy("document").agg(F.min(F.struct("way", (-F.coalesce("score", F.lit(float("-inf")))).alias("s"), "page", "score")).alias("b"))
    return best.select("document", F.col("b.page").alias("page"), F.col("b.score").alias("score"), F.when(F.col("b.way") == 0, "direct").otherwise("consensus").alias("method"))
