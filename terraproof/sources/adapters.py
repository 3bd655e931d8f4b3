"""Domain views over the driver's tables.

Each view is a table and a list of (column, SQL expression) that Spark and DuckDB read alike, so that a query and its
SQL start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terraproof.functions import rules as R


def case(key: str, values: list[str | None]) -> str:
    """SQL that picks a text by a number."""
    return f"CASE {key} " + " ".join(f"WHEN {i} THEN " + ("CAST(NULL AS VARCHAR(99))" if v is None else "'" + v.replace("'", "''") + "'") for i, v in enumerate(values)) + " END"


SOURCES = [*R.SOURCE_RANK, *R.UNRANKED_SOURCES]
CLASSES = [*R.LOCKED_CLASSES, "tree", "street-furniture"]
TITLES = [
    "Proposed Site Plan", "Planning Statement", "Topographical Survey", "Existing Block Plan", "Drainage Assessment Report", "Proposed Coaster Track Layout",
    "Landscape Masterplan", "Roof Plan and Section", "General Arrangement", "Design and Access Statement", "Pond detail drawing", "Master Layout",
    "Cover letter", "New Ride GA drawing scale 1:500", "Photographs", "Existing site layout", "Proposed elevation 1:100 and 1/50", "Decision notice",
]
ROLES = [None, None, "terrain-or-drainage", None, "terrain-or-drainage", "ride-layout", None, None, None, None, "water", None, None, None, None, None, "elevation", None]
STATUSES = ["Approved", "Granted with conditions", "Withdrawn", "Refused", "Awaiting decision", "Unknown", "  ", None]
LABELS = [
    "Proposed raised footbridde and path", "New roller coaster track layout", "Track support column bases", "Retaining wall", "Existing pond", "Timber fence",
    "Access road", "Station building", "Guard rail", "Boulders", "Embankment", "Notes", "  ", "Restaurant and toilet block with service yard behind it",
]
COORDINATES = ["E 403000 N 344000", "Easting: 403,000", "403000 344000", "-1.8851, 52.9876", "52.9876 -1.8851", "sheet 1 of 3", "12 13 14.5", "x", None]

VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "features": ("events", {
        "authority_key": "concat(CAST(user_id AS VARCHAR(20)), ':', CAST(CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 20 AS VARCHAR(20)))",
        "ordinal": "event_id",
        "source": case("event_id % 14", SOURCES),
        "feature_class": case("user_id % 13", CLASSES),
        "confidence": "value / CAST(500 AS DOUBLE)",
        "eligible": "CASE CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 3 WHEN 0 THEN true WHEN 1 THEN false ELSE NULL END",
    }),
    "documents_meta": ("part", {
        "url": "concat('https://plans.example/', CAST(p_partkey % 1500 AS VARCHAR(20)))",
        "file": "concat('files/', CAST(p_partkey AS VARCHAR(20)), '.pdf')",
        "ordinal": "p_partkey",
        "application": "p_brand",
        "title": case("p_size % 18", TITLES),
        "role": case("p_size % 18", ROLES),
        "bytes": "CAST(floor(p_retailprice) AS BIGINT)",
        "pages": "CAST(p_size % 30 AS INT)",
    }),
    "applications": ("customer", {
        "application": "concat('A', CAST(c_custkey AS VARCHAR(20)))",
        "url": "concat('https://plans.example/', CAST(c_custkey * 3 AS VARCHAR(20)))",
        "file": "concat('files/', CAST(c_custkey * 2 AS VARCHAR(20)), '.pdf')",
        "ordinal": "c_custkey",
        "status": case("c_custkey % 8", STATUSES),
    }),
    "georef": ("lineitem", {
        "application": "l_orderkey",
        "document": "l_suppkey % 5",
        "rank": "l_linenumber",
        "lon": "CAST(-1.9 AS DOUBLE) + (l_partkey % 400) * CAST(0.00001 AS DOUBLE)",
        "lat": "CAST(52.98 AS DOUBLE) + (l_suppkey % 7) * CAST(0.00002 AS DOUBLE)",
        "confidence": "CAST(0.5 AS DOUBLE) + l_quantity / CAST(100 AS DOUBLE)",
        "f1": "1 - l_discount",
        "ordinal": "CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate) AS BIGINT)",
    }),
    "controls": ("lineitem", {
        "candidate": "l_suppkey",
        "x": "CAST(l_partkey % 400 AS DOUBLE)",
        "y": "l_quantity * 8",
        "lon": "CAST(-1.9 AS DOUBLE) + (l_partkey % 400) * CAST(0.00001 AS DOUBLE) + l_quantity * CAST(0.000002 AS DOUBLE) + l_discount * CAST(0.00001 AS DOUBLE)",
        "lat": "CAST(52.98 AS DOUBLE) + l_quantity * CAST(0.00003 AS DOUBLE) - l_tax * CAST(0.00001 AS DOUBLE)",
    }),
    "placements": ("lineitem", {
        "page": "l_suppkey",
        "ordinal": "l_orderkey * 1000 + CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate) AS BIGINT)",
        "precision": "1 - l_discount * 4",
        "recall": "1 - l_tax * 5",
        "x": "CAST(l_partkey % 400 AS DOUBLE)",
        "y": "l_quantity * 8",
        "angle": "CAST(l_orderkey % 4 AS BIGINT)",
        "cost": "CAST(l_orderkey * 7 % 1000 AS DOUBLE) / 8",
        "scale": "CAST(1 + l_linenumber % 3 AS DOUBLE) / 4",
        "shift": "CAST(l_partkey % 90 AS DOUBLE)",
        "offset_m": "CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_partkey % 1500 AS DOUBLE) END",
    }),
    "pages_gate": ("orders", {
        "page": "o_orderkey",
        "status": case("o_orderkey % 8", STATUSES),
        "confidence": "CAST(0.8 AS DOUBLE) + (o_orderkey % 20) / CAST(100 AS DOUBLE)",
        "offset_m": "CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE CAST(o_custkey % 50 AS DOUBLE) END",
        "direct": "o_orderkey % 6 = 0",
        "west": "CAST(o_custkey % 100 AS DOUBLE) / 10 - 9",
        "south": "CAST(o_custkey % 70 AS DOUBLE) / 10 - 6",
        "size": "CAST(1 + o_orderkey % 10 AS DOUBLE)",
    }),
    "tilted": ("orders", {
        "page": "o_orderkey",
        "status": case("o_orderkey % 8", STATUSES),
        "confidence": "CAST(0.8 AS DOUBLE) + (o_orderkey % 20) / CAST(100 AS DOUBLE)",
        "offset_m": "CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE CAST(o_custkey % 50 AS DOUBLE) END",
        "direct": "o_orderkey % 6 = 0",
        "width": "CAST(100 + o_custkey % 900 AS DOUBLE)",
        "height": "CASE WHEN o_custkey % 23 = 0 THEN NULL ELSE CAST(100 + o_custkey * 3 % 700 AS DOUBLE) END",
        "lon_x": "cos(CAST(o_orderkey % 360 AS DOUBLE)) / 100",
        "lon_y": "sin(CAST(o_orderkey % 360 AS DOUBLE)) / 100 + CAST(o_custkey % 5 AS DOUBLE) / 1000",
        "lon_0": "CAST(o_custkey % 140 AS DOUBLE) / 10 - 7",
        "lat_x": "sin(CAST(o_orderkey % 360 AS DOUBLE)) / 120",
        "lat_y": "-cos(CAST(o_orderkey % 360 AS DOUBLE)) / 120",
        "lat_0": "CAST(o_orderkey % 130 AS DOUBLE) / 10 - 6",
    }),
    "grid_lines": ("lineitem", {
        "page": "l_suppkey",
        "x": "CAST(l_partkey % 400 AS DOUBLE)",
        "y": "l_quantity * 8",
        "east": "405800 + l_partkey * 7 % 3400",
        "north": "341000 + l_orderkey * 11 % 4000",
        "text": "CASE l_linenumber % 4 WHEN 0 THEN concat('E ', CAST(405800 + l_partkey * 7 % 3400 AS VARCHAR(20)), ' N ', CAST(341000 + l_orderkey * 11 % 4000 AS VARCHAR(20))) WHEN 1 THEN concat(CAST(405800 + l_partkey * 7 % 3400 AS VARCHAR(20)), ', ', CAST(341000 + l_orderkey * 11 % 4000 AS VARCHAR(20))) WHEN 2 THEN 'sheet 1 of 3' ELSE NULL END",
    }),
    "strokes": ("lineitem", {
        "page": "l_suppkey",
        "x": "l_partkey * 7 % 60",
        "y": "CAST(l_quantity AS BIGINT)",
    }),
    "strips": ("orders", {
        "page": "o_custkey % 40",
        "thick": "CAST(1 + o_orderkey % 2 AS INT)",
        "x0": "o_orderkey * 13 % 380 - 40",
        "y0": "o_orderkey * 29 % 380 - 40",
        "x1": "CASE WHEN o_orderkey % 10 = 0 THEN o_orderkey * 13 % 380 - 40 ELSE o_custkey * 31 % 420 - 60 END",
        "y1": "CASE WHEN o_orderkey % 20 = 0 THEN o_orderkey * 29 % 380 - 40 ELSE o_custkey * 17 % 420 - 60 END",
    }),
    "grid_points": ("orders", {
        "id": "o_orderkey",
        "east": "CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE CAST(90000 + o_orderkey * 131 % 560000 AS DOUBLE) + CAST(o_custkey % 100 AS DOUBLE) / 100 END",
        "north": "CAST(10000 + o_custkey * 977 % 1200000 AS DOUBLE) + CAST(o_orderkey % 100 AS DOUBLE) / 100",
    }),
    "stages": ("events", {
        "page": "event_id",
        "failed": "event_type = 'error'",
        "stage": case("user_id % 4", ["render", "semantics", "registration", "vectorize"]),
        "engine": case("user_id % 5", ["pdftotext-bbox", "tesseract", "tesseract-fallback", "pdftotext-layout", None]),
        "renderer": case("user_id % 3", ["pdftoppm", "image", None]),
        "dpi": "CASE user_id % 3 WHEN 0 THEN 240 WHEN 1 THEN 157 ELSE NULL END",
        "adaptive": "user_id % 3 = 1",
        "millis": "value",
    }),
    "bridge_input": ("events", {
        "id": "event_id",
        "feature_class": case("event_id % 13", CLASSES),
        "source": "CASE WHEN user_id % 10 = 0 THEN 'osm' ELSE 'Planning' END",
        "authority": "CASE user_id % 7 WHEN 0 THEN false WHEN 1 THEN NULL ELSE true END",
        "renderable": "user_id % 11 = 0",
    }),
    "vectors": ("orders", {
        "id": "o_orderkey",
        "role": case("o_orderkey % 13", [*R.ROLE_FEATURE_CLASS, "unknown-role", None]),
        "geometry": "CASE WHEN o_custkey % 12 = 0 THEN NULL ELSE concat('LINE ', CAST(o_custkey AS VARCHAR(20))) END",
        "application": "CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_orderpriority END",
        "status": case("o_orderkey % 8", STATUSES),
    }),
    "anchors": ("conversations", {
        "page": "conv_id",
        "id": "turn",
        "is_anchor": "role = 'assistant'",
        "x": "CAST(length(text) % 500 AS DOUBLE)",
        "y": "CAST(turn * 40 AS DOUBLE)",
        "confidence": "CAST(length(text) % 10 AS DOUBLE) / 10",
        "label": case("length(text) % 14", LABELS),
    }),
    "labels_text": ("orders", {
        "id": "o_orderkey",
        "text": case("o_orderkey % 14", LABELS),
        "title": case("o_orderkey % 18", TITLES),
        "coordinates": case("o_orderkey % 9", COORDINATES),
        "dpi": "CASE WHEN o_orderkey % 4 = 0 THEN 150 ELSE 240 END",
        "width": "CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE CAST(800 + o_custkey * 7 % 3000 AS DOUBLE) END",
        "height": "CAST(600 + o_custkey * 3 % 2500 AS DOUBLE)",
    }),
    "osm": ("supplier", {
        "id": "s_suppkey",
        "building": "CASE WHEN s_suppkey % 7 = 0 THEN 'yes' WHEN s_suppkey % 7 = 1 THEN '' END",
        "highway": "CASE WHEN s_suppkey % 5 = 0 THEN 'footway' END",
        "barrier": case("s_suppkey % 6", ["wall", "fence", "bollard", None, None, None]),
        "natural_": case("s_suppkey % 4", ["water", "rock", "scree", None]),
        "attraction": "CASE WHEN s_suppkey % 3 = 0 THEN 'roller_coaster' END",
    }),
    "fetches": ("events", {
        "id": "event_id",
        "age_ms": "CASE WHEN user_id % 6 = 0 THEN NULL ELSE event_id * 997 % 200000000 END",
        "http_status": "CASE event_id % 7 WHEN 0 THEN 304 WHEN 1 THEN 500 WHEN 2 THEN 404 WHEN 3 THEN NULL ELSE 200 END",
    }),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, columns = VIEWS[name]
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").selectExpr(*(f"{e} AS {c}" for c, e in columns.items()))


def view_sql(name: str) -> str:
    table, columns = VIEWS[name]
    return "SELECT " + ", ".join(f"{e} AS {c}" for c, e in columns.items()) + f" FROM {table}"


def with_views(*names: str) -> str:
    """A WITH clause of views, each under its own name."""
    return "WITH " + ", ".join(f"{n} AS ({view_sql(n)})" for n in names)
