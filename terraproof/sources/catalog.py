"""The catalogue of sources, cache modes of fetched sources, and reading with fail-over."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import urlsplit, urlunsplit

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraproof.functions.rules import PHASE_BUDGET_MS, RUN_BUDGET_MS
from terraproof.operators.state import shared_folder, written

# Source and whether its geometry may be rendered in the world.
CATALOG = {
    "planning": True,
    "osm": False,
    "lidar": True,
    "planning-data": True,
    "national-trees-outside-woodland": True,
    "microsoft-buildings": True,
    "os-openmap-local": True,
    "wikidata": True,
    "wikimedia": False,
    "openaerialmap": False,
    "ogc-features": True,
    "arcgis-features": True,
    "geojson": True,
    "licensed-orthophoto": True,
}
FRESH_MS, DAY_MS = 6 * 3600 * 1000, 24 * 3600 * 1000
OVERPASS_SELECTORS = ("highway", "building", "barrier", "natural", "water", "waterway", "landuse", "leisure", "tourism", "attraction", "railway", "man_made")
MAX_BBOX_DEG2 = 0.25


def catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(CATALOG.items()), "source string, renderable boolean")


def missing_sources(spark: SparkSession, available: DataFrame) -> DataFrame:
    """Catalogued sources that ``available`` (source) lacks."""
    return catalog(spark).join(available.select("source").distinct(), "source", "left_anti")


def cache_mode(age_ms: Column, http_status: Column, fresh_ms: int = FRESH_MS, stale_ms: int = 7 * DAY_MS) -> Column:
    """How a request is answered: age of what is cached (null: nothing), status of the response (null: no response)."""
    cached = age_ms.isNotNull()
    ok = F.coalesce(http_status.between(200, 299), F.lit(False))
    return (
        F.when(cached & (age_ms <= fresh_ms), "fresh").when(cached & (http_status == 304), "revalidated").when(ok & cached, "refreshed").when(ok, "miss")
        .when(cached & (age_ms <= stale_ms), "stale-if-error").otherwise("unavailable")
    )


def retryable(http_status: Column) -> Column:
    return http_status.isin(408, 425, 429) | (http_status >= 500)


def first_success(attempts: DataFrame, key: str = "source") -> DataFrame:
    """The first attempt of each source that has a payload, with the number of attempts; else none and unavailable."""
    done = attempts.groupBy(key).agg(F.min_by("payload", F.when(F.col("payload").isNotNull(), F.col("attempt"))).alias("p"), F.min(F.when(F.col("payload").isNotNull(), F.col("attempt"))).alias("attempt"), F.count(F.lit(1)).alias("attempts"))
    return done.select(key, F.when(F.col("attempt").isNotNull(), F.col("p")).alias("payload"), "attempt", "attempts", F.when(F.col("attempt").isNull(), "unavailable").otherwise("ready").alias("status"))


def endpoints(first: str, fallbacks: Iterable[str | None] = ()) -> list[str]:
    """Addresses to try in order, each once; only HTTPS is accepted, hosts are lower-cased, empty ones skipped."""
    if not first:
        raise ValueError("an endpoint is required")
    out: dict[str, None] = {}
    for value in (first, *fallbacks):
        if value:
            url = urlsplit(value.strip())
            if url.scheme.lower() != "https" or not url.hostname:
                raise ValueError(f"endpoint must use HTTPS: {value}")
            out[urlunsplit(("https", url.netloc.lower().removesuffix(":443"), url.path or "/", url.query, url.fragment))] = None
    return list(out)


def overpass_query(bbox: tuple[float, float, float, float], timeout: int = 25) -> str:
    """Query text for the mapped elements in a (south, west, north, east) box of limited size."""
    south, west, north, east = bbox
    if not (south < north and west < east) or (north - south) * (east - west) > MAX_BBOX_DEG2:
        raise ValueError("bbox is empty or too large")
    box = ",".join(f"{v:.7f}" for v in bbox)
    return f"[out:json][timeout:{timeout}];(" + "".join(f'nwr["{k}"]({box});' for k in OVERPASS_SELECTORS) + ");out geom;"


def acquire(spark: SparkSession, readers: dict[str, Callable[[], DataFrame]], fail_open: bool | Iterable[str] = True, lanes: int = 4) -> DataFrame:
    """The union of what the readers give, each row with its source; a reader that fails is an unavailable row.

    Every reader's rows are written to the shared folder by a job of its own, ``lanes`` at a time, so that one that fails
    half-way gives the unavailable row alone, and none of its rows. ``fail_open`` may name the sources that may fail.
    """
    if not readers or not all(re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", x) for x in readers):
        raise ValueError("at least one source, named by letters, digits, dot, underscore and hyphen")
    may_fail = set(readers) if fail_open is True else set(fail_open or ())
    home = shared_folder(spark, "acquire")

    def read(name: str) -> DataFrame:
        try:
            rows = readers[name]().withColumns({"source": F.lit(name), "status": F.lit("ready"), "error": F.lit(None).cast("string")})
            return written(rows, f"{home}/{name}")
        except Exception as e:
            if name not in may_fail:
                raise
            return spark.createDataFrame([(name, "unavailable", str(e)[:200])], "source string, status string, error string")

    with ThreadPoolExecutor(max(1, lanes)) as pool:
        out = list(pool.map(inheritable_thread_target(spark)(read), readers))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out)


def budget(spark: SparkSession, phases: dict[str, int] | None = None, total: int = RUN_BUDGET_MS) -> DataFrame:
    """Sum of the phases' milliseconds and what is left; more than the total is an error."""
    rows = spark.createDataFrame(list((phases or PHASE_BUDGET_MS).items()), "phase string, ms long")
    s = F.sum("ms")
    checked = F.when(s > total, F.raise_error(F.lit("phases exceed the run's budget"))).otherwise(s)
    return rows.agg(F.lit(total).cast("long").alias("total_ms"), checked.cast("long").alias("allocated_ms"), (F.lit(total) - s).cast("long").alias("left_ms"))
