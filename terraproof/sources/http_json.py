"""JSON over HTTP as a Python data source: one input partition for each source, with fail-over, cache and fail-open inside.

A request names a source and its addresses in order. Its task takes the first address that is fresh in the cache or
answers; where all fail, the request is a row with status ``unavailable``, also if an answer breaks off half-way. What is
known of the cache goes to the task as times and validators only; payloads stay in the cache table, which Spark reads and
appends to with its own commit protocol.
"""

from __future__ import annotations

import hashlib
import json
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from terraproof.operators.hydrate import Response
from terraproof.operators.state import shared_folder
from terraproof.sources.catalog import FRESH_MS

#: Fixed value: the version that request keys are made for.
ADAPTER_VERSION = 1
MAX_BYTES, TIMEOUT_S = 25 << 20, 25.0
FETCHED = "source string, status string, mode string, request_key string, endpoint string, attempt int, attempted array<string>, error string, fetched_at long, etag string, last_modified string, content_sha256 string, bytes long, payload string"
CACHED = "request_key string, fetched_at long, etag string, last_modified string, content_sha256 string, bytes long, payload string"
Opener = Callable[[str, str, dict, str | None, float], Response]


@dataclass(frozen=True)
class Request:
    source: str
    endpoints: tuple[str, ...]
    method: str = "GET"
    headers: tuple[tuple[str, str], ...] = ()
    body: str | None = None

    def __post_init__(self):
        if not self.endpoints or not all(x.lower().startswith("https://") for x in self.endpoints):
            raise ValueError(f"{self.source}: addresses must use HTTPS")

    def key(self, endpoint: str) -> str:
        """Address of an answer in the cache: a digest of all that the answer depends on, in order of name."""
        headers = sorted((k.lower(), v) for k, v in self.headers)
        said = json.dumps({"adapterVersion": ADAPTER_VERSION, "body": self.body, "headers": headers, "method": self.method.upper(), "url": endpoint}, sort_keys=True)
        namespace = f"http-json-{self.source}"
        return f"{namespace}-{hashlib.sha256(f'{namespace}\0{said}'.encode()).hexdigest()}"


def open_url(url: str, method: str, headers: dict, body: str | None, timeout: float) -> Response:
    """The standard library's client as an opener."""
    sent = urllib.request.Request(url, None if body is None else body.encode(), headers, method=method)
    try:
        r = urllib.request.urlopen(sent, timeout=timeout)  # noqa: S310
    except urllib.error.HTTPError as e:
        return Response(e.code, {k.lower(): v for k, v in e.headers.items()}, None, e.url)
    return Response(r.status, {k.lower(): v for k, v in r.headers.items()}, iter(lambda: r.read(1 << 16), b""), r.url)


@dataclass(frozen=True)
class Rules:
    now: int
    fresh_ms: int = FRESH_MS
    stale_ms: int = 0
    max_bytes: int = MAX_BYTES
    fail_open: bool = True


class Known(InputPartition):
    """A request with what the cache knows of each of its addresses: (fetched_at, etag, last_modified) or None."""

    def __init__(self, request: Request, cached: list[tuple | None]):
        self.request, self.cached = request, cached


def _whole(r: Response, most: int, source: str) -> bytes:
    if int(r.headers.get("content-length") or 0) > most:
        raise ValueError(f"{source}: answer exceeds the byte ceiling")
    parts, n = [], 0
    for piece in r.body or ():
        n += len(piece)
        if n > most:
            raise ValueError(f"{source}: answer exceeds the byte ceiling")
        parts.append(piece)
    return b"".join(parts)


def ask(at: Known, rules: Rules, opener: Opener) -> tuple:
    """One row of FETCHED: the first address that gives something, or unavailable with every address's failure."""
    req, failures = at.request, []
    row = lambda mode, k, held, *made: (req.source, "usable", mode, req.key(req.endpoints[k]), req.endpoints[k], k + 1, list(req.endpoints[: k + 1]), failures[-1] if mode == "stale-if-error" else None, *(held or ()), *made)
    nothing = (None, None, None)
    for k, url in enumerate(req.endpoints):
        held = at.cached[k]
        if held and rules.fresh_ms > 0 and rules.now - held[0] <= rules.fresh_ms:
            return row("fresh", k, held, *nothing)
        headers = {n.lower(): v for n, v in req.headers}
        if held and held[1]:
            headers["if-none-match"] = held[1]
        if held and held[2]:
            headers["if-modified-since"] = held[2]
        try:
            r = opener(url, req.method.upper(), headers, req.body, TIMEOUT_S)
            if r.status == 304 and held:
                return row("revalidated", k, (rules.now, *held[1:]), *nothing)
            if not 200 <= r.status < 300:
                raise ValueError(f"{req.source}: HTTP {r.status}")
            raw = _whole(r, rules.max_bytes, req.source)
            text = raw.decode()
            json.loads(text)
            return row("refreshed" if held else "miss", k, (rules.now, r.headers.get("etag"), r.headers.get("last-modified")), hashlib.sha256(raw).hexdigest(), len(raw), text)
        except Exception as e:
            failures.append(f"{url}: {type(e).__name__}: {e}"[:300])
            if held and 0 <= rules.now - held[0] <= rules.stale_ms:
                return row("stale-if-error", k, held, *nothing)
    said = f"{req.source}: failed across {len(failures)} addresses: " + " | ".join(failures)
    if not rules.fail_open:
        raise RuntimeError(said)
    return (req.source, "unavailable", "unavailable", None, None, len(failures), list(req.endpoints), said, *nothing, *nothing)


def json_source(opener: Opener, name: str = "cached_json") -> type[DataSource]:
    """A data source class that opens addresses with ``opener``; options ``plan`` (requests and what is cached) and ``rules``."""

    class Reader(DataSourceReader):
        def __init__(self, options: dict):
            self.rules = Rules(**json.loads(options["rules"]))
            self.plan = json.loads(options["plan"])

        def partitions(self) -> list[Known]:
            return [Known(Request(**{**r, "endpoints": tuple(r["endpoints"]), "headers": tuple(map(tuple, r["headers"]))}), [c and tuple(c) for c in cached]) for r, cached in self.plan]

        def read(self, partition: Known) -> Iterator[tuple]:
            yield ask(partition, self.rules, opener)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return FETCHED

        def reader(self, schema) -> DataSourceReader:
            return Reader(self.options)

    return Source


def cache_table(spark: SparkSession, path: str) -> DataFrame:
    """The cache's rows; none before the first append."""
    try:
        return spark.read.schema(CACHED).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], CACHED)


def latest(cache: DataFrame, keys: list[str]) -> DataFrame:
    """The newest row of each of some keys."""
    rest = [c for c in cache.columns if c != "request_key"]
    return cache.filter(F.col("request_key").isin(keys)).groupBy("request_key").agg(F.max_by(F.struct(*rest), F.struct("fetched_at", "content_sha256")).alias("r")).select("request_key", "r.*")


def acquire_json(spark: SparkSession, requests: list[Request], cache_path: str, rules: Rules, opener: Opener = open_url) -> DataFrame:
    """One row of FETCHED for each request, each asked once; answers go into the cache at ``cache_path``.

    Ids of sources are unique. The catalogue of sources is small, so the requests and the times and validators of their
    cached answers, at most one row for each address, pass through the driver; payloads do not.
    """
    if len({r.source for r in requests}) != len(requests) or not requests:
        raise ValueError("at least one source, each named once")
    keys = [r.key(x) for r in requests for x in r.endpoints]
    cache = cache_table(spark, cache_path)
    known = {r["request_key"]: [r["fetched_at"], r["etag"], r["last_modified"]] for r in latest(cache.drop("payload"), keys).select("request_key", "fetched_at", "etag", "last_modified").collect()}
    plan = [[asdict(r), [known.get(r.key(x)) for x in r.endpoints]] for r in requests]
    source = json_source(opener)
    spark.dataSource.register(source)
    asked = f"{shared_folder(spark, 'asked')}"
    spark.read.format(source.name()).options(plan=json.dumps(plan), rules=json.dumps(asdict(rules))).load().write.parquet(asked)
    answers = spark.read.schema(FETCHED).parquet(asked)
    held = latest(cache, keys).select("request_key", F.col("content_sha256").alias("_sha256"), F.col("bytes").alias("_bytes"), F.col("payload").alias("_payload"))
    full = answers.join(held, "request_key", "left")
    for c, old in (("content_sha256", "_sha256"), ("bytes", "_bytes"), ("payload", "_payload")):
        full = full.withColumn(c, F.coalesce(c, old))
    full = full.select(*answers.columns)
    result = f"{asked}-result"
    full.write.parquet(result)
    done = spark.read.schema(FETCHED).parquet(result)
    done.filter(F.col("mode").isin("miss", "refreshed", "revalidated")).select(*cache.columns).write.mode("append").parquet(cache_path)
    return done
