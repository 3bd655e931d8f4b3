"""Download of declared files in rounds: addresses in rotation, what is broken is never tried again.

What goes over the wire is a function from attempts to attempts with an answer, so that a table can stand for it;
``over`` makes one from an opener. Each step's answers are written before they are judged, so that nothing is fetched twice
when a task is repeated later.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terraproof.functions.text import host
from terraproof.operators.state import shared_folder, written

# The way in which an http address of a planning host is declared, errors after which a download is tried again.
LEGACY = "legacy-http-official-host"
TRY_AGAIN = ("ABORT_ERR", "ECONNRESET", "ECONNREFUSED", "EAI_AGAIN", "ENETUNREACH", "ETIMEDOUT", "UND_ERR_CONNECT_TIMEOUT", "UND_ERR_HEADERS_TIMEOUT", "UND_ERR_SOCKET")
ANSWER = "http_status int, final_url string, declared_length long, real_bytes long, real_sha256 string, error string, content binary"

Transport = Callable[[DataFrame], DataFrame]


@dataclass
class Response:
    """What an opener gives: a status, headers by lower-case name, the body in pieces, the address after redirects."""

    status: int
    headers: dict[str, str] = field(default_factory=dict)
    body: Iterable[bytes] | None = None
    url: str | None = None


class Unreachable(Exception):
    """No answer; ``code`` says why."""

    def __init__(self, code: str, message: str = ""):
        super().__init__(message or code)
        self.code = code


def addresses(allow_legacy: bool) -> Column:
    """The addresses of an entry (url, transport_url, tls_verification) in the order of the first round; null unless url is https."""
    primary, other = F.col("url"), F.nullif(F.col("transport_url"), F.col("url"))
    legacy = F.lit(allow_legacy) & other.rlike("(?i)^http://") & (host(other) == host(primary)) & F.coalesce(F.col("tls_verification") == LEGACY, F.lit(False))
    return F.when(primary.rlike("(?i)^https://[^/]"), F.when(F.coalesce(legacy, F.lit(False)), F.array(other, primary)).when(F.coalesce(other.rlike("(?i)^https://"), F.lit(False)), F.array(primary, other)).otherwise(F.array(primary)))


def fault(allow_legacy: bool) -> Column:
    """What is wrong with an answered attempt, as struct (code, again); null if the file is as declared."""
    status, final = F.col("http_status"), F.coalesce("final_url", "address")
    safe = final.rlike("(?i)^https://") | (F.lit(allow_legacy) & F.col("address").rlike("(?i)^http://") & final.rlike("(?i)^http://") & (host(final) == host(F.col("url"))))
    of = lambda code, again: F.struct((F.lit(code) if isinstance(code, str) else code).alias("code"), (F.lit(again) if isinstance(again, bool) else again).alias("again"))
    return (
        F.when(F.col("error").isNotNull(), of(F.col("error"), F.upper("error").isin(*TRY_AGAIN)))
        .when(~F.coalesce(status.between(200, 299), F.lit(False)), of(F.concat(F.lit("HTTP_"), F.coalesce(status.cast("string"), F.lit("UNKNOWN"))), F.coalesce(status.isin(408, 425, 429) | (status >= 500), F.lit(False))))
        .when(~safe, of("UNSAFE_REDIRECT", False))
        .when(F.col("declared_length") > F.col("bytes"), of("CONTENT_LENGTH_EXCEEDS_MANIFEST", False))
        .when(F.col("real_bytes").isNull(), of("MISSING_RESPONSE_BODY", True))
        .when(F.col("real_bytes") > F.col("bytes"), of("DOWNLOAD_EXCEEDS_MANIFEST", False))
        .when(F.col("real_bytes") != F.col("bytes"), of("DOWNLOAD_BYTES_MISMATCH", False))
        .when(~F.col("real_sha256").eqNullSafe(F.lower("sha256")), of("DOWNLOAD_SHA256_MISMATCH", False))
    )


def over(opener: Callable[[str], Response], keep: bool = True) -> Transport:
    """A transport that opens each address in a task; a body is read no further than one byte past the declared number."""

    def answer(address: str, most: int) -> tuple:
        try:
            r = opener(address)
            length = r.headers.get("content-length")
            declared = int(length) if length and length.isdigit() else None
            if not 200 <= r.status < 300 or r.body is None or (declared or 0) > most:
                return r.status, r.url, declared, None, None, None, None
            parts, n, digest = [], 0, hashlib.sha256()
            for piece in r.body:
                n += len(piece)
                if n > most:
                    return r.status, r.url, declared, n, None, None, None
                digest.update(piece)
                parts.append(piece)
            return r.status, r.url, declared, n, digest.hexdigest(), None, b"".join(parts) if keep else None
        except Unreachable as e:
            return None, None, None, None, None, e.code, None
        except TimeoutError:
            return None, None, None, None, None, "ETIMEDOUT", None
        except ConnectionError:
            return None, None, None, None, None, "ECONNRESET", None
        except Exception as e:
            return None, None, None, None, None, type(e).__name__, None

    def transport(attempts: DataFrame) -> DataFrame:
        answers = StructType.fromDDL(ANSWER)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(len(batch)):  # one file in memory at a time
                    row = batch.slice(k, 1)
                    got = answer(row.column("address")[0].as_py(), row.column("bytes")[0].as_py())
                    types = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary())
                    yield pa.RecordBatch.from_arrays([*row.columns, *(pa.array([v], t) for v, t in zip(got, types, strict=True))], names=[*row.schema.names, *answers.names])

        return attempts.mapInArrow(run, StructType([*attempts.schema, *answers]))

    return transport


def hydrate(entries: DataFrame, transport: Transport, retries: int = 2, allow_legacy: bool = False, files: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(results, contents) of ``entries`` (file, url, transport_url, tls_verification, bytes, sha256), one for each file.

    results: file, status (reused, downloaded, failed), address, attempts, retries_used, code of the last fault. In a round
    every address is tried, beginning one later each round; a fault after which nothing is tried again ends the entry. Files
    that ``files`` (file, content) holds as declared are reused. contents: file, content of what was downloaded, where the
    transport keeps it. Entries that are not declared rightly fail without an attempt.
    """
    spark = entries.sparkSession
    home = shared_folder(spark, "hydrate")
    names = ("file", "url", "transport_url", "tls_verification", "bytes", "sha256")
    rows = entries.select(*names).withColumn("addresses", addresses(allow_legacy))
    declared = F.when(F.col("addresses").isNull(), "URL_NOT_HTTPS").when(~F.coalesce(F.col("bytes") >= 1, F.lit(False)), "INVALID_BYTES").when(~F.coalesce(F.col("sha256").rlike("^[a-fA-F0-9]{64}$"), F.lit(False)), "INVALID_SHA256")
    rows = rows.withColumn("broken", declared)
    if files is not None:
        real = files.select("file", F.length("content").cast("long").alias("_bytes"), F.sha2("content", 256).alias("_sha256"))
        rows = rows.join(real, "file", "left").withColumn("reused", F.coalesce((F.col("_bytes") == F.col("bytes")) & (F.col("_sha256") == F.lower("sha256")), F.lit(False))).drop("_bytes", "_sha256")
    else:
        rows = rows.withColumn("reused", F.lit(False))
    rows = written(rows, f"{home}/entries")
    none = F.lit(None).cast("string")
    status = F.when(F.col("reused"), "reused").otherwise("failed")
    results = rows.filter("reused OR broken IS NOT NULL").select("file", status.alias("status"), none.alias("address"), F.lit(0).alias("attempts"), F.lit(0).alias("retries_used"), F.when(~F.col("reused"), F.col("broken")).alias("code"))
    pending = rows.filter("NOT reused AND broken IS NULL").select(*names, "addresses", F.lit(0).alias("attempts"), none.alias("code"))
    contents = None
    for turn in range(max(0, min(5, retries)) + 1):
        for k in range(2):
            n = F.size("addresses")
            due = pending.filter(n > k).withColumns({"address": F.get("addresses", F.pmod(F.lit(k + turn), n)), "round": F.lit(turn), "attempts": F.col("attempts") + 1})
            tried = transport(due).withColumn("fault", fault(allow_legacy))
            tried = written(tried, f"{home}/tried-{turn}-{k}")
            over_now = F.col("fault").isNull() | ~F.col("fault.again")
            ended = tried.filter(over_now).select("file", F.when(F.col("fault").isNull(), "downloaded").otherwise("failed").alias("status"), "address", "attempts", F.col("round").alias("retries_used"), F.col("fault.code").alias("code"))
            results = results.unionByName(ended)
            if "content" in tried.columns:
                got = tried.filter("fault IS NULL").select("file", "content")
                contents = got if contents is None else contents.unionByName(got)
            still = tried.filter(~over_now).select(*names, "addresses", "attempts", F.col("fault.code").alias("code"))
            pending = still.unionByName(pending.filter(n <= 1)) if k else still
        if pending.isEmpty():
            break
    failed = pending.select("file", F.lit("failed").alias("status"), none.alias("address"), "attempts", F.lit(max(0, min(5, retries))).alias("retries_used"), "code")
    return results.unionByName(failed), contents if contents is not None else spark.createDataFrame([], "file string, content binary")
