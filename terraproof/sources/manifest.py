"""Manifests of documents: reading, checking, ingest in processing order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraproof.operators import documents

CONTROL = "STRUCT<x: DOUBLE, y: DOUBLE, longitude: DOUBLE, latitude: DOUBLE, page: INT>"
DOCUMENT = f"STRUCT<url: STRING, file: STRING, title: STRING, text: STRING, role: STRING, explicitControlPoints: ARRAY<{CONTROL}>>"
MANIFEST = (
    "schemaVersion INT, status STRING, generatedAt STRING, liveApplications INT, documentsDownloaded INT, "
    f"applications ARRAY<STRUCT<reference: STRING, status: STRING, longitude: DOUBLE, latitude: DOUBLE, failure: STRING, downloadedDocuments: ARRAY<{DOCUMENT}>>>, "
    "entries ARRAY<STRUCT<kind: STRING, url: STRING, file: STRING, bytes: BIGINT, sha256: STRING, mime: STRING>>"
)
SHAPE_ERROR = "manifest shape or counts are wrong"
MOST_DOCUMENTS = 1200


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per manifest file."""
    return spark.read.schema(MANIFEST).json(path, multiLine=True)


def _documents() -> Column:
    return F.filter("entries", lambda e: e["kind"] == "document")


def checked(manifest: DataFrame, most: int = MOST_DOCUMENTS) -> DataFrame:
    """The usable manifests; disabled ones fall away.

    A wrong version or status fails the job, and so do counts that the lists do not bear out (applications without a
    failure, different urls of documents) and more documents than ``most``.
    """
    live = F.filter("applications", lambda a: a.isNotNull() & a["failure"].isNull())
    references = F.array_compact(F.array_distinct(F.transform(live, lambda a: a["reference"])))
    urls = F.array_distinct(F.transform(_documents(), lambda e: F.coalesce(e["url"], F.lit(""))))
    shape = (F.col("schemaVersion") == 1) & F.col("status").isin("usable", "disabled") & F.col("entries").isNotNull() & F.col("applications").isNotNull()
    counts = (F.col("liveApplications") == F.size(live)) & (F.col("documentsDownloaded") == F.size(urls)) & (F.size(references) <= F.col("liveApplications"))
    sound = lambda c: F.coalesce(c, F.lit(False))
    fail = lambda why: F.raise_error(why).cast("string")
    crowd = F.size(_documents())
    status = (
        F.when(~sound(shape), fail(F.lit(SHAPE_ERROR))).when(F.col("status") == "disabled", F.col("status")).when(~sound(counts), fail(F.lit(SHAPE_ERROR)))
        .when(crowd > most, fail(F.concat(F.lit("document ceiling exceeded: "), crowd.cast("string")))).otherwise(F.col("status"))
    )
    return manifest.withColumn("status", status).filter("status = 'usable'")


def entries_of(manifest: DataFrame, most: int = MOST_DOCUMENTS) -> DataFrame:
    """Entries of documents with their place in the manifest; other kinds are passed over."""
    rows = checked(manifest, most).select("schemaVersion", "status", F.posexplode("entries").alias("ordinal", "e"))
    return rows.filter(F.col("e.kind") == "document").select("ordinal", "schemaVersion", "status", "e.*")


def metadata_of(manifest: DataFrame) -> DataFrame:
    """What applications say of their documents, in order of application and document."""
    usable = manifest.filter("status = 'usable'")  # entries_of checks the rest
    apps = usable.select(F.posexplode("applications").alias("i", "a"))
    docs = apps.select("i", "a", F.posexplode_outer("a.downloadedDocuments").alias("k", "d"))
    return docs.select(
        (F.col("i") * F.lit(1 << 20) + F.coalesce("k", F.lit(0))).cast("long").alias("ordinal"), F.col("d.url").alias("url"), F.col("d.file").alias("file"), F.col("a.reference").alias("application"),
        F.col("a.status").alias("status"), F.col("a.longitude").alias("longitude"), F.col("a.latitude").alias("latitude"), F.concat_ws(" ", "d.title", "d.text").alias("title"), F.col("d.role").alias("role"), F.col("d.explicitControlPoints").alias("controls"),
    )


def conflicts(entries: DataFrame) -> DataFrame:
    """Urls that occur with differing content."""
    return entries.groupBy("url").agg(F.count_distinct("sha256", "bytes").alias("n")).filter("n > 1")


def without_conflicts(entries: DataFrame) -> DataFrame:
    """The first entry (ordinal, url, sha256, bytes, ...) of each url; a url with differing content fails the job."""
    others = [c for c in entries.columns if c != "url"]
    differs = (F.min("sha256") != F.max("sha256")) | (F.min("bytes") != F.max("bytes"))
    first = entries.groupBy("url").agg(F.min_by(F.struct(*others), "ordinal").alias("r"), F.coalesce(differs, F.lit(False)).alias("differs"))
    url = F.when(F.col("differs"), F.raise_error(F.concat(F.lit("conflicting duplicate url: "), "url")).cast("string")).otherwise(F.col("url"))
    return first.select(url.alias("url"), "r.*")


def ingest(manifest: DataFrame, most: int = MOST_DOCUMENTS) -> DataFrame:
    """Documents in processing order: broken or conflicting entries fail the job, metadata by url else file, classified."""
    entries = entries_of(manifest, most)
    broken = documents.broken_rule()
    url = F.when(broken.isNull(), F.col("url")).otherwise(F.raise_error(F.concat(F.lit("manifest entry: "), broken)).cast("string"))
    first = without_conflicts(entries.withColumn("url", url))
    meta = metadata_of(manifest)
    side = lambda key, name: documents.dedupe_first(meta.filter(F.col(key).isNotNull()), key, "ordinal").select(F.col(key).alias(f"{name}_key"), F.struct("application", "status", "longitude", "latitude", "title", "role", "controls").alias(name))
    by_url, by_file = side("url", "u"), side("file", "f")
    found = first.join(by_url, first["url"] == by_url["u_key"], "left").join(by_file, first["file"] == by_file["f_key"], "left").withColumn("m", F.coalesce("u", "f"))
    rows = found.select("ordinal", first["url"], first["file"], "bytes", "sha256", "mime", "m.*")
    return documents.geometry_first(documents.classify(rows))


def prepare(ingested: DataFrame, limit: int = 500, page_cap: int = 12) -> DataFrame:
    """One row per page to process: no narratives, the first documents, pages by a column ``pages`` if there is one."""
    kept = documents.geometry_first(ingested.filter("NOT narrative"), limit)
    pages = kept if "pages" in kept.columns else kept.withColumn("pages", F.lit(1))
    return documents.expand_pages(pages, page_cap)


def adapter(spark: SparkSession, folder: str, most: int = MOST_DOCUMENTS) -> dict:
    """A reader of the folder's manifest for ``catalog.acquire``, by its source's name."""
    return {"planning": lambda: ingest(read_manifest(spark, f"{folder}/manifest.json"), most)}
