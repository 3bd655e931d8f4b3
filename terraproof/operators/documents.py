"""Ingest of document manifests: checks, classification, metadata, deduplication, order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraproof.functions.text import classify_document, rank_attachment, status_eligible, status_reason

MIMES = ("application/pdf", "image/png", "image/jpeg", "image/tiff")


def broken_rule() -> Column:
    """The first rule that a manifest entry (url, file, bytes, sha256, mime) breaks, or null."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return (
        F.when(~text("url").rlike("^https://[^/]+"), "url-not-https")
        .when(text("file").rlike(r"^$|^/|(^|/)\.\.(/|$)"), "file-not-inside")
        .when(~text("mime").isin(*MIMES), "mime-not-allowed")
        .when(F.coalesce(F.col("bytes"), F.lit(-1)) < 0, "bytes-not-counted")
        .when(~text("sha256").rlike("^[a-fA-F0-9]{64}$"), "sha256-malformed")
    )


def manifest_violations(entries: DataFrame) -> DataFrame:
    """The entries that break a rule, with the rule."""
    return entries.withColumn("broken", broken_rule()).filter("broken IS NOT NULL")


def verify_files(entries: DataFrame, files: DataFrame) -> DataFrame:
    """State of each entry (file, bytes, sha256) beside ``binaryFile`` rows (file, content): reused, missing, mismatch."""
    real = files.select("file", F.length("content").cast("long").alias("real_bytes"), F.sha2("content", 256).alias("real_sha256"))
    state = F.when(F.col("real_bytes").isNull(), "missing").when((F.col("real_bytes") == F.col("bytes")) & (F.col("real_sha256") == F.lower("sha256")), "reused").otherwise("mismatch")
    return entries.join(real, "file", "left").withColumn("state", state)


def dedupe_first(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key in the given order; combines before the shuffle."""
    others = [c for c in rows.columns if c not in (key, order)]
    return rows.groupBy(key).agg(F.min_by(F.struct(order, *others), order).alias("r")).select(key, "r.*")


def classify(docs: DataFrame) -> DataFrame:
    """Adds classification, priority and narrative to (title, role)."""
    return docs.withColumn("c", classify_document(F.col("title"), F.col("role"))).select(*docs.columns, "c.*")


def geometry_first(docs: DataFrame, limit: int | None = None) -> DataFrame:
    """Classified documents in processing order: priority, narrative last, application, url."""
    ordered = docs.orderBy(F.desc("priority"), "narrative", "application", "url", "ordinal")
    return ordered.limit(limit) if limit else ordered


def attach_metadata(docs: DataFrame, applications: DataFrame) -> DataFrame:
    """Each document with its application's row, found by url, else by file; of several the first.

    Two equi-joins and a coalesce; a join on either key at once would compare all pairs.
    """
    side = lambda key, name: dedupe_first(applications.filter(F.col(key).isNotNull()).select(key, "ordinal", "application", "status"), key, "ordinal").select(F.col(key).alias(f"{name}_key"), F.struct("application", "status").alias(name))
    by_url, by_file = side("url", "u"), side("file", "f")
    found = docs.join(by_url, docs["url"] == by_url["u_key"], "left").join(by_file, docs["file"] == by_file["f_key"], "left").withColumn("m", F.coalesce("u", "f"))
    return found.select(*(docs[c] for c in docs.columns if c != "application"), F.col("m.application").alias("reference"), F.col("m.status").alias("status"))


def gate_status(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"eligible": status_eligible(F.col("status")), "reason": status_reason(F.col("status"))})


def rank_attachments(rows: DataFrame) -> DataFrame:
    """Adds the attachment rank's fields to (title, row_text, document_type)."""
    return rows.withColumn("a", rank_attachment(F.col("title"), F.col("row_text"), F.col("document_type"))).select(*rows.columns, "a.*")


def select_drawings(ranked: DataFrame, limit: int = 12) -> DataFrame:
    """The drawings to fetch first."""
    return ranked.filter("drawing AND NOT narrative").orderBy(F.desc("ride_layout"), F.desc("proposed"), F.desc("priority"), "image").limit(limit)


def expand_pages(docs: DataFrame, cap: int = 12) -> DataFrame:
    """One row per page to look at: at most ``cap``, itself between 1 and 24."""
    most = max(1, min(24, cap))
    return docs.select("*", F.explode(F.sequence(F.lit(1), F.least(F.lit(most), F.greatest(F.lit(1), F.coalesce("pages", F.lit(1)))))).alias("page"))


def ingest_stats(classified: DataFrame) -> DataFrame:
    return classified.agg(
        F.count(F.lit(1)).alias("documents"), F.sum("bytes").alias("bytes"), F.count_if(F.col("priority") > 0).alias("geometry_first"),
        F.count_if("narrative").alias("narrative"), F.count_distinct("application").alias("applications"),
    )


def replace_in_corpus(corpus: DataFrame, drop: str, replacement: DataFrame, key: str) -> DataFrame:
    """The corpus without the rows that a condition names, and with the replacements not yet in it."""
    kept = corpus.filter(~F.coalesce(F.expr(drop), F.lit(False)))
    return kept.unionByName(replacement.join(kept.select(key), key, "left_anti").select(*corpus.columns))


def valid_artifacts(renders: DataFrame, files: DataFrame) -> DataFrame:
    """``renders`` (path, sha256, bytes, ...) and ``valid``: whether ``files`` (path, length) has the file with the bytes it
    is said to have; without a digest or a path a render is not valid, without bytes any length is."""
    there = files.groupBy("path").agg(F.max("length").alias("_length"))
    known = F.col("path").isNotNull() & (F.coalesce("sha256", F.lit("")) != "") & F.col("_length").isNotNull()
    sized = (F.coalesce("bytes", F.lit(0)) == 0) | (F.col("_length") == F.col("bytes"))
    return renders.join(there, "path", "left").withColumn("valid", known & F.coalesce(sized, F.lit(False))).select(*renders.columns, "valid")


def corpus_counts(corpus: DataFrame) -> DataFrame:
    """What a corpus declares about itself (application, bytes): applications, documents and bytes, to be counted again after a change."""
    return corpus.agg(F.count_distinct("application").alias("live_applications"), F.count(F.lit(1)).alias("documents_downloaded"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"))


def links(pages: DataFrame, base: str = "url", markup: str = "html") -> DataFrame:
    """Anchors of each page in order: (page_id, position, href, text, resolved)."""
    from terraproof.functions.text import decode_html, href, resolve_url

    tags = F.regexp_extract_all(F.coalesce(F.col(markup), F.lit("")), F.lit(r"(?is)<a(?:\s[^>]*)?>.*?</a>"), F.lit(0))
    found = pages.select("page_id", F.col(base).alias("base"), F.posexplode(tags).alias("position", "tag"))
    start = F.regexp_extract("tag", r"(?is)^(<a(?:\s[^>]*)?>)", 1)
    found = found.withColumns({"href": href(start), "text": decode_html(F.col("tag"))})
    return found.select("page_id", "position", "base", "href", "text", resolve_url(F.col("base"), F.col("href")).alias("resolved"))


def navigation(found: DataFrame, text_pattern: str, href_pattern: str, limit: int = 8) -> DataFrame:
    """The first links of each page to documents on the same host, as https, each once."""
    from terraproof.functions.text import has, host

    wanted = (F.col("href") != "") & (has(F.col("text"), text_pattern) | has(F.col("href"), href_pattern)) & (host(F.col("resolved")) == host(F.col("base"))) & F.col("resolved").rlike("(?i)^https?:")
    first = found.filter(wanted).withColumn("canonical", F.regexp_replace("resolved", "(?i)^http:", "https:")).groupBy("page_id", "canonical").agg(F.min(F.struct("position", "text")).alias("f"))
    rank = F.row_number().over(Window.partitionBy("page_id").orderBy("f.position"))
    return first.withColumn("rank", rank).filter(F.col("rank") <= limit).select("page_id", "rank", F.col("canonical").alias("url"), F.col("f.text").alias("text"))


def hydrate_stats(verified: DataFrame) -> DataFrame:
    """Counts and bytes of verified files by state."""
    return verified.agg(
        F.count(F.lit(1)).alias("entries"), F.count_if(F.col("state") == "reused").alias("reused"), F.count_if(F.col("state") == "missing").alias("missing"),
        F.count_if(F.col("state") == "mismatch").alias("mismatch"), F.coalesce(F.sum(F.when(F.col("state") == "reused", F.col("bytes"))), F.lit(0)).alias("reused_bytes"),
    )


def group_applications(docs: DataFrame) -> DataFrame:
    """Applications with their documents in order of ordinal; an application's documents are few."""
    return docs.groupBy("application").agg(F.array_sort(F.collect_list(F.struct("ordinal", "url", "title"))).alias("documents"), F.sum("bytes").alias("bytes"))


def page_candidates(candidates: DataFrame, most: int = 12) -> DataFrame:
    """Registrations that were not rejected (status, method, alternatives): a method for each, and the first alternatives with their rank."""
    ranked = F.transform(F.slice(F.coalesce("alternatives", F.array().cast("array<double>")), 1, most), lambda s, k: F.struct(s.alias("score"), (k + 1).alias("rank")))
    return candidates.filter(F.col("status").isin("accepted", "candidate")).withColumns({"method": F.coalesce("method", F.lit("visual-registration")), "alternatives": ranked})
