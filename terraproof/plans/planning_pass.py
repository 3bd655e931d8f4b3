"""The planning pass: from a manifest and extracted tables to accepted features and a report.

Rendering, text extraction and registration come as tables keyed by content, since their tools are not part of this
engine; each of those stages is a function from the pages that lack a result to results (``ResultStore``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraproof.functions.text import content_key
from terraproof.operators import evidence, georef, matching

VERSIONS = {"render": "render-v1", "semantic": "semantic-v1", "georeference": "strong-georef-v3-null-safe-geofence", "registration": "registration-v1", "vector": "vector-v1"}
LEGACY_GEOREFERENCE = ("strong-georef-v1", "strong-georef-v2-null-safe")


def stage_keys(pages: DataFrame, bbox: str, dpi: int = 240) -> DataFrame:
    """Adds the content key of each stage to (sha256, page, page_sha256, semantic_hash, reference_hash, transform_hash)."""
    version = lambda k: F.lit(VERSIONS[k]).alias("version")
    box = F.lit(bbox).alias("bbox")
    return pages.withColumns({
        "render_key": content_key("planning-render", F.lit(dpi).alias("dpi"), F.col("page"), F.col("sha256"), version("render")),
        "semantic_key": content_key("planning-semantic", F.col("page_sha256"), version("semantic")),
        "georeference_key": content_key("planning-strong-georeference", box, F.col("page"), F.col("page_sha256"), F.col("semantic_hash"), F.col("sha256"), version("georeference")),
        "registration_key": content_key("planning-registration", box, F.col("page_sha256"), F.col("reference_hash"), version("registration")),
        "vector_key": content_key("planning-vector", F.col("page_sha256"), F.col("semantic_hash"), F.col("transform_hash"), version("vector")),
    })


def georeference_version(version: str | None) -> str:
    """Older versions did not tell requests for different boxes apart, so they count as the present one."""
    return VERSIONS["georeference"] if version is None or version in LEGACY_GEOREFERENCE else version


def select_pages(direct: DataFrame, candidates: DataFrame) -> DataFrame:
    """Registrations to use: direct ones (document, page, score), else members of an accepted consensus of candidates."""
    _, members = georef.consensus(georef.variants(candidates))
    scored = candidates.withColumn("score", georef.variant_score(F.col("confidence"), F.col("f1"), F.lit(None).cast("double"), F.lit(None).cast("double")))
    agreed = members.join(scored.select("application", "document", "ordinal", "page", "score"), ["application", "document", "ordinal"])
    return georef.choose_registrations(direct.select("document", "page", "score"), agreed.select("document", "page", "score"))


def accept_features(vectors: DataFrame, reference: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted features, judgements) of planning vectors (id, role, form, points, geometry, name, confidence, application, status)."""
    named = evidence.normalize_vectors(vectors).filter("withheld_reason IS NULL")
    planning = named.select("id", F.col("feature_class").alias("kind"), "name", "form", "points", "confidence", F.col("application_status").alias("status"), "eligible")
    judged = matching.match_and_judge(planning, reference)
    accepted = planning.join(judged.filter("accepted").select("id", "action", "target"), "id").withColumns({"source": F.lit("planning"), "authority": F.lit(True), "renderable": F.lit(False)})
    return accepted, judged


def report(judged: DataFrame) -> DataFrame:
    """Counts by action, and of rejections by reason, as one row of maps."""
    actions, reasons = matching.authority_actions(judged), matching.rejection_reasons(judged)
    both = actions.select(F.lit(0).alias("part"), F.col("action").alias("name"), "n").unionByName(reasons.select(F.lit(1).alias("part"), F.col("reason").alias("name"), "n"))
    named = lambda part: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("part") == part, F.struct("name", "n")))))
    return both.agg(named(0).alias("actions"), named(1).alias("rejections"))
