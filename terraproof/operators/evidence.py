"""Competing evidence: one winner per real-world feature, and checks of the decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraproof.functions import rules as R
from terraproof.functions.text import first_case


def source_rank(source: Column) -> Column:
    key = F.lower(F.trim(F.coalesce(source, F.lit("unknown"))))
    return first_case([(key == s, F.lit(n)) for s, n in R.SOURCE_RANK.items()], F.lit(0))


def planning_eligible(source: Column, flag: Column) -> Column:
    """Planning evidence counts unless its flag is exactly false."""
    return (F.lower(F.trim(F.coalesce(source, F.lit("unknown")))) == "planning") & F.coalesce(flag, F.lit(True))


def resolve_evidence(features: DataFrame) -> DataFrame:
    """One decision per authority_key of (authority_key, feature_class, source, confidence, eligible, ordinal).

    Locked classes with eligible planning evidence take only that; else ineligible planning stands back unless nothing
    else is there. Rank, then confidence, then order decide. Partial minima travel, not rows, so a hot key costs one
    row per map task.
    """
    rated = features.withColumns({
        "source": F.lower(F.trim(F.coalesce("source", F.lit("unknown")))),
        "confidence": F.when(F.isnan("confidence"), 0.0).otherwise(F.coalesce("confidence", F.lit(0.0))),
    })
    planning, good = F.col("source") == "planning", planning_eligible(F.col("source"), F.col("eligible"))
    best = F.struct((-source_rank(F.col("source"))).alias("rank"), (-F.col("confidence")).alias("negative"), "ordinal", "source", "confidence")
    groups = rated.groupBy("authority_key").agg(
        F.min(F.struct("ordinal", F.lower(F.trim(F.coalesce("feature_class", F.lit("unknown")))).alias("c"))).alias("head"),
        F.count_if(planning).alias("planning_evidence_count"), F.count_if(good).alias("eligible_planning_count"), F.count(F.lit(1)).alias("candidate_count"),
        F.min(F.when(good, best)).alias("of_good"), F.min(F.when(~planning | good, best)).alias("of_pool"), F.min(best).alias("of_all"),
    )
    locked = F.col("head.c").isin(*R.LOCKED_CLASSES) & (F.col("eligible_planning_count") > 0)
    winner = F.coalesce(F.when(locked, F.col("of_good")), F.col("of_pool"), F.col("of_all"))
    return groups.select(
        "authority_key", F.col("head.c").alias("feature_class"), winner["source"].alias("winner_source"), winner["ordinal"].alias("winner_ordinal"), winner["confidence"].alias("winner_confidence"),
        locked.alias("planning_locked"), "planning_evidence_count", "eligible_planning_count", "candidate_count",
    )


def authority_violations(features: DataFrame, decisions: DataFrame) -> DataFrame:
    """Decisions of locked classes that passed eligible planning evidence over."""
    planned = features.filter(planning_eligible(F.col("source"), F.col("eligible"))).select("authority_key").distinct()
    return decisions.filter(F.col("feature_class").isin(*R.LOCKED_CLASSES) & (F.col("winner_source") != "planning")).join(planned, "authority_key", "left_semi").select("authority_key", "feature_class", "winner_source")


def page_gate(pages: DataFrame) -> DataFrame:
    """Adds accepted, mode and reasons to (status, confidence, overlap, offset_m, direct)."""
    from terraproof.functions.text import normal_status, status_eligible

    given = F.trim(F.coalesce("status", F.lit(""))) != ""
    confidence = F.coalesce("confidence", F.lit(0.0))
    heuristic = ~F.coalesce("direct", F.lit(False))
    tests = [
        (given & ~status_eligible(F.col("status")), "application-status-not-world-authority-eligible"),
        (confidence < R.MIN_CONFIDENCE, "confidence-below-authority-gate"),
        (F.col("overlap").isNull(), "build-geofence-overlap-unavailable"),
        (F.col("overlap") < R.MIN_OVERLAP, "build-geofence-overlap-below-authority-gate"),
        (heuristic & F.col("offset_m").isNull(), "registration-offset-unavailable"),
        (heuristic & (F.col("offset_m") > R.MAX_OFFSET_M), "registration-offset-above-authority-gate"),
    ]
    reasons = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(r)) for c, r in tests)))
    out = pages.withColumn("application_status", F.when(given, normal_status(F.col("status")))).withColumn("reasons", reasons)
    return out.withColumns({"accepted": F.size("reasons") == 0, "mode": F.when(heuristic, "visual-registration").otherwise("strong-georeference")})


def bridge(features: DataFrame) -> DataFrame:
    """Adds disposition (passed, withheld, refused) and its reason to (feature_class, source, authority, renderable)."""
    kind = F.lower(F.trim(F.coalesce("feature_class", F.lit(""))))
    withheld = first_case([(kind == c, F.lit(r)) for c, r in R.BRIDGE_WITHHELD.items()], F.lit(None).cast("string"))
    refused = (
        F.when(F.lower(F.coalesce("source", F.lit(""))) != "planning", "non-planning-feature")
        .when(F.coalesce("renderable", F.lit(False)), "reference-renderable-feature")
        .when(~F.coalesce("authority", F.lit(False)), "final-authority-missing")
        .when(~kind.isin(*R.BRIDGE_CLASSES) & withheld.isNull(), "unreviewed-class")
    )
    disposition = F.when(refused.isNotNull(), "refused").when(withheld.isNotNull(), "withheld").otherwise("passed")
    return features.withColumns({"disposition": disposition, "reason": F.coalesce(refused, withheld)})


def assert_bridge(features: DataFrame) -> DataFrame:
    """As ``bridge``, but a refused feature fails the job."""
    judged = bridge(features)
    ok = F.when(F.col("disposition") == "refused", F.raise_error(F.concat(F.lit("bridge refuses a feature: "), F.col("reason")))).otherwise(F.col("disposition"))
    return judged.withColumn("disposition", ok.cast("string"))


def bridge_totals(features: DataFrame) -> DataFrame:
    """One row (input, passed, withheld); fails if there are features and none of them passes, or if one is refused."""
    n = assert_bridge(features).agg(F.count(F.lit(1)).alias("input"), F.count_if(F.col("disposition") == "passed").alias("passed"), F.count_if(F.col("disposition") == "withheld").alias("withheld"))
    empty = (F.col("input") > 0) & (F.col("passed") == 0)
    return n.select(F.when(empty, F.raise_error(F.lit("bridge withholds every feature"))).otherwise(F.col("input")).cast("long").alias("input"), "passed", "withheld")


BRIDGE_SCHEMA = 1


def bridge_report(features: DataFrame) -> DataFrame:
    """One row about a bridge: counts, maps of counts by class, digests of what goes in and what comes out.

    Digests do not depend on the order of rows or fields. Fails as ``bridge_totals`` does.
    """
    from terraproof.functions.canonical import rows_digest

    columns = tuple(features.columns)
    judged = assert_bridge(features).withColumn("_class", F.lower(F.trim(F.coalesce("feature_class", F.lit("")))))
    counts = judged.groupBy("_class").agg(F.count(F.lit(1)).alias("i"), F.count_if(F.col("disposition") == "passed").alias("o"), F.count_if(F.col("disposition") == "withheld").alias("w"))
    by_class = lambda c: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col(c) > 0, F.struct("_class", c)))))
    sums = counts.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("i", "input"), ("o", "passed"), ("w", "withheld"))), *(by_class(c).alias(n) for c, n in (("i", "input_by_class"), ("o", "passed_by_class"), ("w", "withheld_by_class"))))
    checked = F.when((F.col("input") > 0) & (F.col("passed") == 0), F.raise_error(F.lit("bridge withholds every feature")).cast("long")).otherwise(F.col("input"))
    came, went = rows_digest(features).select(F.col("digest").alias("input_sha256")), rows_digest(judged.filter("disposition = 'passed'"), columns=columns).select(F.col("digest").alias("output_sha256"))
    one = sums.withColumns({"schema_version": F.lit(BRIDGE_SCHEMA), "input": checked})
    return one.crossJoin(came).crossJoin(went)  # three single rows


def withheld_rows(features: DataFrame) -> DataFrame:
    """The features that a bridge withholds, each with its reason."""
    return assert_bridge(features).filter("disposition = 'withheld'").drop("disposition")


def normalize_vectors(vectors: DataFrame) -> DataFrame:
    """Planning features of (role, geometry, confidence, application, status), withheld rows with their reason."""
    from terraproof.functions.text import normal_status, role_feature_class, status_eligible, status_reason

    role = F.lower(F.trim(F.coalesce("role", F.lit(""))))
    kind = role_feature_class(role)
    given = F.trim(F.coalesce("status", F.lit(""))) != ""
    digest = F.substring(F.sha2(F.concat(role, F.lit("|"), F.coalesce("geometry", F.lit(""))), 256), 1, 20)
    return vectors.withColumns({
        "feature_class": kind,
        "withheld_reason": F.when(kind.isNull(), "unsupported-planning-role").when(F.col("geometry").isNull(), "missing-geometry"),
        "authority_key": F.when(kind.isNotNull() & F.col("geometry").isNotNull(), F.concat_ws(":", kind, F.coalesce("application", F.lit("unknown")), digest)),
        "application_status": F.when(given, normal_status(F.col("status"))),
        "eligible": ~given | status_eligible(F.col("status")),
        "authority_reason": F.when(given, status_reason(F.col("status"))).otherwise("application-status-not-provided-legacy"),
    })
