"""The planning pass as one run: stages behind content keys, failing pages as rows, figures of every stage.

A processor is a function from a page's row, as a dict, to its result. Each stage runs it on the pages whose key has no
result in the store, once for each key, and appends what it gives; so a second run over the same pages computes nothing.
``PageError`` makes the page a row with the stage, a code and a message, and later stages pass it over; any other error ends
the run. Figures come from an observation of the rows that a stage computes, not from a second count.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from terraproof.functions.text import content_key
from terraproof.operators import georef
from terraproof.operators.state import shared_folder, written
from terraproof.plans.planning_pass import VERSIONS, accept_features, report

Processor = Callable[[dict], dict]
ALTERNATIVE = "lon: double, lat: double, confidence: double, f1: double"
RESULTS = {
    "render": "sha256 string, width int, height int",
    "semantics": "sha256 string, text string",
    "strong": f"status string, method string, direct boolean, confidence double, f1 double, precision double, recall double, lon double, lat double, alternatives array<struct<{ALTERNATIVE}>>",
    "registration": f"status string, method string, direct boolean, confidence double, f1 double, precision double, recall double, lon double, lat double, alternatives array<struct<{ALTERNATIVE}>>",
    "vector": "vectors array<struct<role: string, confidence: double, form: string, points: array<struct<x: double, y: double>>, name: string>>",
}


class PageError(Exception):
    """One page cannot be worked on; the others can."""

    def __init__(self, message: str, code: str | None = None):
        super().__init__(message)
        self.code = code


@dataclass
class Profile:
    """Calls, failures and milliseconds of each stage, and the pages that found their result in the store."""

    rows: list[tuple] = field(default_factory=list)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "stage string, pages long, hits long, calls long, failures long, total_ms double, max_ms double, avg_ms double")


def _answers(run: Processor, schema: StructType, fail_on_error: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = to_arrow_schema(schema)
        for batch in batches:
            for k in range(len(batch)):
                row = batch.slice(k, 1).to_pylist()[0]
                began, value, code, message = time.perf_counter(), None, None, None
                try:
                    value = run(row)
                except PageError as e:
                    if fail_on_error:
                        raise
                    code, message = e.code, str(e)
                made = {"content_key": row["content_key"], "value": value, "failed": value is None, "code": code, "message": message if value is None else None, "millis": (time.perf_counter() - began) * 1000}
                yield pa.RecordBatch.from_pylist([made], types)

    return each


def run_stage(pages: DataFrame, name: str, key: Column, run: Processor, store: str, home: str, profile: Profile, result: str | None = None, due: Column | None = None, fail_on_error: bool = False) -> DataFrame:
    """``pages`` with the stage's result in a column of its name, null where it is not ``due`` or a page has failed.

    Pages carry ``error``, a struct (stage, code, message). One call is made for each key that is not in the store.
    """
    spark = pages.sparkSession
    value = StructType.fromDDL(result or RESULTS[name])
    path, kept = f"{store}/{name}", StructType([StructField("content_key", pages.select(key.alias("k")).schema["k"].dataType), StructField("value", value)])
    stored = written(_store(spark, path, kept).dropDuplicates(["content_key"]), f"{home}/{name}-stored")
    ready = F.col("error").isNull() & (F.lit(True) if due is None else F.coalesce(due, F.lit(False)))
    keyed = written(pages.withColumn("content_key", F.when(ready, key)), f"{home}/{name}-keyed")
    work = keyed.filter("content_key IS NOT NULL")
    schema = StructType([*kept, *StructType.fromDDL("failed boolean, code string, message string, millis double")])
    lacking = work.join(stored.select("content_key"), "content_key", "left_anti").dropDuplicates(["content_key"])
    seen = Observation(name)
    answers = lacking.mapInArrow(_answers(run, schema, fail_on_error), schema)
    observed = answers.observe(seen, F.count(F.lit(1)).alias("calls"), F.count_if("failed").alias("failures"), F.coalesce(F.sum("millis"), F.lit(0.0)).alias("total"), F.coalesce(F.max("millis"), F.lit(0.0)).alias("most"))
    answers = written(observed, f"{home}/{name}-answers")
    figures = seen.get
    answers.filter("NOT failed").select("content_key", "value").write.mode("append").parquet(path)
    all_values = stored.withColumns({"hit": F.lit(True), "failed": F.lit(False), "code": F.lit(None).cast("string"), "message": F.lit(None).cast("string")}).unionByName(answers.select("content_key", "value", F.lit(False).alias("hit"), "failed", "code", "message"))
    out = keyed.join(all_values, "content_key", "left")
    error = F.when(F.coalesce("failed", F.lit(False)), F.struct(F.lit(name).alias("stage"), "code", "message")).otherwise(F.col("error"))
    out = written(out.withColumns({name: F.col("value"), "error": error}).withColumn("_hit", F.coalesce("hit", F.lit(False))).drop("value", "hit", "failed", "code", "message", "content_key"), f"{home}/{name}")
    counts = out.agg(F.count(F.lit(1)).alias("pages"), F.count_if("_hit").alias("hits")).first()
    calls = figures["calls"]
    profile.rows.append((name, counts["pages"], counts["hits"], calls, figures["failures"], round(figures["total"], 2), round(figures["most"], 2), round(figures["total"] / calls, 2) if calls else 0.0))
    return out.drop("_hit")


def _store(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:  # the folder comes with the first result
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


@dataclass
class Pass:
    """What a run gives. ``pages``: every page with its results or its error; ``selected``: document, page and how it was placed;
    ``features``: accepted ones; ``accepted``: documents with one, by method; ``failures``: counts by stage and code."""

    pages: DataFrame
    selected: DataFrame
    features: DataFrame
    judged: DataFrame | None
    report: DataFrame | None
    accepted: DataFrame
    failures: DataFrame
    consensus: DataFrame
    profile: DataFrame


def best_pages(pages: DataFrame) -> DataFrame:
    """Of each document the page whose registration is direct, then scores best, then comes first."""
    r = lambda c: F.col(f"placed.{c}")
    score = georef.variant_score(r("confidence"), r("f1"), r("precision"), r("recall"))
    usable = pages.filter(r("status").isin("accepted", "candidate") & F.col("error").isNull()).withColumn("score", score)
    order = F.struct((~F.coalesce(r("direct"), F.lit(False))).alias("d"), (-F.col("score")).alias("s"), "page")
    return usable.groupBy("document").agg(F.min_by(F.struct(*usable.columns), order).alias("b")).select("b.*")


def run_pass(documents: DataFrame, processors: dict[str, Processor], store: str, reference: DataFrame | None = None, reference_hash: str | None = None, bbox: str = "", dpi: int = 240, enforce: bool = True, fail_on_error: bool = False) -> Pass:
    """From documents (document, sha256, application, status, pages) to accepted features.

    processors: render, semantics, registration, vector, and strong if direct evidence is looked for first: where it is
    accepted, the registration is not asked. ``reference`` is what features are judged against; without ``enforce`` all of
    them are accepted. Pages of a document without any are page 1.
    """
    missing = {"render", "semantics", "registration", "vector"} - set(processors)
    if missing:
        raise ValueError(f"processors are missing: {sorted(missing)}")
    spark = documents.sparkSession
    home, profile = shared_folder(spark, "pass"), Profile()
    given = F.when(F.size(F.coalesce("pages", F.array().cast("array<int>"))) > 0, F.col("pages")).otherwise(F.array(F.lit(1)))
    nothing = F.lit(None).cast("struct<stage: string, code: string, message: string>")
    pages = documents.select("document", "sha256", "application", "status", F.explode(given).alias("page")).withColumn("error", nothing)
    v, box, ref = (lambda k: F.lit(VERSIONS[k]).alias("version")), F.lit(bbox).alias("bbox"), F.lit(reference_hash).alias("reference_hash")
    step = lambda rows, name, key, **more: run_stage(rows, name, key, processors[name], store, home, profile, fail_on_error=fail_on_error, **more)
    pages = step(pages, "render", content_key("planning-render", F.lit(dpi).alias("dpi"), F.col("page"), F.col("sha256"), v("render")))
    page_sha, text_sha = F.col("render.sha256").alias("page_sha256"), F.col("semantics.sha256").alias("semantic_hash")
    pages = step(pages, "semantics", content_key("planning-semantic", page_sha, v("semantic")))
    if "strong" in processors:
        pages = step(pages, "strong", content_key("planning-strong-georeference", box, F.col("page"), page_sha, text_sha, F.col("sha256"), v("georeference")))
    else:
        pages = pages.withColumn("strong", F.lit(None).cast(StructType.fromDDL(RESULTS["strong"])))
    sure = F.coalesce(F.col("strong.status") == "accepted", F.lit(False))
    pages = step(pages, "registration", content_key("planning-registration", box, page_sha, ref, v("registration")), due=~sure)
    pages = pages.withColumn("placed", F.when(sure, F.col("strong")).otherwise(F.col("registration")))
    # direct evidence of any page of a document comes first, else the consensus of best pages
    r = lambda c: F.col(f"placed.{c}")
    direct = written(best_pages(pages.filter(r("direct") & (r("status") == "accepted"))), f"{home}/direct")
    rest = written(best_pages(pages).join(direct.select("document"), "document", "left_anti"), f"{home}/rest")
    one = lambda c: F.struct(*(c[x].alias(x) for x in ("lon", "lat", "confidence", "f1")))
    variants = F.concat(F.array(one(F.col("placed"))), F.slice(F.coalesce(r("alternatives"), F.array().cast(f"array<struct<{ALTERNATIVE}>>")), 1, 12))
    candidates = rest.select("application", "document", F.posexplode(variants).alias("rank", "x")).select(F.coalesce("application", F.lit("unknown")).alias("application"), "document", "rank", F.col("rank").cast("long").alias("ordinal"), "x.*")
    kept = written(georef.variants(candidates), f"{home}/variants")
    evidence, members = georef.consensus(kept)
    members = written(members, f"{home}/members")
    agreed = members.join(kept.select("application", "document", "rank", "lon", "lat", "confidence", "f1"), ["application", "document", "rank"])
    chosen = direct.select("document", F.lit("direct").alias("method"), F.lit(0).alias("rank"), one(F.col("placed")).alias("candidate"))
    chosen = chosen.unionByName(agreed.select("document", F.lit("consensus").alias("method"), "rank", one({c: F.col(c) for c in ("lon", "lat", "confidence", "f1")}).alias("candidate")))
    selected = written(direct.unionByName(rest).join(chosen, "document"), f"{home}/selected")
    transform = F.sha2(F.to_json(F.struct(F.col("candidate"), F.col("method"))), 256).alias("transform_hash")
    drawn = step(selected, "vector", content_key("planning-vector", page_sha, text_sha, transform, v("vector")))
    shapes = drawn.filter("vector IS NOT NULL").select("document", "page", "application", "status", "sha256", "candidate", F.posexplode("vector.vectors").alias("k", "x"))
    vectors = shapes.select(
        F.concat_ws("#", "document", "page", "k").alias("id"), "x.role", "x.form", "x.points", F.to_json("x.points").alias("geometry"), "x.name", F.greatest(F.coalesce("x.confidence", F.lit(0.0)), F.coalesce("candidate.confidence", F.lit(0.0))).alias("confidence"), "application", "status", "document",
    )
    judged = counts = None
    if enforce:
        if reference is None:
            raise ValueError("features are judged against a reference; give one, or enforce=False")
        features, judged = accept_features(vectors.drop("document"), reference)
        features = features.join(vectors.select("id", "document"), "id")
        counts = report(judged)
    else:
        features = vectors
    features = written(features, f"{home}/features")
    accepted = selected.select("document", "page", "method").join(features.select("document").distinct(), "document", "left_semi")
    both = pages.select("error").unionByName(drawn.select("error"))
    failures = both.filter("error IS NOT NULL").groupBy("error.stage", "error.code").agg(F.count(F.lit(1)).alias("n"))
    return Pass(pages, selected.select("document", "page", "method", "rank", "candidate"), features, judged, counts, accepted, failures, evidence, profile.frame(spark))
