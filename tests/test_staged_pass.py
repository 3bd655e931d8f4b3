"""The pass as one run: warm stores, failing pages, direct evidence, figures."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

import pytest

from terraproof.plans import staged
from terraproof.plans.staged import PageError, run_pass

DOCUMENTS = "document string, sha256 string, application string, status string, pages array<int>"


def processors(log: str, strong: bool = False, broken: str | None = None) -> dict:
    """Processors that note each call as a file."""

    def called(stage: str) -> None:
        Path(log, f"{stage}-{uuid.uuid4().hex}").touch()

    def render(row: dict) -> dict:
        called("render")
        if row["sha256"] == broken:
            raise PageError("cannot be drawn", "RENDER_FAILED")
        return {"sha256": f"page-{row['sha256']}-{row['page']}", "width": 1000, "height": 1000}

    def semantics(row: dict) -> dict:
        called("semantics")
        return {"sha256": f"text-{row['render']['sha256']}", "text": row["document"]}

    def placed(lon: float, status: str = "candidate", direct: bool = False, f1: float = 0.8) -> dict:
        return {"status": status, "method": "visual", "direct": direct, "confidence": 0.9, "f1": f1, "precision": 0.8, "recall": 0.8, "lon": lon, "lat": 52.98, "alternatives": [{"lon": lon + 0.01, "lat": 52.98, "confidence": 0.8, "f1": 0.5}]}

    def registration(row: dict) -> dict:
        called("registration")
        return placed(-1.8800 if row["document"] == "a" else -1.8802, f1=0.8 + row["page"] / 100)

    def strongly(row: dict) -> dict:
        called("strong")
        return placed(-1.87, "accepted", True) if row["document"] == "d" and row["page"] == 2 else placed(-1.87, "rejected", True)

    def vector(row: dict) -> dict:
        called("vector")
        if row["sha256"] == f"{broken}-vector":
            raise PageError("no lines", None)
        return {"vectors": [{"role": "site-path-centerline-candidate", "confidence": 0.5, "form": "LineString", "points": [{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 1.0}], "name": None}, {"role": "no-such-role", "confidence": 0.5, "form": "LineString", "points": [], "name": None}]}

    return {"render": render, "semantics": semantics, "registration": registration, "vector": vector} | ({"strong": strongly} if strong else {})


def calls(log: str) -> dict:
    names = [x.split("-")[0] for x in os.listdir(log)]
    return {n: names.count(n) for n in set(names)}


def figures(run) -> dict:
    return {r["stage"]: (r["pages"], r["hits"], r["calls"], r["failures"]) for r in run.profile.collect()}


def test_a_warm_run_computes_nothing(spark, tmp_path):
    docs = spark.createDataFrame([("a", "sha-a", "x", "Approved", [1]), ("b", "sha-b", "x", "Approved", None), ("a2", "sha-a", "x", "Approved", [1])], DOCUMENTS)
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    os.mkdir(log)
    first = run_pass(docs, processors(log), store, enforce=False)
    # the third document is a copy of the first: one call for both, but for its own registration's lines
    assert calls(log) == {"render": 2, "semantics": 2, "registration": 2, "vector": calls(log)["vector"]}
    assert figures(first)["render"] == (3, 0, 2, 0) and {r["method"] for r in first.selected.collect()} == {"consensus"}
    names = sorted(r["id"] for r in first.features.collect())
    assert len(names) == 6 and names[0].startswith("a#1#")
    seen = calls(log)
    second = run_pass(docs, processors(log), store, enforce=False)
    assert calls(log) == seen and sorted(r["id"] for r in second.features.collect()) == names
    assert {k: v[1:] for k, v in figures(second).items()} == {"render": (3, 0, 0), "semantics": (3, 0, 0), "registration": (3, 0, 0), "vector": (3, 0, 0)}
    # another box is another request for registrations alone
    run_pass(docs, processors(log), store, bbox="1,2,3,4", enforce=False)
    assert calls(log) == seen | {"registration": seen["registration"] + 2}


def test_one_failing_page_is_a_row(spark, tmp_path):
    docs = spark.createDataFrame([("a", "sha-a", "x", None, [1, 2]), ("b", "bad", "x", None, [1]), ("c", "bad-vector", "x", None, [1])], DOCUMENTS)
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    os.mkdir(log)
    got = run_pass(docs, processors(log, broken="bad"), store, enforce=False)
    errors = {(r["document"], r["page"]): r["error"] for r in got.pages.collect()}
    assert len(errors) == 4 and errors["b", 1].asDict() == {"stage": "render", "code": "RENDER_FAILED", "message": "cannot be drawn"} and errors["a", 1] is None
    assert sorted(map(tuple, got.failures.collect()), key=str) == [("render", "RENDER_FAILED", 1), ("vector", None, 1)]
    assert {(r["document"], r["page"]) for r in got.selected.collect()} == {("a", 2), ("c", 1)} and {r["document"] for r in got.accepted.collect()} == {"a"}
    assert figures(got)["render"] == (4, 0, 4, 1) and figures(got)["semantics"] == (4, 0, 3, 0)
    # what failed is tried again, what did not is not
    run_pass(docs, processors(log), store, enforce=False)
    assert calls(log)["render"] == 5
    with pytest.raises(Exception, match="cannot be drawn"):
        run_pass(docs, processors(log, broken="bad"), str(tmp_path / "other"), enforce=False, fail_on_error=True)


def test_direct_evidence_comes_first_and_saves_the_search(spark, tmp_path):
    docs = spark.createDataFrame([("a", "sha-a", "x", "Approved", [1]), ("b", "sha-b", "x", "Approved", [1]), ("d", "sha-d", "x", "Approved", [1, 2]), ("e", "sha-e", "alone", "Approved", [1])], DOCUMENTS)
    log = str(tmp_path / "log")
    os.mkdir(log)
    reference = spark.createDataFrame([], "id string, kind string, name string, form string, points array<struct<x:double,y:double>>")
    got = run_pass(docs, processors(log, strong=True), str(tmp_path / "store"), reference=reference)
    assert calls(log) == {"render": 5, "semantics": 5, "strong": 5, "registration": 4, "vector": 3}
    assert {(r["document"], r["page"], r["method"]) for r in got.selected.collect()} == {("a", 1, "consensus"), ("b", 1, "consensus"), ("d", 2, "direct")}
    rows = got.features.collect()
    assert {r["document"] for r in rows} == {"a", "b", "d"} and {r["kind"] for r in rows} == {"path"} and all(r["confidence"] == 0.9 for r in rows)
    assert {(r["document"], r["method"]) for r in got.accepted.collect()} == {("a", "consensus"), ("b", "consensus"), ("d", "direct")}
    assert sum(got.report.first()["actions"].values()) == 3
    with pytest.raises(ValueError, match="reference"):
        run_pass(docs, processors(log, strong=True), str(tmp_path / "store"))
    with pytest.raises(ValueError, match="missing"):
        run_pass(docs, {}, str(tmp_path / "store"))


def test_nothing_to_do(spark, tmp_path):
    got = run_pass(spark.createDataFrame([], DOCUMENTS), processors(str(tmp_path)), str(tmp_path / "store"), enforce=False)
    assert got.features.count() == got.pages.count() == 0 and figures(got)["vector"] == (0, 0, 0, 0)


def test_observation_changes_nothing(spark, tmp_path):
    profile = staged.Profile()
    from pyspark.sql import functions as F

    pages = spark.createDataFrame([(1, "k1"), (2, "k2"), (3, "k1")], "page int, k string").withColumn("error", F.lit(None).cast("struct<stage: string, code: string, message: string>"))
    out = staged.run_stage(pages, "double", F.col("k"), lambda row: {"n": row["page"] * 2 if row["k"] == "k2" else 7}, str(tmp_path / "s"), str(tmp_path / "h"), profile, "n int")
    assert {(r["page"], r["double"]["n"]) for r in out.collect()} == {(1, 7), (2, 4), (3, 7)} and out.columns == ["page", "k", "error", "double"]
    assert profile.rows[0][:5] == ("double", 3, 0, 2, 0) and profile.frame(spark).count() == 1
