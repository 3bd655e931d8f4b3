from __future__ import annotations

import struct

import pytest
from pyspark.sql import functions as F

from terraproof.functions import geo, text
from terraproof.operators import documents, evidence
from terraproof.sources import catalog


def test_page_size_and_priors(spark):
    info = "Pages: 3\nPage    2 size: 1190.55 x 841.89 pts (A3)\nPage size: 595 x 842 pts"
    df = spark.createDataFrame([(info, "-1.9", "52.9", "x", "1"), (None, "999", "1", None, None)], "i string, a string, b string, c string, d string")
    row = df.select(text.page_size(F.col("i"), 2).alias("p"), text.page_size(F.col("i")).alias("q"), geo.location_prior((F.col("c"), F.col("d")), (F.col("a"), F.col("b"))).alias("l")).collect()
    assert (row[0]["p"]["width"], row[0]["q"]["height"], tuple(row[0]["l"])) == (1190.55, 842.0, (-1.9, 52.9)) and row[1]["p"] is None and row[1]["l"] is None


def test_controls(spark):
    ring = [{"lon": float(i), "lat": float(-i)} for i in range(5)]
    points = [{"x": 0.0, "y": 0.0, "lon": 1.0, "lat": 2.0, "page": p} for p in (1, None, 1, 2)]
    df = spark.createDataFrame([(ring, points, points[:2])], "ring array<struct<lon:double,lat:double>>, p array<struct<x:double,y:double,lon:double,lat:double,page:int>>, q array<struct<x:double,y:double,lon:double,lat:double,page:int>>")
    r = df.select(geo.extent_controls(F.col("ring"), F.lit(1200.0), F.lit(800.0)).alias("e"), geo.explicit_controls(F.lit(1), F.col("q"), F.col("p")).alias("c"), geo.explicit_controls(F.lit(2), F.col("q")).alias("n"), geo.center(F.col("p")).alias("m")).first()
    assert [(p["x"], p["y"]) for p in r["e"]] == [(0, 0), (0, 800), (1200, 800), (1200, 0)] and len(r["c"]) == 3 and r["n"] is None and tuple(r["m"]) == (1.0, 2.0)


def test_document_aggregates(spark):
    v = spark.createDataFrame([("reused", 5), ("missing", 7), ("mismatch", 9)], "state string, bytes long")
    assert documents.hydrate_stats(v).first().asDict() == {"entries": 3, "reused": 1, "missing": 1, "mismatch": 1, "reused_bytes": 5}
    d = spark.createDataFrame([("A", 1, "u1", "t", 2), ("A", 0, "u0", "t", 3)], "application string, ordinal long, url string, title string, bytes long")
    g = documents.group_applications(d).first()
    assert [x["url"] for x in g["documents"]] == ["u0", "u1"] and g["bytes"] == 5
    c = spark.createDataFrame([("candidate", None, [0.5] * 20), ("rejected", "m", None)], "status string, method string, alternatives array<double>")
    (r,) = documents.page_candidates(c).collect()
    assert len(r["alternatives"]) == 12 and r["alternatives"][0]["rank"] == 1 and r["method"] == "visual-registration"


def test_dot_segments_against_the_standard_library(spark):
    from urllib.parse import urljoin

    base = "https://h.example/a/b/c.html?q=1"
    targets = ["../d", "./d", "../../../d", "x/./y/../z?k=../k", "..", ".", "/a/../b/./c", "d..e/...", "#../f"]
    df = spark.createDataFrame([(t,) for t in targets], "t string")
    assert [r[0] for r in df.select(text.resolve_url(F.lit(base), F.col("t"))).collect()] == [urljoin(base, t) for t in targets]
    # the library leaves an absolute address as it is, a browser does not
    assert df.limit(1).select(text.resolve_url(F.lit(base), F.lit("https://o.example/x/../y"))).first()[0] == "https://o.example/y"


def test_tokens_boxes_and_headers(spark):
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + struct.pack(">II", 640, 70000)
    df = spark.createDataFrame([("  A b/c.pdf ", png, "1", 2.0), (None, png[:20], "x", float("nan")), ("--", None, "5", None)], "t string, b binary, s string, v double")
    got = df.select(text.safe_token(F.col("t")).alias("t"), text.png_size(F.col("b")).alias("p"), geo.valid_box(F.col("s"), F.lit(0), F.lit(4), F.lit("1")).alias("x"), geo.unit(F.col("v")).alias("u"), text.is_pdf(F.lit("Application/PDF"), F.col("t")).alias("pdf")).collect()
    assert [r["t"] for r in got] == ["A-b-c.pdf", "unknown", "unknown"] and tuple(got[0]["p"]) == (640, 70000) and got[1]["p"] is None and got[2]["p"] is None
    assert tuple(got[0]["x"]) == (1.0, 0.0, 4.0, 1.0) and got[1]["x"] is None and got[2]["x"] is None and [r["u"] for r in got] == [1.0, 0.0, 0.0] and all(r["pdf"] for r in got)


def test_endpoints():
    assert catalog.endpoints("https://A.example/api", [None, "https://a.example:443/api", "https://b.example", ""]) == ["https://a.example/api", "https://b.example/"]
    for bad in ("http://a.example", ""):
        with pytest.raises(ValueError):
            catalog.endpoints(bad)


def test_bridge_fails_where_nothing_passes(spark):
    schema = "feature_class string, source string, authority boolean, renderable boolean"
    held, passed = ("terrain-detail", "planning", True, False), ("path", "planning", True, False)
    assert tuple(evidence.bridge_totals(spark.createDataFrame([held, passed], schema)).first()) == (2, 1, 1)
    assert tuple(evidence.bridge_totals(spark.createDataFrame([], schema)).first()) == (0, 0, 0)
    for bad in ([held], [passed, ("path", "osm", True, False)]):
        with pytest.raises(Exception, match="bridge"):
            evidence.bridge_totals(spark.createDataFrame(bad, schema)).collect()


def test_the_manifest_as_a_source(spark, tmp_path):
    from terraproof.sources import catalog, manifest

    (tmp_path / "manifest.json").write_text('{"schemaVersion": 1, "status": "usable", "liveApplications": 0, "documentsDownloaded": 1, "applications": [], "entries": [{"kind": "document", "url": "https://h.example/a", "file": "f/a.pdf", "bytes": 3, "sha256": "%s", "mime": "application/pdf"}]}' % ("a" * 64))
    got = catalog.acquire(spark, {**manifest.adapter(spark, str(tmp_path)), "osm": manifest.adapter(spark, str(tmp_path / "none"))["planning"]}).collect()
    assert sorted((r["source"], r["status"], r["url"]) for r in got) == [("osm", "unavailable", None), ("planning", "ready", "https://h.example/a")]


def test_alternatives_used(spark):
    from terraproof.operators import georef

    got = georef.alternatives_used(spark.createDataFrame([("x", 0), ("x", 2), ("y", 0)], "application string, rank int")).collect()
    assert {tuple(r) for r in got} == {("x", 1), ("y", 0)}
