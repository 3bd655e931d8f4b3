from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from terraproof.operators.attachments import parse_attachments
from terraproof.plans import planning_pass
from terraproof.sources import manifest, sinks

HASH = "a" * 64


def write_manifest(tmp_path, **change):
    entry = lambda n: {"kind": "document", "url": f"https://h/{n}", "file": f"f/{n}.pdf", "bytes": 5, "sha256": HASH, "mime": "application/pdf"}
    m = {
        "schemaVersion": 1, "status": "usable", "liveApplications": 1, "documentsDownloaded": 2, "entries": [entry(1), entry(2)],
        "applications": [{"reference": "A/1", "status": "Approved", "longitude": -1.9, "latitude": 52.9, "downloadedDocuments": [{"url": "https://h/1", "title": "Planning Statement"}, {"url": "https://h/2", "title": "Proposed Site Plan"}]}],
    } | change
    (tmp_path / "m.json").write_text(json.dumps(m, indent=1))
    return str(tmp_path / "m.json")


def test_ingest(spark, tmp_path):
    m = manifest.read_manifest(spark, write_manifest(tmp_path))
    rows = manifest.ingest(m).collect()
    assert [(r["url"], r["classification"], r["application"], r["longitude"]) for r in rows] == [("https://h/2", "site-plan", "A/1", -1.9), ("https://h/1", "narrative", "A/1", -1.9)]
    assert [r["page"] for r in manifest.prepare(manifest.ingest(m).withColumn("pages", F.lit(40))).collect()] == list(range(1, 13))
    copy = {"kind": "document", "url": "https://h/1", "file": "f/1.pdf", "bytes": 5, "sha256": HASH, "mime": "application/pdf"}
    again = manifest.read_manifest(spark, write_manifest(tmp_path, entries=[copy, copy, copy | {"url": "https://h/2"}, {"kind": "page", "url": "x"}]))
    assert manifest.ingest(again).count() == 2


def test_manifest_fails_closed(spark, tmp_path):
    read = lambda **c: manifest.ingest(manifest.read_manifest(spark, write_manifest(tmp_path, **c)))
    assert read(status="disabled", entries=[]).count() == 0
    with pytest.raises(Exception, match="shape or counts"):
        read(documentsDownloaded=3).collect()
    one = {"kind": "document", "url": "https://h/1", "file": "f", "bytes": 1, "sha256": HASH, "mime": "application/pdf"}
    with pytest.raises(Exception, match="mime-not-allowed"):
        read(documentsDownloaded=1, entries=[one | {"mime": "text/html"}]).collect()
    with pytest.raises(Exception, match="conflicting duplicate url"):
        read(documentsDownloaded=1, entries=[one, one | {"bytes": 2}]).collect()
    with pytest.raises(Exception, match="shape or counts"):
        read(liveApplications=2).collect()
    with pytest.raises(Exception, match="shape or counts"):
        read(applications=[{"reference": "A/1", "failure": "gone"}]).collect()
    with pytest.raises(Exception, match="shape or counts"):
        read(schemaVersion=2).collect()
    many = [one | {"url": f"https://h/{i}"} for i in range(1201)]
    assert read(documentsDownloaded=1200, entries=many[:1200]).count() == 1200
    with pytest.raises(Exception, match="document ceiling exceeded: 1201"):
        read(documentsDownloaded=1201, entries=many).collect()


def test_attachments(spark):
    row = lambda n, title: f'<tr><td>{title}</td><td><a href="/s/AttachmentShowServlet?ImageName={n}&amp;x=1">view</a></td></tr>'
    html = "<table>" + row(200001, "Proposed coaster track layout plan") + row(200002, "Existing site plan") + row(200003, "Design and Access Statement") + row(200005, "Proposed site plan") + "</table><script>window.open('http://h.example/s/AttachmentShowServlet?ImageName=201111')</script>"
    got = parse_attachments(spark.createDataFrame([(1, "http://h.example/app", html), (2, "http://h.example/", None)], "page_id long, url string, html string")).collect()
    by = {r["image"]: r for r in got}
    assert set(by) == {"200001", "200002", "200003", "200005", "201111"}
    order = [r["image"] for r in sorted(got, key=lambda r: (-r["priority"], r["narrative"], r["image"]))]
    assert order[:2] == ["200001", "200005"] and by["200003"]["priority"] <= -150 and by["200002"]["existing"] and by["200002"]["priority"] < by["200005"]["priority"]
    assert by["200001"]["url"] == "https://h.example/s/AttachmentShowServlet?ImageName=200001&x=1" and by["201111"]["transport_url"].startswith("http://h.example/")


def test_geojson(spark, tmp_path):
    df = spark.createDataFrame([("a\"b", "Point", [{"lon": 1.0, "lat": 2.0}], "path"), ("p", "Polygon", [{"lon": 0.0, "lat": 0.0}, {"lon": 1.0, "lat": 0.0}, {"lon": 0.0, "lat": 0.0}], None)], "id string, form string, points array<struct<lon:double,lat:double>>, featureClass string")
    a, b = (json.loads(r["value"]) for r in sinks.features_json(df).collect())
    assert a == {"type": "Feature", "id": 'a"b', "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}, "properties": {"featureClass": "path"}}
    assert b["geometry"]["coordinates"] == [[[0.0, 0.0], [1.0, 0.0], [0.0, 0.0]]]
    sinks.write_features(df, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 2


def test_planning_pass(spark, tmp_path):
    at = lambda d: [{"x": 0.0, "y": float(d)}, {"x": 90.0, "y": float(d)}]
    schema = "id string, role string, form string, points array<struct<x:double,y:double>>, geometry string, name string, confidence double, application string, status string"
    vectors = spark.createDataFrame([("p1", "site-path-centerline-candidate", "LineString", at(0), "g", None, 0.9, "A", "Approved"), ("p2", "wall-candidate", "LineString", at(0), "g", None, 0.5, "A", "Approved"), ("p3", "unknown", "LineString", at(0), "g", None, 0.9, "A", None)], schema)
    reference = spark.createDataFrame([("osm:way:1", "path", None, "LineString", at(1))], "id string, kind string, name string, form string, points array<struct<x:double,y:double>>")
    accepted, judged = planning_pass.accept_features(vectors, reference)
    assert [(r["id"], r["target"]) for r in accepted.collect()] == [("p1", "osm:way:1")]
    r = planning_pass.report(judged).first()
    assert r["actions"] == {"planning-authority-corroborated": 1, "withheld": 1} and r["rejections"] == {"confidence-below-authority-gate": 1}


def test_stage_keys_differ_by_box(spark):
    pages = spark.createDataFrame([("s", 1, "p", "h", "r", "t")], "sha256 string, page int, page_sha256 string, semantic_hash string, reference_hash string, transform_hash string")
    a, b = planning_pass.stage_keys(pages, "1,2,3,4").first(), planning_pass.stage_keys(pages, "1,2,3,5").first()
    assert a["georeference_key"] != b["georeference_key"] and a["render_key"] == b["render_key"] and a["render_key"].startswith("planning-render-")
    assert len({planning_pass.georeference_version(v) for v in (None, "strong-georef-v1", "strong-georef-v2-null-safe")}) == 1


def test_select_pages(spark):
    schema = "application long, document string, rank int, ordinal long, lon double, lat double, confidence double, f1 double, page int"
    rows = [(1, "a", 0, 0, -1.88, 52.98, 0.9, 0.8, 2), (1, "b", 0, 1, -1.8801, 52.98, 0.9, 0.8, 3), (2, "c", 0, 2, -1.88, 52.98, 0.9, 0.8, 1)]
    direct = spark.createDataFrame([("a", 1, 1.0)], "document string, page int, score double")
    got = {r["document"]: (r["page"], r["method"]) for r in planning_pass.select_pages(direct, spark.createDataFrame(rows, schema)).collect()}
    assert got == {"a": (1, "direct"), "b": (3, "consensus")}
