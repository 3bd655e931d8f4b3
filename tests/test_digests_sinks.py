"""Canonical digests, bridge report, GeoJSON of all forms, text around links, OCR tables."""

from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F

from terraproof.functions.canonical import canonical_json, canonical_key, rows_digest
from terraproof.operators import documents, evidence, semantics
from terraproof.operators.attachments import parse_attachments, with_offsets
from terraproof.sources import sinks


def test_keys_do_not_depend_on_the_order_of_fields_and_entries(spark):
    a = spark.sql("SELECT named_struct('z', 1, 'a', named_struct('y', array(named_struct('q', 1, 'p', 'x')), 'b', CAST(NULL AS INT))) AS s, map('k', named_struct('n', 1, 'm', 2), 'c', named_struct('n', 3, 'm', 4)) AS m, 1.5D AS v")
    b = spark.sql("SELECT 1.5D AS v, map('c', named_struct('m', 4, 'n', 3), 'k', named_struct('m', 2, 'n', 1)) AS m, named_struct('a', named_struct('b', CAST(NULL AS INT), 'y', array(named_struct('p', 'x', 'q', 1))), 'z', 1) AS s")
    said = [df.select(canonical_json(df).alias("j"), canonical_key(df, "ns").alias("k"), canonical_json(df, "s", keep_nulls=True).alias("n")).first() for df in (a, b)]
    assert said[0] == said[1] and said[0]["k"].startswith("ns-")
    assert said[0]["j"] == '{"m":{"c":{"m":4,"n":3},"k":{"m":2,"n":1}},"s":{"a":{"y":[{"p":"x","q":1}]},"z":1},"v":1.5}'
    assert json.loads(said[0]["n"]) == {"s": {"a": {"b": None, "y": [{"p": "x", "q": 1}]}, "z": 1}}


def test_digests_of_rows(spark):
    rows = [(k, f"t{k % 5}", {"x": k}) for k in range(300)] + [(None, None, None)] * 2
    df = spark.createDataFrame(rows, "a int, b string, m map<string,int>")
    one = rows_digest(df).first()
    assert one == rows_digest(df.select("m", "b", "a").repartition(7, "a")).first() and one["n"] == 302
    assert one["digest"] != rows_digest(df.dropDuplicates(["a"])).first()["digest"] != rows_digest(df.filter("a <> 3")).first()["digest"]
    assert rows_digest(df.limit(0)).first()["n"] == 0 and rows_digest(df, "b", columns=("a",)).count() == 6


def features(spark, rows):
    return spark.createDataFrame(rows, "id int, feature_class string, source string, authority boolean, renderable boolean")


def test_bridge_report(spark, tmp_path):
    rows = [(1, "Building ", "planning", True, False), (2, "building", "Planning", True, None), (3, "terrain-detail", "planning", True, False), (4, "path", "planning", True, False)]
    first, second = (evidence.bridge_report(features(spark, r)).first() for r in (rows, rows[::-1]))
    assert first == second and (first["input"], first["passed"], first["withheld"]) == (4, 3, 1)
    assert first["input_by_class"] == {"building": 2, "path": 1, "terrain-detail": 1} and first["passed_by_class"] == {"building": 2, "path": 1} and first["withheld_by_class"] == {"terrain-detail": 1}
    only = evidence.bridge_report(features(spark, [r for r in rows if r[0] != 3])).first()
    assert only["input_sha256"] == only["output_sha256"] == first["output_sha256"] != first["input_sha256"]
    assert sinks.write_bridge(features(spark, rows), str(tmp_path)).first()["output_sha256"] == first["output_sha256"]
    assert spark.read.json(f"{tmp_path}/withheld").select("id", "reason").collect()[0]["id"] == 3 and spark.read.json(f"{tmp_path}/features").count() == 3
    with pytest.raises(Exception, match="withholds every feature"):
        evidence.bridge_report(features(spark, rows[2:3])).collect()
    with pytest.raises(Exception, match="unreviewed-class"):
        evidence.bridge_report(features(spark, [(9, "ride-layout", "planning", True, False)])).collect()


def test_geojson_of_all_forms(spark, tmp_path):
    p = lambda *xy: [{"lon": float(x), "lat": float(y)} for x, y in xy]
    square, hole, far = p((0, 0), (4, 0), (4, 4), (0, 0)), p((1, 1), (2, 1), (2, 2), (1, 1)), p((9, 9), (10, 9), (10, 10), (9, 9))
    rows = [("a", "Point", p((1, 2)), None), ("b", "LineString", p((1, 2), (3, 4)), None), ("c", "Polygon", square, None), ("d", "Polygon", None, [[square, hole]]), ("e", "MultiPolygon", None, [[square, hole], [far]]), ("f", "MultiLineString", None, [[square], [hole]]), ("g", "MultiPoint", None, [[p((1, 2))], [p((3, 4))]])]
    df = spark.createDataFrame(rows, "id string, form string, points array<struct<lon:double,lat:double>>, parts array<array<array<struct<lon:double,lat:double>>>>")
    got = {(x := json.loads(r["value"]))["id"]: x["geometry"]["coordinates"] for r in sinks.features_json(df).collect()}
    flat = lambda ring: [[q["lon"], q["lat"]] for q in ring]
    assert got == {"a": [1, 2], "b": [[1, 2], [3, 4]], "c": [flat(square)], "d": [flat(square), flat(hole)], "e": [[flat(square), flat(hole)], [flat(far)]], "f": [flat(square), flat(hole)], "g": [[1, 2], [3, 4]]}
    for rows_in in (df.union(df.filter("id = 'a'")), df.limit(0)):
        sinks.write_collection(rows_in, str(tmp_path / "c"))
        text = "".join(f.read_text() for part in ("0-head", "1-features", "2-foot") for f in sorted((tmp_path / "c" / part).glob("part-*")))
        assert len(json.loads(text)["features"]) == rows_in.count()


def test_offsets_and_text_around_links(spark):
    text = "ab<x>cd<x><x>é" + "\n<x>"
    at = spark.createDataFrame([(text,), ("none",), ("",)], "t string").select(with_offsets(F.col("t"), "<x>").alias("m")).collect()
    assert [x["at"] for x in at[0]["m"]] == [2, 7, 10, 15] and at[1]["m"] == at[2]["m"] == []
    filler = "word " * 300
    html = f'<p>{filler}</p><script>open("/x/AttachmentShowServlet?ImageName=11")</script>{filler}<table><tr><td>Existing</td></tr><tr><td>Proposed <b>site</b> plan</td><td onclick="go(\'/x/AttachmentShowServlet?imagename=12\')">x</td></tr></table>'
    got = {r["image"]: r for r in parse_attachments(spark.createDataFrame([(1, "http://h.example/a", html), (2, "http://h.example/b", "<a href='/AttachmentShowServlet?ImageName=9'>Plan</a>")], "page_id int, url string, html string")).collect()}
    assert got["12"]["row_text"].startswith("Proposed site plan") and "Existing" not in got["12"]["row_text"] and got["12"]["proposed"]
    start = html.index("/x/Att")
    assert got["11"]["row_text"] == " ".join(re.sub("<[^>]+>", " ", html[start - 500 : start + 500]).split())
    assert got["9"]["title"] == "Plan" and got["9"]["row_text"] == "Plan" and got["9"]["url"] == "https://h.example/AttachmentShowServlet?ImageName=9"


def test_ocr_tables(spark):
    head = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext"
    rows = [head, "5\t1\t1\t1\t1\t1\t10\t20\t30\t\t90\tRide", "", "5\t1\t1\t1\t1\t2\t1\t2\t3\t4\tx\tno", "5\t1\t1\t1\t1\t3\t1\t2\t3\t4\t\tblank", "5\t1\t1"]
    words = lambda tsv, **more: semantics.tsv_words(spark.createDataFrame([(1, tsv)], "id int, tsv string"), **more)
    assert [(r["text"], r["height"]) for r in words("\n".join(rows)).collect()] == [("Ride", 0.0)]
    assert sorted((r["text"], r["confidence"]) for r in words("\n".join(rows), min_confidence=-1).collect()) == [("Ride", 0.9), ("blank", 0.0), ("no", -0.01)]
    assert words(head).count() == words(None).count() == words("").count() == 0
    with pytest.raises(Exception, match="table lacks conf"):
        words(head.replace("conf", "sure") + "\n" + rows[1]).collect()


def test_corpus_counts(spark):
    got = documents.corpus_counts(spark.createDataFrame([("a", 5), ("a", None), ("b", 7)], "application string, bytes int")).first()
    assert tuple(got) == (2, 3, 12)
