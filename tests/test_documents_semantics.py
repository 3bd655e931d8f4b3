from __future__ import annotations

from pyspark.sql import functions as F

from terraproof.operators import documents, semantics
from terraproof.sources import catalog


def test_geometry_first_and_stats(spark):
    docs = spark.createDataFrame([("a", "u1", 0, "Planning Statement", None, 5), ("a", "u2", 1, "Proposed Site Plan", None, 7)], "application string, url string, ordinal long, title string, role string, bytes long")
    done = documents.classify(docs)
    assert [r["url"] for r in documents.geometry_first(done).collect()] == ["u2", "u1"]
    assert documents.ingest_stats(done).first().asDict() == {"documents": 2, "bytes": 12, "geometry_first": 1, "narrative": 1, "applications": 1}


def test_metadata_by_url_else_file_first_wins(spark):
    docs = spark.createDataFrame([("u1", "f1", 0, "t"), ("u9", "f2", 1, "t"), ("u9", "f9", 2, "t")], "url string, file string, ordinal long, title string")
    apps = spark.createDataFrame([("u1", "f2", 0, "A", "ok"), ("u1", "f2", 1, "B", "no"), (None, None, 2, "C", "x")], "url string, file string, ordinal long, application string, status string")
    got = {r["ordinal"]: (r["reference"], r["status"]) for r in documents.attach_metadata(docs, apps).collect()}
    assert got == {0: ("A", "ok"), 1: ("A", "ok"), 2: (None, None)}


def test_files_and_manifest(spark):
    import hashlib

    good = hashlib.sha256(b"abc").hexdigest()
    entries = spark.createDataFrame([("https://h/1", "a", 3, good, "application/pdf"), ("https://h/2", "b", 3, good, "application/pdf"), ("https://h/3", "c", 4, good, "application/pdf"), ("http://h/4", "../d", -1, "x", "text/html")], "url string, file string, bytes long, sha256 string, mime string")
    files = spark.createDataFrame([("a", bytearray(b"abc")), ("c", bytearray(b"abc"))], "file string, content binary")
    assert {r["file"]: r["state"] for r in documents.verify_files(entries, files).collect()} == {"a": "reused", "b": "missing", "c": "mismatch", "../d": "missing"}
    assert [r["broken"] for r in documents.manifest_violations(entries).collect()] == ["url-not-https"]


def test_navigation_keeps_host_and_first_eight(spark):
    html = "".join(f'<a href="/doc/{i % 12}">View documents {i}</a>' for i in range(20)) + '<a href="https://other.example/doc">documents</a><a href="/x">home</a><a>none</a>'
    pages = spark.createDataFrame([(1, "http://h.example/a", html), (2, "http://h.example/", None)], "page_id long, url string, html string")
    got = documents.navigation(documents.links(pages), r"\bdocuments?\b", "doc").orderBy("rank").collect()
    assert len(got) == 8 and got[0]["url"] == "https://h.example/doc/0" and got[0]["text"] == "View documents 0"


def test_drawings_order(spark):
    rows = [("1", True, False, True, True, 9), ("2", False, True, True, False, 1), ("3", False, False, True, False, 5), ("4", True, True, True, False, 1), ("5", True, True, False, False, 99)]
    df = spark.createDataFrame(rows, "image string, ride_layout boolean, proposed boolean, drawing boolean, narrative boolean, priority int")
    assert [r["image"] for r in documents.select_drawings(df).collect()] == ["4", "2", "3"]


def test_tsv(spark):
    head = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext\n"
    tsv = head + "5\t1\t1\t1\t1\t1\t100\t50\t60\t10\t95\tRaised\n5\t1\t1\t1\t1\t2\t190\t50\t100\t10\t94\tFootbridge\n5\t1\t1\t1\t2\t1\t0\t90\t60\t10\t20\tfaint\n5\t1\t1\t1\t2\t2\t0\t90\t60\t10\t-1\t \n"
    words = semantics.tsv_words(spark.createDataFrame([(1, tsv)], "id long, tsv string"), scale_x=2, scale_y=2)
    (line,) = semantics.group_words(words, ["id", "line_id"]).collect()
    assert (line["left"], line["top"], line["right"] - line["left"]) == (200.0, 100.0, 380.0) and 0.94 < line["confidence"] < 0.96 and line["role"] == "site-path-centerline-candidate"


def test_bbox(spark):
    xhtml = '<page width="1000" height="500"><line><word xMin="100" yMin="50" xMax="180" yMax="60">Raised</word><word xMin="200" yMin="50" xMax="300" yMax="60">path</word></line><line><word xMin="9" yMin="9" xMax="5" yMax="20">no</word><word xMin="1" yMin="80" xMax="9" yMax="90">R&amp;D</word></line></page>'
    words = semantics.bbox_words(spark.createDataFrame([(1, xhtml, 2000.0, 1000.0)], "id long, xhtml string, width double, height double"))
    lines = {r["text"]: r for r in semantics.group_words(words, ["id", "line_id"]).collect()}
    assert set(lines) == {"Raised path", "R&D"} and (lines["Raised path"]["left"], lines["Raised path"]["right"] - lines["Raised path"]["left"]) == (200.0, 400.0)


def test_nearest_anchor_against_all_pairs(spark):
    import random

    rng = random.Random(5)
    cands = [(1, i, rng.uniform(-300, 300), rng.uniform(-300, 300), 0.5) for i in range(60)]
    anchors = [(1, i, rng.uniform(-300, 300), rng.uniform(-300, 300), 0.1 * (i % 5), "wall-candidate" if i % 4 else None, f"l{i}") for i in range(40)]
    got = {r["id"]: r["label"] for r in semantics.nearest_anchor(spark.createDataFrame(cands, "page long, id long, x double, y double, confidence double"), spark.createDataFrame(anchors, "page long, id long, x double, y double, confidence double, role string, label string")).collect()}
    for _, i, x, y, _ in cands:
        near = sorted((((x - a[2]) ** 2 + (y - a[3]) ** 2) ** 0.5, -a[4], a[1], a[6]) for a in anchors if a[5])
        assert got[i] == (near[0][3] if near[0][0] <= 120 else None)


def test_sources(spark):
    modes = [(None, 200, "miss"), (0, None, "fresh"), (10**8, 304, "revalidated"), (10**8, 200, "refreshed"), (10**8, 500, "stale-if-error"), (10**9, None, "unavailable"), (None, 404, "unavailable")]
    df = spark.createDataFrame([m[:2] for m in modes], "age long, http int").select(catalog.cache_mode(F.col("age"), F.col("http")).alias("m"))
    assert [r["m"] for r in df.collect()] == [m[2] for m in modes]
    got = catalog.acquire(spark, {"a": lambda: spark.createDataFrame([(1,)], "x int"), "b": lambda: spark.read.parquet("/nowhere/at/all")}).collect()
    assert {(r["source"], r["status"]) for r in got} == {("a", "ready"), ("b", "unavailable")}
    assert 'nwr["highway"]' in catalog.overpass_query((52.0, -1.0, 52.1, -0.9)) and catalog.missing_sources(spark, catalog.catalog(spark)).count() == 0
