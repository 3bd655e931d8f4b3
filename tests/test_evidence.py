from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from terraproof.operators import evidence
from terraproof.operators.cache import ResultStore, evidence_key

FEATURES = "authority_key string, feature_class string, source string, confidence double, eligible boolean, ordinal long"


def decide(spark, *rows):
    df = spark.createDataFrame([("k", *r, i) for i, r in enumerate(rows)], FEATURES)
    return evidence.resolve_evidence(df).first()


@pytest.mark.parametrize(
    ("rows", "winner", "locked"),
    [
        ([("path", "osm", 1.0, None), ("path", "planning", 0.87, None)], "planning", True),
        ([("path-material", "planning", 0.9, None), ("path-material", "osm", 1.0, None)], "planning", True),
        ([("building", "osm", 0.9, None), ("building", "microsoft-buildings", 0.8, None)], "microsoft-buildings", False),
        ([("path", "planning", 1.0, False), ("path", "osm", 0.8, None)], "osm", False),
        ([("path", "planning", 1.0, False)], "planning", False),
        ([("tree", "geojson", 1.0, None), ("tree", "osm", 0.1, None)], "osm", False),
        ([("tree", " OSM ", float("nan"), None), ("tree", None, 0.2, None)], "osm", False),
    ],
)
def test_winner(spark, rows, winner, locked):
    d = decide(spark, *rows)
    assert (d["winner_source"], d["planning_locked"]) == (winner, locked)


def test_order_of_rows_does_not_matter(spark):
    rows = [(f"k{i % 7}", "path" if i % 2 else "tree", ["planning", "osm", "lidar"][i % 3], (i * 37 % 11) / 10, [None, True, False][i % 3], i) for i in range(80)]
    a = evidence.resolve_evidence(spark.createDataFrame(rows, FEATURES)).orderBy("authority_key").collect()
    b = evidence.resolve_evidence(spark.createDataFrame(rows[::-1], FEATURES).repartition(7)).orderBy("authority_key").collect()
    assert a == b
    assert evidence.authority_violations(spark.createDataFrame(rows, FEATURES), spark.createDataFrame(a)).count() == 0


def test_empty_table(spark):
    assert evidence.resolve_evidence(spark.createDataFrame([], FEATURES)).count() == 0


@pytest.mark.parametrize(
    ("status", "confidence", "overlap", "offset", "direct", "reason"),
    [
        (None, 0.85, 1.0, 10.0, False, "confidence-below-authority-gate"),
        (None, 0.90, 1.0, 10.0, False, None),
        (None, 0.90, 0.1, 10.0, False, "build-geofence-overlap-below-authority-gate"),
        (None, 0.90, 1.0, 25.01, False, "registration-offset-above-authority-gate"),
        (None, 0.90, 1.0, None, False, "registration-offset-unavailable"),
        (None, 0.90, 1.0, None, True, None),
        ("pending", 0.90, 1.0, 10.0, False, "application-status-not-world-authority-eligible"),
        (None, 0.90, None, 10.0, False, "build-geofence-overlap-unavailable"),
    ],
)
def test_page_gate(spark, status, confidence, overlap, offset, direct, reason):
    row = spark.createDataFrame([(status, confidence, overlap, offset, direct)], "status string, confidence double, overlap double, offset_m double, direct boolean")
    got = evidence.page_gate(row).first()
    assert got["reasons"] == ([reason] if reason else []) and got["accepted"] is (reason is None)


def test_bridge(spark):
    schema = "feature_class string, source string, authority boolean, renderable boolean"
    rows = [("building", "planning", True, None), ("terrain-detail", "planning", True, False), ("ride-layout", "planning", True, None), ("path", "osm", True, None), ("path", "planning", True, True), ("path", "planning", None, None)]
    got = [r["disposition"] for r in evidence.bridge(spark.createDataFrame(rows, schema)).collect()]
    assert got == ["passed", "withheld", "refused", "refused", "refused", "refused"]
    assert evidence.assert_bridge(spark.createDataFrame(rows[:2], schema)).count() == 2
    with pytest.raises(Exception, match="unreviewed-class"):
        evidence.assert_bridge(spark.createDataFrame(rows[2:3], schema)).collect()


def test_result_store_computes_only_what_is_missing(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path / "s"), "content_key string, v long")
    seen = []

    def compute(work):
        seen.append(sorted(r[0] for r in work.select("content_key").collect()))
        return work.select("content_key", F.lit(1).cast("long").alias("v"))

    work = lambda *k: spark.createDataFrame([(x,) for x in k], "content_key string")
    assert store.get_or_create(work("a", "b", "a"), compute).count() == 2
    assert store.get_or_create(work("b", "c"), compute).count() == 2
    assert seen == [["a", "b"], ["c"]]
    work("c").withColumn("v", F.lit(1).cast("long")).write.mode("append").parquet(store.path)  # another job's append
    assert store.get_or_create(work("c"), compute).count() == 1


def test_evidence_key(spark):
    columns = "schemaVersion int, status string, url string, file string, bytes long, sha256 string, mime string"
    row = lambda **c: tuple(({"schemaVersion": 1, "status": "usable", "url": "u", "file": "f", "bytes": 1, "sha256": "ab", "mime": "application/pdf"} | c).values())
    key = lambda *r: evidence_key(spark.createDataFrame(list(r), columns)).first()["evidence_key"]
    base = key(row(), row(url="v"))
    assert base == key(row(url="v"), row()) == key(row(sha256="AB", mime="Application/PDF"), row(url="v")) and base.startswith("planning-prefetch-")
    others = [row(file="g"), row(mime="image/png"), row(bytes=2), row(sha256="ac"), row(schemaVersion=2), row(status="disabled"), row(file=None)]
    keys = {key(x, row(url="v")) for x in others} | {base, key(row()), key(row(), row(), row(url="v"))}
    assert len(keys) == len(others) + 3
    assert evidence_key(spark.createDataFrame([], columns)).count() == 1


def test_stream_resolves_touched_keys(spark, tmp_path):
    from terraproof.streaming.evidence import resolve_stream

    inbox, rows = tmp_path / "in", [("k", "path", "osm", 1.0, None, 0), ("j", "path", "osm", 1.0, None, 1)]
    spark.createDataFrame(rows, FEATURES).coalesce(1).write.parquet(str(inbox))
    run = lambda: resolve_stream(spark.readStream.schema(FEATURES).parquet(str(inbox)), str(tmp_path / "store"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    run()
    spark.createDataFrame([("k", "path", "planning", 0.9, None, 2)], FEATURES).coalesce(1).write.mode("append").parquet(str(inbox))
    run()
    last = spark.read.parquet(str(tmp_path / "out" / "batch=1")).collect()
    assert [(r["authority_key"], r["winner_source"]) for r in last] == [("k", "planning")]
