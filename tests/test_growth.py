"""What travels and what is computed anew grows with the input and no faster."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from terraproof.operators import georef, raster
from terraproof.plans import queries


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_repeated_segment_is_stepped_once(spark, monkeypatch):
    lines = spark.createDataFrame([(1, [{"x": 0, "y": 0}, {"x": 9, "y": 4}])] * 5, "page int, pixels array<struct<x:long,y:long>>").withColumns({"closed": F.lit(False), "thickness": F.lit(1)})
    stepped, seen = raster.stepped, []
    monkeypatch.setattr(raster, "stepped", lambda parts, *a: seen.append(parts.count()) or stepped(parts, *a))
    assert raster.draw(lines, 64, "page").agg(F.sum(F.bit_count("bits"))).first()[0] == 10 and seen == [1]


@pytest.mark.parametrize("lat", [0.0, 52.98, 89.9995, -89.9])
def test_anchors_are_dealt_to_few_cells(spark, lat):
    n = 4000
    found = spark.range(n).select(F.lit(1).alias("application"), (F.col("id") % 5).alias("document"), F.lit(1).alias("rank"), F.col("id").alias("ordinal"), (F.lit(179.99) + F.rand(1) * 0.02).alias("lon"), (F.lit(lat) + F.rand(2) * 0.0004).alias("lat"), F.lit(0.9).alias("confidence"), F.lit(0.5).alias("f1"))
    found = found.withColumn("lon", F.when(F.col("lon") > 180, F.col("lon") - 360).otherwise(F.col("lon"))).localCheckpoint()
    dealt = found.filter("ordinal < 300")
    got = {(r["document"], r["ordinal"]) for r in georef.consensus(dealt)[1].collect()}
    from terraproof.functions.geo import haversine_m

    a, b = dealt.alias("a"), dealt.alias("b")
    pairs = a.join(b, F.round(haversine_m(F.col("a.lon"), F.col("a.lat"), F.col("b.lon"), F.col("b.lat")), 6) <= 140).select("a.document", "a.ordinal", F.col("b.document").alias("d")).distinct().groupBy("document", "ordinal").count()
    most = pairs.agg(F.max("count")).first()[0]
    assert georef.consensus(dealt)[0].first()["documents"] == most == len(got)
    # nine copies of each anchor before
    text = plan(georef.consensus(found)[0])
    assert text.count("Generate explode") == 2 and "cast(-1 as bigint)" not in text and "Repartition" in text


def test_lines_are_made_where_they_are_read(spark, small, tmp_path):
    got = queries.line_text_hash(spark, small)
    assert "collect_list" not in plan(got).split("Union", 1)[1].split("Join LeftSemi", 1)[0].split("Join LeftAnti", 1)[0]
    rows = [(1, "a b\n\nc"), (2, "x  y"), (2, "z\nq"), (None, "k"), (None, "l"), (3, None), (4, "  ")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {(r["doc_id"], r["line_id"]): (r["left"], r["right"], round(r["confidence"], 6)) for r in queries.line_bounds(spark, str(tmp_path)).collect()}
    assert set(out) == {(1, 0), (1, 2), (2, 0), (2, 1), (None, 0)}
    assert out[1, 0] == (0.0, 47.0, 0.51) and out[2, 0] == (0.0, 87.0, 0.51)


def test_control_points_are_made_for_taken_registrations_only(spark, small):
    plans = plan(queries.registration_alternatives(spark, small))
    lists = [line for line in plans.splitlines() if "collect_list" in line]
    assert len(lists) == 1 and "points" not in lists[0] and "named_struct(x" not in plans.split("collect_list", 1)[1]  # points of all candidates travelled before


def test_control_points_are_counted_as_they_are_made(spark):
    from terraproof.operators import registration

    value = lambda n: F.when(F.rand(n) < 0.02, None).when(F.rand(n + 50) < 0.02, float("nan")).otherwise(F.rand(n + 100) * 2 - 0.5)
    matrix = F.struct(*((value(n) * (400 if c in "cf" else 1)).alias(c) for n, c in enumerate("abcdef")))
    rows = spark.range(2000).select(F.when(F.col("id") % 50 > 0, matrix).alias("m"), *((value(20 + n) * s).alias(c) for n, (c, s) in enumerate((("cx", 50), ("cy", 50), ("w", 900), ("h", 700))))).localCheckpoint()
    place = [F.col(c) for c in ("m", "cx", "cy", "w", "h")]
    made, counted = F.size(registration.sample_controls(*place, queries.BBOX, queries.RASTER)), registration.count_controls(*place, queries.RASTER)
    got = rows.select(made.alias("made"), counted.alias("counted")).collect()
    assert all(r["made"] == r["counted"] for r in got) and {r["made"] for r in got} >= {0, 4, 8}
