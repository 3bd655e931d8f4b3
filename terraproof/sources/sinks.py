"""GeoJSON and report output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def geometry_json(form: Column, points: Column | None, parts: Column | None = None) -> Column:
    """GeoJSON geometry of a form and its points (lon, lat), or its parts, each an array of rings of points.

    A line is the first ring of its part; of a form that is not Multi the first part counts. Without parts the points are
    those of the one ring or line.
    """
    join = lambda xs, f: F.concat(F.lit("["), F.array_join(F.transform(xs, f), ","), F.lit("]"))
    pair = lambda p: F.concat(F.lit("["), p["lon"].cast("string"), F.lit(","), p["lat"].cast("string"), F.lit("]"))
    line = lambda ring: join(ring, pair)
    polygon = lambda rings: join(rings, line)
    given = parts if parts is not None else F.lit(None).cast("array<array<array<struct<lon:double,lat:double>>>>")
    whole = given if points is None else F.coalesce(given, F.array(F.array(points)))
    first = F.get(whole, F.lit(0))
    ring = F.get(first, F.lit(0))
    body = (
        F.when(form == "Point", pair(F.get(ring, F.lit(0)))).when(form == "Polygon", polygon(first)).when(form == "MultiPolygon", join(whole, polygon))
        .when(form == "MultiLineString", join(whole, lambda p: line(F.get(p, F.lit(0))))).when(form == "MultiPoint", join(F.flatten(F.flatten(whole)), pair)).otherwise(line(ring))
    )
    return F.concat(F.lit('{"type":"'), form, F.lit('","coordinates":'), body, F.lit("}"))


def features_json(features: DataFrame) -> DataFrame:
    """One GeoJSON Feature per row (id, form, points or parts or both, further columns as properties), as text in ``value``."""
    names = [c for c in features.columns if c not in ("id", "form", "points", "parts")]
    shape = geometry_json(F.col("form"), *(F.col(c) if c in features.columns else None for c in ("points", "parts")))
    properties = F.to_json(F.struct(*names)) if names else F.lit("{}")
    text = F.concat(F.lit('{"type":"Feature","id":'), F.to_json(F.array(F.col("id").cast("string"))), F.lit(',"geometry":'), shape, F.lit(',"properties":'), properties, F.lit("}"))
    return features.select(F.regexp_replace(text, r'^(\{"type":"Feature","id":)\[("(?:[^"\\]|\\.)*")\]', "$1$2").alias("value"))


def write_features(features: DataFrame, path: str) -> None:
    """GeoJSON lines: one Feature per line, in as many files as there are partitions."""
    features_json(features).write.mode("overwrite").text(path)


def write_collection(features: DataFrame, path: str) -> None:
    """One FeatureCollection as text files that belong one behind the other, in order of id: a head, features, a foot."""
    rows = features_json(features).select(F.get_json_object("value", "$.id").alias("_id"), "value")
    first = rows.orderBy("_id", "value").limit(1).collect()  # one row, which goes into the head: all others follow a comma
    head = '{"type":"FeatureCollection","features":[' + (first[0]["value"] if first else "")
    spark = features.sparkSession
    rest = rows.exceptAll(spark.createDataFrame(first, rows.schema)).orderBy("_id", "value")
    body = rest.select(F.concat(F.lit(","), F.col("value")).alias("value"))
    for part, lines in (("0-head", spark.createDataFrame([(head,)], "value string")), ("1-features", body), ("2-foot", spark.createDataFrame([("]}",)], "value string"))):
        lines.write.mode("overwrite").text(f"{path}/{part}")


def write_report(report: DataFrame, path: str) -> None:
    """A few counters as one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_bridge(features: DataFrame, path: str) -> DataFrame:
    """Writes what passes the bridge, what it withholds and its report below ``path``; gives the report as written."""
    from terraproof.operators.evidence import assert_bridge, bridge_report, withheld_rows

    report = bridge_report(features)
    report.coalesce(1).write.mode("overwrite").json(f"{path}/report")
    assert_bridge(features).filter("disposition = 'passed'").drop("disposition", "reason").write.mode("overwrite").json(f"{path}/features")
    withheld_rows(features).write.mode("overwrite").json(f"{path}/withheld")
    return features.sparkSession.read.schema(report.schema).json(f"{path}/report")
