from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from terraproof.functions import rules, text


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("title", "role", "expected"),
    [
        ("Proposed Site Plan", None, ("site-plan", 130, False)),
        ("Planning Statement", None, ("narrative", -100, True)),
        ("Topographical Survey", None, ("topographical-survey", 112, False)),
        ("Topographical Survey", "terrain-or-drainage", ("drainage-water", 90, False)),
        ("Drainage Assessment Report", None, ("narrative", -100, True)),
        ("Drainage Assessment Report", "terrain-or-drainage", ("drainage-water", 90, False)),
        ("Proposed Coaster Track Layout", "ride-layout", ("ride-layout", 150, False)),
        ("épath of ideas", None, ("unknown", 0, False)),
        (None, None, ("unknown", 0, False)),
    ],
)
def test_classify_document(spark, title, role, expected):
    assert tuple(one(spark, text.classify_document(F.col("t"), F.col("r")), t=title, r=role)) == expected


@pytest.mark.parametrize(
    ("label", "role"),
    [
        ("Proposed raised footbridde and path", "site-path-centerline-candidate"),
        ("New roller coaster track layout", "ride-layout-candidate"),
        ("Track support column bases", "ride-support-candidate"),
        ("Retaining wall", "wall-candidate"),
        ("Existing pond", "water-candidate"),
        ("Notes", None),
        ("  ", None),
        ("épath", "site-path-centerline-candidate"),
    ],
)
def test_label_role(spark, label, role):
    assert one(spark, text.label_role(F.col("t")), t=label) == role


@pytest.mark.parametrize(
    ("status", "eligible"),
    [("Approved", True), ("Planning  Permission - Approved", True), ("withdrawn", False), ("Awaiting decision", False), (None, False), ("disapproved", False), ("approved then refused", False)],
)
def test_status(spark, status, eligible):
    assert one(spark, text.status_eligible(F.col("t")), t=status) is eligible


def test_scales_and_resolution(spark):
    scales = text.scale_denominators(F.col("t"))
    assert one(spark, scales, t="Scale 1:500 and 1/100, 1:25000 1 : 100") == [100, 500]
    assert one(spark, scales, t=None) == []
    dpi = lambda want, w, h: spark.range(1).select(text.raster_dpi(F.lit(want), F.lit(w).cast("double"), F.lit(h).cast("double"))).first()[0]
    assert dpi(240, 1190.55, 841.89) == 240 and 150 <= dpi(240, 2383.94, 1683.78) <= 160 and dpi(240, 3370.39, 2383.94) == 120
    assert dpi(240, None, None) == 180 and dpi(150, None, None) == 150


def test_coordinate_pair(spark):
    pair = text.coordinate_pair(F.col("t"))
    assert tuple(one(spark, pair, t="E 403000 N 344000")) == ("osgb", 403000.0, 344000.0)
    assert tuple(one(spark, pair, t="at 52.98, -1.88")) == ("wgs84", 52.98, -1.88)
    assert tuple(one(spark, pair, t="-120.5 30")) == ("wgs84", -120.5, 30.0)
    assert one(spark, pair, t="sheet 1 of 3") is None


def test_html_and_urls(spark):
    assert one(spark, text.decode_html(F.col("t")), t="<b>a</b><br/>b &amp;lt; &#8364; &#39;c&apos;") == "a b < € 'c'"
    url = text.resolve_url(F.col("b"), F.col("t"))
    base = "http://h.example/a/b?x=1#f"
    for target, want in {"https://o.example/": "https://o.example/", "//o.example/p": "http://o.example/p", "/p": "http://h.example/p", "?y": "http://h.example/a/b?y", "c": "http://h.example/a/c", "#g": "http://h.example/a/b?x=1#g"}.items():
        assert one(spark, url, b=base, t=target) == want


def test_attachment_rank(spark):
    rank = lambda t: one(spark, text.rank_attachment(F.col("t"), F.lit(None).cast("string"), F.lit(None).cast("string")), t=t)
    assert rank("Proposed coaster track layout plan")["priority"] >= 220
    assert rank("Design and Access Statement")["priority"] <= -150 and rank("Landscape and Visual Impact")["narrative"]
    assert rank("Existing site plan")["priority"] < rank("Proposed site plan")["priority"]


def test_ride_page(spark):
    page = lambda t, a=True: one(spark, text.ride_page(F.lit(None).cast("string"), F.col("t"), F.lit(a)), t=t)
    good = page("Proposed coaster track layout scale 1:500")
    assert good["eligible"] and good["score"] >= rules.RIDE_PAGE_SCORE
    prose = page("the ride " * 260, False)
    assert prose["dense"] and not prose["eligible"]
    assert not page("Proposed site plan scale 1:500", False)["eligible"]
