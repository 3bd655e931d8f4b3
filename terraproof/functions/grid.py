"""British National Grid references as places on earth, in built-in functions.

The inverse transverse Mercator series gives latitude and longitude on the grid's own ellipsoid; a shift by seven parameters
takes them to WGS 84, where one step of Bowring's formula gives the latitude. The series is good to a millimetre, the shift
to some metres anywhere in Great Britain.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Airy 1830 and WGS 84 half axes, the grid's projection, the published shift from its datum.
AIRY = (6377563.396, 6356256.909)
WGS84 = (6378137.0, 6356752.314245)
SCALE, LAT_0, LON_0, EAST_0, NORTH_0 = 0.9996012717, 49.0, -2.0, 400000.0, -100000.0
SHIFT_M = (446.448, -125.157, 542.060)
SHIFT_SECONDS = (0.1502, 0.2470, 0.8421)
SHIFT_PPM = -20.4894


def steps() -> list[tuple[str, str]]:
    """Name and expression of each step from ``_e`` and ``_n`` in metres to ``_lon`` and ``_lat`` in degrees.

    Spark and other engines read the expressions alike.
    """
    a, b = AIRY
    e2 = 1 - (b / a) ** 2
    e1 = (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    unit = a * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256)  # metres along the meridian a radian of rectifying latitude
    p0 = math.radians(LAT_0)
    m0 = a * ((1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * p0 - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * p0) + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * p0) - 35 * e2**3 / 3072 * math.sin(6 * p0))
    foot = (3 * e1 / 2 - 27 * e1**3 / 32, 21 * e1**2 / 16 - 55 * e1**4 / 32, 151 * e1**3 / 96, 1097 * e1**4 / 512)
    ep2 = e2 / (1 - e2)
    wa, wb = WGS84
    w2, wp2 = 1 - (wb / wa) ** 2, (wa / wb) ** 2 - 1
    rx, ry, rz = (math.radians(s / 3600) for s in SHIFT_SECONDS)
    grow = 1 + SHIFT_PPM * 1e-6
    n = lambda v: f"CAST({v!r} AS DOUBLE)"
    return [
        ("_mu", f"({n(m0)} + (_n - {n(NORTH_0)}) / {n(SCALE)}) / {n(unit)}"),
        ("_foot", "_mu + " + " + ".join(f"{n(c)} * sin({2 * k} * _mu)" for k, c in enumerate(foot, 1))),
        ("_sin", "sin(_foot)"), ("_cos", "cos(_foot)"),
        ("_tan2", "_sin * _sin / (_cos * _cos)"),
        ("_eta", f"{n(ep2)} * _cos * _cos"),
        ("_across", f"{n(a)} / sqrt(1 - {n(e2)} * _sin * _sin)"),
        ("_d", f"(_e - {n(EAST_0)}) / (_across * {n(SCALE)})"),
        ("_d2", "_d * _d"),
        ("_phi", f"_foot - _sin / _cos * (1 - {n(e2)} * _sin * _sin) / (1 - {n(e2)}) * _d2 * (CAST(0.5 AS DOUBLE) - _d2 / 24 * (5 + 3 * _tan2 + 10 * _eta - 4 * _eta * _eta - 9 * {n(ep2)}) + _d2 * _d2 / 720 * (61 + 90 * _tan2 + 298 * _eta + 45 * _tan2 * _tan2 - 252 * {n(ep2)} - 3 * _eta * _eta))"),
        ("_lambda", f"{n(math.radians(LON_0))} + _d / _cos * (1 - _d2 / 6 * (1 + 2 * _tan2 + _eta) + _d2 * _d2 / 120 * (5 - 2 * _eta + 28 * _tan2 - 3 * _eta * _eta + 8 * {n(ep2)} + 24 * _tan2 * _tan2) - _d2 * _d2 * _d2 / 5040 * (61 + 662 * _tan2 + 1320 * _tan2 * _tan2 + 720 * _tan2 * _tan2 * _tan2))"),
        ("_nu", f"{n(a)} / sqrt(1 - {n(e2)} * sin(_phi) * sin(_phi))"),
        ("_x0", "_nu * cos(_phi) * cos(_lambda)"), ("_y0", "_nu * cos(_phi) * sin(_lambda)"), ("_z0", f"_nu * {n(1 - e2)} * sin(_phi)"),
        ("_x", f"{n(SHIFT_M[0])} + {n(grow)} * _x0 - {n(rz)} * _y0 + {n(ry)} * _z0"),
        ("_y", f"{n(SHIFT_M[1])} + {n(rz)} * _x0 + {n(grow)} * _y0 - {n(rx)} * _z0"),
        ("_z", f"{n(SHIFT_M[2])} - {n(ry)} * _x0 + {n(rx)} * _y0 + {n(grow)} * _z0"),
        ("_p", "sqrt(_x * _x + _y * _y)"),
        ("_beta", f"atan2(_z * {n(wa)}, _p * {n(wb)})"),
        ("_lat", f"degrees(atan2(_z + {n(wp2 * wb)} * sin(_beta) * sin(_beta) * sin(_beta), _p - {n(w2 * wa)} * cos(_beta) * cos(_beta) * cos(_beta)))"),
        ("_lon", "degrees(atan2(_y, _x))"),
    ]


def with_place(df: DataFrame, east: Column, north: Column, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """``df`` and the place of each grid reference; null where a number is null.

    Each step is a projection of its own, so that what several later steps use is computed once. The task number in the
    last one keeps the optimizer from moving a filter on the place below the steps, which would write them all out for each
    use. Names that begin with an underscore are the steps' own.
    """
    out = df.select("*", east.cast("double").alias("_e"), north.cast("double").alias("_n"))
    for name, sql in steps():
        out = out.withColumn(name, F.expr(sql))
    here = F.spark_partition_id() >= 0
    return out.select(*(F.col(c) for c in df.columns if c not in (lon, lat)), F.when(here, F.col("_lon")).alias(lon), F.when(here, F.col("_lat")).alias(lat))
