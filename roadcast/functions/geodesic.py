"""Distance on the WGS-84 ellipsoid as a column expression (Vincenty 1975, inverse problem, over a waypoint near antipodes)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadcast.functions.numeric import let

# WGS-84: semi-major axis in metres and flattening.
A = 6378137.0
FLAT = 1 / 298.257223563
B = A * (1 - FLAT)
MAX_ROUNDS = 20
TOLERANCE = 1e-13
HALF_STEPS, FINER, SEARCHES = 36, 30, 3  # bearings to either side, refinement of their step, searches


def _reduced(lat: Column) -> Column:
    return F.atan((1 - FLAT) * F.tan(F.radians(lat)))


def _series_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres between two points; null where the series has not settled (near antipodes).

    The longitude iteration runs in ``aggregate`` and stops computing once settled,
    three or four rounds at city scale. ``let`` keeps every intermediate single-use.
    """
    point_pair = F.struct(
        F.sin(_reduced(lat1)).alias("s1"),
        F.cos(_reduced(lat1)).alias("c1"),
        F.sin(_reduced(lat2)).alias("s2"),
        F.cos(_reduced(lat2)).alias("c2"),
        # shortest way round, so pairs across the date line iterate on a small angle
        (F.radians(F.pmod(lon2 - lon1 + 180.0, F.lit(360.0))) - F.lit(3.141592653589793)).alias("dl"),
    )
    start = F.struct(
        F.lit(None).cast("double").alias("lam"),
        F.lit(None).cast("double").alias("sigma"),
        F.lit(None).cast("double").alias("sin_sigma"),
        F.lit(None).cast("double").alias("cos_sigma"),
        F.lit(None).cast("double").alias("cos2a"),
        F.lit(None).cast("double").alias("cos2m"),
        F.lit(False).alias("settled"),
    )

    def one_round(p: Column, acc: Column) -> Column:
        def angles(lam: Column) -> Column:
            cross = F.hypot(p.c2 * F.sin(lam), p.c1 * p.s2 - p.s1 * p.c2 * F.cos(lam))
            dot = p.s1 * p.s2 + p.c1 * p.c2 * F.cos(lam)
            return let(
                F.struct(lam.alias("lam"), cross.alias("ss"), dot.alias("cs")),
                lambda t: F.struct(
                    t.lam.alias("lam"),
                    t.ss.alias("ss"),
                    t.cs.alias("cs"),
                    F.atan2(t.ss, t.cs).alias("sigma"),
                    F.when(t.ss == 0, 0.0).otherwise(p.c1 * p.c2 * F.sin(t.lam) / t.ss).alias("sina"),
                ),
            )

        def with_alpha(t: Column) -> Column:
            return let(
                1.0 - t.sina * t.sina,
                lambda cos2a: F.struct(
                    t.lam.alias("lam"),
                    t.ss.alias("ss"),
                    t.cs.alias("cs"),
                    t.sigma.alias("sigma"),
                    t.sina.alias("sina"),
                    cos2a.alias("cos2a"),
                    # along the equator cos2a is 0 and the mid-point term vanishes
                    F.when(cos2a == 0, 0.0).otherwise(t.cs - 2.0 * p.s1 * p.s2 / cos2a).alias("cos2m"),
                    (FLAT / 16 * cos2a * (4.0 + FLAT * (4.0 - 3.0 * cos2a))).alias("c"),
                ),
            )

        def next_state(t: Column) -> Column:
            lam = p.dl + (1.0 - t.c) * FLAT * t.sina * (
                t.sigma + t.c * t.ss * (t.cos2m + t.c * t.cs * (2.0 * t.cos2m * t.cos2m - 1.0))
            )
            return let(
                lam,
                lambda new: F.struct(
                    new.alias("lam"),
                    t.sigma.alias("sigma"),
                    t.ss.alias("sin_sigma"),
                    t.cs.alias("cos_sigma"),
                    t.cos2a.alias("cos2a"),
                    t.cos2m.alias("cos2m"),
                    (F.abs(new - t.lam) < TOLERANCE).alias("settled"),
                ),
            )

        return let(let(angles(F.coalesce(acc.lam, p.dl)), with_alpha), next_state)

    def metres(r: Column) -> Column:
        u2 = r.cos2a * ((A * A - B * B) / (B * B))
        big_a = 1.0 + u2 / 16384 * (4096.0 + u2 * (-768.0 + u2 * (320.0 - 175.0 * u2)))
        big_b = u2 / 1024 * (256.0 + u2 * (-128.0 + u2 * (74.0 - 47.0 * u2)))

        def arc(b: Column) -> Column:
            m2 = r.cos2m * r.cos2m
            inner = r.cos_sigma * (2.0 * m2 - 1.0) - b / 6 * r.cos2m * (
                4.0 * r.sin_sigma * r.sin_sigma - 3.0
            ) * (4.0 * m2 - 3.0)
            return b * r.sin_sigma * (r.cos2m + b / 4 * inner)

        return F.when(r.settled, B * big_a * (r.sigma - let(big_b, arc)))

    return let(
        point_pair,
        lambda p: F.aggregate(
            F.sequence(F.lit(1), F.lit(MAX_ROUNDS)),
            start,
            lambda acc, _: F.when(acc.settled, acc).otherwise(one_round(p, acc)),
            metres,
        ),
    )


def _over_waypoints_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres between points near each other's antipodes.

    Every way there crosses the circle a quarter round the first point, and both legs over a
    point of that circle are short enough for the series. The shortest sum is searched by
    bearing, on ever finer steps; the last are a ten-thousandth of a radian, which leaves
    less than a millimetre.
    """
    phi, start = F.radians(lat1), F.radians(lon1)

    def way(bearing: Column) -> Column:
        north = F.cos(phi) * F.cos(bearing)
        east = F.atan2(F.sin(bearing) * F.cos(phi), -F.sin(phi) * north)
        lat, lon = F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), north)))), F.degrees(start + east)
        return let(
            F.struct(lat.alias("lat"), lon.alias("lon")),
            lambda m: _series_m(lat1, lon1, m["lat"], m["lon"]) + _series_m(m["lat"], m["lon"], lat2, lon2),
        )

    def finer(best: Column, _: Column) -> Column:
        ways = F.transform(
            F.sequence(F.lit(-HALF_STEPS), F.lit(HALF_STEPS)),
            lambda i: let(
                best["bearing"] + i * best["step"],
                lambda b: F.struct(way(b).alias("m"), b.alias("bearing"), (best["step"] / FINER).alias("step")),
            ),
        )
        return F.array_min(F.filter(ways, lambda w: w["m"].isNotNull()))

    first = F.struct(F.lit(None).cast("double").alias("m"), F.lit(0.0).alias("bearing"), F.lit(math.pi / HALF_STEPS).alias("step"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(SEARCHES)), first, finer, lambda best: best["m"])


def geodesic_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres between two points; null only for a null coordinate."""
    given = lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull()
    return F.coalesce(
        _series_m(lat1, lon1, lat2, lon2), F.when(given, _over_waypoints_m(lat1, lon1, lat2, lon2))
    )


def geodesic_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return geodesic_m(lat1, lon1, lat2, lon2) / 1000.0


def earth_xyz(lat: Column, lon: Column) -> list[Column]:
    """Earth-centred coordinates in metres. Straight lines between them never exceed the geodesic."""
    la, lo = F.radians(lat), F.radians(lon)
    e2 = FLAT * (2 - FLAT)
    n = A / F.sqrt(1.0 - e2 * F.sin(la) * F.sin(la))
    return [n * F.cos(la) * F.cos(lo), n * F.cos(la) * F.sin(lo), n * (1 - e2) * F.sin(la)]
