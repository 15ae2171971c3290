"""Area, parts and an interior point of each union outline."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A scan line is cut into this many stretches, so that a line with very many
# crossings is ordered by many tasks.
STRETCHES = 64


def outline_parts(outline: DataFrame) -> DataFrame:
    """Area and extent of every connected part. Edges carry the interior on their left."""
    return outline.groupBy("beat", "part").agg(
        # rounded so that equal parts tie whatever order their edges were summed in
        F.round(F.sum((F.col("x0") - F.col("x1")) * (F.col("y0") + F.col("y1"))) / 2, 14).alias("area"),
        F.min("x0").alias("min_x"),
        F.max("x0").alias("max_x"),
        F.min("y0").alias("min_y"),
        F.max("y0").alias("max_y"),
    )


def outline_summary(parts: DataFrame) -> DataFrame:
    """Part count, geometry type, total area and the largest part (the westernmost on a tie) per area."""
    return parts.groupBy("beat").agg(
        F.count("*").alias("n_parts"),
        F.sum("area").alias("area"),
        F.when(F.count("*") == 1, "Polygon").otherwise("MultiPolygon").alias("geometry_type"),
        F.min_by(
            F.struct("part", "min_x", "max_x", "min_y", "max_y"), F.struct(-F.col("area"), F.col("min_x"), F.col("min_y"), F.col("part"))
        ).alias("largest"),
    )


def representative_points(outline: DataFrame) -> DataFrame:
    """A point inside the largest part of each area, with ``n_parts``, ``geometry_type`` and ``area``.

    The scan line lies half-way between the vertex ordinates next to the middle of
    the extent; the point is the middle of its widest inside stretch, the first on a tie.
    """
    summary = outline_summary(outline_parts(outline))
    largest = summary.select(
        "beat", "largest.*", ((F.col("largest.min_y") + F.col("largest.max_y")) / 2).alias("middle")
    )
    edges = outline.join(largest, ["beat", "part"])
    y0, y1, middle = F.col("y0"), F.col("y1"), F.col("middle")
    # every vertex starts exactly one edge of the outline or more, so y0 alone sees them all
    lines = edges.groupBy("beat", "part", "min_x", "max_x").agg(
        F.max(F.when(y0 <= middle, y0)).alias("low"), F.min(F.when(y0 > middle, y0)).alias("high")
    ).select("beat", "part", "min_x", "max_x", ((F.col("low") + F.col("high")) / 2).alias("scan_y"))
    scan_y = F.col("scan_y")
    crossing = outline.join(lines, ["beat", "part"]).filter((y0 > scan_y) != (y1 > scan_y))
    x0, x1 = F.col("x0"), F.col("x1")
    x = F.when(x0 == x1, x0).otherwise(x0 + (scan_y - y0) / ((y1 - y0) / F.nullif(x1 - x0, F.lit(0.0))))
    share = (F.col("x") - F.col("min_x")) / (F.col("max_x") - F.col("min_x"))
    # a falling edge has the interior to its east: a stretch begins there
    crossings = crossing.select("beat", "scan_y", "min_x", "max_x", x.alias("x"), (y1 < y0).alias("begins")).select(
        "beat", "scan_y", F.floor(share * STRETCHES).alias("stretch"), F.struct("x", "begins").alias("c")
    )
    by_x = Window.partitionBy("beat", "stretch").orderBy("c")
    within = crossings.select(
        "beat", "scan_y", F.col("c").alias("start"), F.lead("c").over(by_x).alias("stop")
    )
    by_stretch = Window.partitionBy("beat").orderBy("stretch")
    between = (
        crossings.groupBy("beat", "scan_y", "stretch")
        .agg(F.min("c").alias("first"), F.max("c").alias("last"))
        .select("beat", "scan_y", F.col("last").alias("start"), F.lead("first").over(by_stretch).alias("stop"))
    )
    inside = within.unionByName(between).filter(F.col("start.begins") & F.col("stop").isNotNull())
    width = F.col("stop.x") - F.col("start.x")
    points = inside.groupBy("beat", "scan_y").agg(
        F.min_by((F.col("start.x") + F.col("stop.x")) / 2, F.struct(-width, F.col("start.x"))).alias("lon")
    )
    return summary.join(points, "beat").select(
        "beat", "geometry_type", "n_parts", "area", "lon", F.col("scan_y").alias("lat")
    )
