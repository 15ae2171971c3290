"""Mapping rows (area to nearest station), their rules and their summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadcast.functions.numeric import round_exact
from roadcast.specs import MAPPING_COLUMNS


def mapping_rows(consolidated: DataFrame, points: DataFrame, ids: DataFrame) -> DataFrame:
    """Join attributes, located points and id lists of each area and give them their output names.

    ``points`` already carries the nearest station; an area that could not be located
    keeps its row with nulls, for ``unlocated``. ``ids`` leaves out the list of areas
    with very many features.
    """
    joined = consolidated.join(points, "beat", "left").join(ids, "beat", "left")
    return joined.select(
        "objectid",
        "source_objectids",
        "source_feature_count",
        "source_null_name_count",
        "beat",
        "div",
        "serv",
        "name",
        "geometry_type",
        round_exact(F.col("lat"), 6).alias("representative_lat"),
        round_exact(F.col("lon"), 6).alias("representative_lon"),
        "station_id",
        "station_name",
        "station_location",
        round_exact(F.col("distance_km"), 2).alias("distance_to_station_km"),
    ).select(*MAPPING_COLUMNS)


def unlocated(mapping: DataFrame) -> DataFrame:
    """Areas whose shapes enclose nothing, or whose distances do not settle."""
    return mapping.filter(F.col("geometry_type").isNull() | F.col("distance_to_station_km").isNull()).select("beat")


def mapping_rules(mapping: DataFrame) -> DataFrame:
    """One row: row count, duplicate areas, and the first rule broken (null when sound)."""
    return mapping.agg(
        F.count("*").alias("n_rows"),
        (F.count("beat") - F.count_distinct("beat")).alias("n_duplicates"),
    ).select(
        "n_rows",
        "n_duplicates",
        F.when(F.col("n_rows") == 0, "empty_mapping").when(F.col("n_duplicates") > 0, "duplicate_beats").alias("rule"),
    )


def mapping_summary(mapping: DataFrame) -> DataFrame:
    """Totals of a mapping in one row."""
    km = F.col("distance_to_station_km")
    return mapping.agg(
        F.count("*").alias("total_beats"),
        (F.count("beat") - F.count_distinct("beat")).alias("duplicate_beats"),
        F.sum(F.greatest(F.col("source_feature_count") - 1, F.lit(0))).alias("collapsed_features"),
        F.sum("source_null_name_count").alias("null_name_features"),
        F.max(km).alias("max_distance_km"),
        F.avg(km).alias("avg_distance_km"),
        F.count_if(F.col("geometry_type") == "MultiPolygon").alias("multipolygon_beats"),
    )


def beats_per_station(mapping: DataFrame) -> DataFrame:
    return mapping.groupBy("station_id").agg(F.count("*").alias("n_beats")).orderBy("station_id")
