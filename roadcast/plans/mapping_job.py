"""From map features to the area-to-station mapping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadcast.operators import areas
from roadcast.operators.interior import representative_points
from roadcast.operators.mapping import mapping_rows, mapping_rules, unlocated
from roadcast.operators.nearest import nearest_station, station_violations
from roadcast.operators.overlay import open_vertices, union_outline
from roadcast.session import checkpointed
from roadcast.sources.documents import default_stations, read_feature_lines
from roadcast.sources.geojson_ranges import read_documents
from roadcast.sources.sinks import write_mapping_document, write_mapping_rows


class RuleError(RuntimeError):
    """An input or output rule is broken."""


def reject(violations: DataFrame, what: str, *order: str) -> None:
    """Raise with the first violation by ``order``, if there is any."""
    found = (violations.orderBy(*order) if order else violations).limit(1).collect()
    if found:
        raise RuleError(f"{what}: {found[0].asDict()}")


def locate_areas(
    features: DataFrame, stations: DataFrame, feature_id: Sequence[str] = ("feature_index",)
) -> DataFrame:
    """One row per area: geometry type, parts, size, a point inside and the nearest station.

    Areas without any surface are left out.
    """
    outline = checkpointed(union_outline(features, feature_id))
    reject(open_vertices(outline), "the union of an area does not close", "beat", "x", "y")
    return nearest_station(representative_points(outline).filter("area > 0"), stations, ["beat"])


def build_mapping(
    features: DataFrame,
    stations: DataFrame,
    strict: bool = True,
    feature_id: Sequence[str] = ("feature_index",),
) -> DataFrame:
    """Mapping rows of typed features. Strict mode rejects areas with conflicting attributes.

    Attributes are kept aside without the shapes, so the input is parsed once for them
    and once for the outline.
    """
    reject(station_violations(stations), "station list")
    attributes = checkpointed(features.drop("parts"))
    consolidated = areas.consolidate(attributes)
    if strict:
        reject(areas.conflicts(consolidated), "conflicting values", "beat", "field")
    located = locate_areas(features, stations, feature_id)
    mapping = checkpointed(mapping_rows(consolidated, located, areas.inline_source_ids(attributes)))
    reject(unlocated(mapping), "area without a surface or a distance", "beat")
    return mapping


def map_areas(
    spark: SparkSession,
    geojson_path: str,
    output_path: str,
    stations: DataFrame | None = None,
    strict: bool = True,
    lines: bool = False,
    document: bool = True,
) -> DataFrame:
    """Read feature collections, map every area, check the result, then write it.

    A document is read by many tasks, and its features are taken apart once. ``lines`` reads
    newline-delimited features instead.

    The result is one JSON array, or without ``document`` JSON lines, written in parallel.
    """
    stations = default_stations(spark) if stations is None else stations
    reject(station_violations(stations), "station list")
    if lines:
        features, identity = read_feature_lines(spark, geojson_path), ["feature_index"]
    else:
        containers, features = read_documents(spark, geojson_path)
        reject(areas.collection_violations(containers).select("source", "rule"), "input container")
        identity = ["source", "feature_index"]
    taken = checkpointed(areas.shredded(features))
    reject(areas.violations(taken), "feature", *identity)
    mapping = build_mapping(areas.accepted(taken), stations, strict, identity)
    reject(mapping_rules(mapping).filter(F.col("rule").isNotNull()), "mapping")
    (write_mapping_document if document else write_mapping_rows)(mapping, output_path)
    return mapping
