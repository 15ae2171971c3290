"""Map features: rules, typed rows, and consolidation of the attributes of an area.

An area (a beat) may come as several features. Every aggregate here has a buffer of
fixed size and combines before the shuffle, so an area that holds a large share of
all features is no heavier than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadcast.specs import AREA_GEOMETRIES, FEATURE_KEYS


def collection_violations(collections: DataFrame) -> DataFrame:
    """Containers that are not a FeatureCollection with a list of features."""
    return collections.select(
        "*",
        F.when(F.coalesce(F.col("type"), F.lit("")) != "FeatureCollection", "not_a_feature_collection")
        .when(~_kind_is("features", "ARRAY<"), "features_not_a_list")
        .alias("rule"),
    ).filter(F.col("rule").isNotNull())


def explode_features(collections: DataFrame) -> DataFrame:
    """One row per feature with its index in the container; other columns are carried along."""
    carried = [c for c in collections.columns if c not in ("type", "features")]
    return collections.select(
        *carried,
        F.posexplode(F.try_variant_get("features", "$", "array<variant>")).alias("feature_index", "feature"),
    ).select(
        *carried,
        F.col("feature_index").cast("bigint").alias("feature_index"),
        F.try_variant_get("feature", "$.properties", "variant").alias("properties"),
        F.try_variant_get("feature", "$.geometry", "variant").alias("geometry"),
    )


def _kind_is(column: str, prefix: str) -> Column:
    return F.coalesce(F.schema_of_variant(column).startswith(prefix), F.lit(False))


def shredded(features: DataFrame) -> DataFrame:
    """Every feature taken apart once: its typed values, and the first rule it breaks or null.

    Columns: what is carried along, ``rule, missing_keys`` (an array), the integers, ``name``,
    ``geometry_type`` and ``parts`` (parts > rings > points > (x, y); a Polygon is one part; null if malformed).
    """
    carried = [c for c in features.columns if c not in ("properties", "geometry")]
    fields = ", ".join(f"{key} variant" for key in (*FEATURE_KEYS, "name"))
    opened = features.select(
        *carried,
        F.try_variant_get("properties", "$", f"struct<{fields}>").alias("_p"),
        F.try_variant_get("geometry", "$", "struct<type variant, coordinates variant>").alias("_g"),
    )
    value = lambda key: F.col(f"_p.{key}")
    polygon, multi = "array<array<array<double>>>", "array<array<array<array<double>>>>"
    shape = lambda kind: F.try_variant_get("_g.coordinates", "$", kind)
    typed = opened.select(
        *carried,
        "_p",
        "_g",
        F.array_compact(F.array(*[F.when(value(k).isNull(), F.lit(k)) for k in FEATURE_KEYS])).alias("missing_keys"),
        *[F.try_variant_get(value(k), "$", "bigint").alias(k) for k in FEATURE_KEYS],
        F.try_variant_get(value("name"), "$", "string").alias("name"),
        F.try_variant_get("_g.type", "$", "string").alias("geometry_type"),
    )
    kind = F.col("geometry_type")
    drawn = typed.select("*", F.when(kind == "Polygon", F.array(shape(polygon))).when(kind == "MultiPolygon", shape(multi)).alias("_drawn"))
    checked = drawn.select("*", F.when(_well_formed(F.col("_drawn")), F.col("_drawn")).alias("parts"))
    bad_number = F.lit(False)
    for key in FEATURE_KEYS:
        given = F.lit(True) if key not in ("div", "serv") else ~F.coalesce(F.is_variant_null(value(key)), F.lit(True))
        bad_number = bad_number | (F.col(key).isNull() & given)
    rule = (
        F.when(F.col("_p").isNull() | F.col("_g").isNull(), "missing_properties_or_geometry")
        .when(F.size("missing_keys") > 0, "missing_required_properties")
        .when(~F.coalesce(kind.isin(*AREA_GEOMETRIES), F.lit(False)), "unsupported_geometry_type")
        .when(F.col("_g.coordinates").isNull(), "missing_coordinates")
        .when(bad_number, "not_an_integer")
        .when(F.col("parts").isNull(), "malformed_coordinates")
    )
    return checked.select(*carried, rule.alias("rule"), "missing_keys", *FEATURE_KEYS, "name", "geometry_type", "parts")


def _well_formed(parts: Column) -> Column:
    point_ok = lambda pt: pt.isNotNull() & (F.size(pt) >= 2) & F.get(pt, F.lit(0)).isNotNull() & F.get(pt, F.lit(1)).isNotNull()
    ring_ok = lambda r: r.isNotNull() & (F.size(r) >= 3) & F.forall(r, point_ok)
    part_ok = lambda p: p.isNotNull() & (F.size(p) >= 1) & F.forall(p, ring_ok)
    return parts.isNotNull() & (F.size(parts) >= 1) & F.forall(parts, part_ok)


_TAKEN_OUT = ("rule", "missing_keys", *FEATURE_KEYS, "name", "geometry_type", "parts")


def violations(taken: DataFrame) -> DataFrame:
    """The features of ``shredded`` that break a rule."""
    carried = [c for c in taken.columns if c not in _TAKEN_OUT]
    return taken.filter(F.col("rule").isNotNull()).select(
        *carried, "rule", F.array_join("missing_keys", ",").alias("missing_keys"), "geometry_type"
    )


def accepted(taken: DataFrame) -> DataFrame:
    """The features of ``shredded`` that break none: integers, nullable ``div`` and ``serv``, optional ``name``, parts."""
    return taken.filter(F.col("rule").isNull()).drop("rule", "missing_keys")


def feature_violations(features: DataFrame) -> DataFrame:
    return violations(shredded(features))


def typed_features(features: DataFrame) -> DataFrame:
    return accepted(shredded(features))


def consolidate(features: DataFrame) -> DataFrame:
    """One row per area with its attributes and the conflicts found.

    A conflict resolves to the value whose text sorts first, a non-null one if there
    is any; for names, to the least. A null counts as a value of ``div`` and ``serv``
    but not of ``name``. Strict callers reject rows with a conflict.

    Features are first reduced to the distinct attribute combinations of an area, by
    a hash aggregate that combines before the shuffle, and those to one row.
    """
    combinations = features.groupBy("beat", "div", "serv", "name").agg(
        F.count("*").alias("n"), F.min("objectid").alias("objectid")
    )

    def conflicting(value: str) -> Column:
        mixed_null = (F.count(value) > 0) & (F.count(value) < F.count("*"))
        return F.coalesce(F.min(value) != F.max(value), F.lit(False)) | mixed_null

    by_text = lambda v: F.min(F.col(v).cast("string")).cast("bigint")
    return combinations.groupBy("beat").agg(
        F.min("objectid").alias("objectid"),
        F.sum("n").alias("source_feature_count"),
        F.sum(F.when(F.col("name").isNull(), F.col("n")).otherwise(0)).alias("source_null_name_count"),
        by_text("div").alias("div"),
        by_text("serv").alias("serv"),
        F.min("name").alias("name"),
        conflicting("div").alias("div_conflict"),
        conflicting("serv").alias("serv_conflict"),
        F.coalesce(F.min("name") != F.max("name"), F.lit(False)).alias("name_conflict"),
    )


CONFLICT_FIELDS = ("div", "serv", "name")


def conflicts(consolidated: DataFrame) -> DataFrame:
    """One row per area and conflicting field, with the value a non-strict run uses."""
    found = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(f"{f}_conflict"),
                    F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("chosen")),
                )
                for f in CONFLICT_FIELDS
            ]
        )
    )
    return consolidated.select("beat", F.explode(found).alias("c")).select("beat", "c.field", "c.chosen")


def conflict_values(features: DataFrame, consolidated: DataFrame) -> DataFrame:
    """The distinct values behind each conflict, as rows."""
    values = F.array(
        F.struct(F.lit("div").alias("field"), F.col("div").cast("string").alias("value")),
        F.struct(F.lit("serv").alias("field"), F.col("serv").cast("string").alias("value")),
        F.struct(F.lit("name").alias("field"), F.col("name").alias("value")),
    )
    rows = features.select("beat", F.explode(values).alias("v")).select("beat", "v.field", "v.value")
    named_null = (F.col("field") == "name") & F.col("value").isNull()
    return rows.filter(~named_null).distinct().join(conflicts(consolidated).select("beat", "field"), ["beat", "field"], "left_semi")


def source_ids(features: DataFrame) -> DataFrame:
    """Area and source object id, one row per feature: the id list in any length."""
    return features.select("beat", "objectid")


def inline_source_ids(features: DataFrame) -> DataFrame:
    """Sorted id list of every area, complete whatever its length.

    The list is part of an area's row, so this is one array of bigints in one task per
    area: 8 bytes a feature. ``source_ids`` has the same ids as rows.
    """
    return source_ids(features).groupBy("beat").agg(F.array_sort(F.collect_list("objectid")).alias("source_objectids"))