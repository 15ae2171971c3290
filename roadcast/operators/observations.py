"""Station responses: requested set, success and failure, batch envelopes, typed observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadcast.functions.times import batch_key, iso_utc
from roadcast.specs import (
    BATCH_PREFIX,
    BATCH_SCHEMA_VERSION,
    BATCH_SOURCE,
    MAPPING_REQUIRED,
    MEASUREMENTS,
    OBSERVATION_SCHEMA,
)

def mapping_violations(mapping: DataFrame) -> DataFrame:
    """Rows of a mapping that lack a required field, one row per missing field."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in MAPPING_REQUIRED]))
    return mapping.select("*", F.explode(missing).alias("missing_field"))


def requested_stations(mapping: DataFrame) -> DataFrame:
    """Distinct non-empty station ids."""
    return mapping.select("station_id").filter(F.col("station_id") != "").distinct()


def last_attempt(attempts: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One response per station and capture: the last try decides, as after retries.

    ``max_by`` keeps one row per group and combines before the shuffle, so a station
    with very many tries costs no more than one row per task.
    """
    kept = [c for c in attempts.columns if c not in keys]
    return (
        attempts.groupBy(*keys)
        .agg(F.max_by(F.struct(*kept), F.struct(*order)).alias("last"))
        .select(*keys, *[F.col("last")[c].alias(c) for c in kept])
    )


def response_failed(status: Column, body: Column) -> Column:
    """No response, an error status, or a body that is not JSON."""
    return status.isNull() | (status >= 400) | F.try_parse_json(body).isNull()


def split_responses(requested: DataFrame, responses: DataFrame, keys: Sequence[str] = ("station_id",)) -> DataFrame:
    """Every requested station with ``is_failed``; a station without a response has failed."""
    keys = list(keys)
    return requested.join(responses, keys, "left").select(
        *keys,
        "http_status",
        "body",
        response_failed(F.col("http_status"), F.col("body")).alias("is_failed"),
    )


def capture_metrics(split: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Requested, succeeded and failed stations, overall or per capture."""
    return split.groupBy(*by).agg(
        F.count("*").alias("total_stations"),  # a split has one row per station and capture
        F.count_if(~F.col("is_failed")).alias("succeeded"),
        F.count_if(F.col("is_failed")).alias("failed"),
    )


def batch_documents(split: DataFrame, captured_at: str | Column = "captured_at") -> DataFrame:
    """One envelope per capture.

    A document holds one entry per requested station, so a group is bounded by the
    station list, not by the data. ``observation_log`` has the same content as rows,
    for lists that no single document should hold.
    """
    clock = F.col(captured_at) if isinstance(captured_at, str) else captured_at
    ok = ~F.col("is_failed")
    grouped = split.groupBy(clock.alias("captured_at")).agg(
        F.array_sort(F.collect_set("station_id")).alias("stations_requested"),
        F.array_sort(F.collect_set(F.when(F.col("is_failed"), F.col("station_id")))).alias("stations_failed"),
        F.array_sort(F.collect_list(F.when(ok, F.struct("station_id", "body")))).alias("ok"),
    )
    return grouped.select(
        "captured_at",
        iso_utc(F.col("captured_at")).alias("captured_at_utc"),
        "stations_requested",
        "stations_failed",
        F.lit(BATCH_SOURCE).alias("source"),
        F.lit(BATCH_SCHEMA_VERSION).alias("schema_version"),
        F.transform("ok", lambda o: F.try_parse_json(o.body)).alias("observations"),
    )


BATCH_FIELDS = ("captured_at_utc", "stations_requested", "stations_failed", "source", "schema_version", "observations")


def batch_json(batches: DataFrame, prefix: str = BATCH_PREFIX) -> DataFrame:
    """Key and JSON text of each envelope, fields in their fixed order."""
    return batches.select(
        batch_key(F.col("captured_at"), prefix).alias("batch_key"),
        F.to_json(F.struct(*BATCH_FIELDS), {"ignoreNullFields": "false"}).alias("document"),
    )


def observation_log(split: DataFrame, captured_at: str | Column = "captured_at") -> DataFrame:
    """The same content as rows, for station lists of any length: one row per requested station."""
    clock = F.col(captured_at) if isinstance(captured_at, str) else captured_at
    return split.select(
        iso_utc(clock).alias("captured_at_utc"),
        F.to_date(clock).alias("capture_date"),
        "station_id",
        "is_failed",
        F.lit(BATCH_SOURCE).alias("source"),
        F.lit(BATCH_SCHEMA_VERSION).alias("schema_version"),
        F.when(~F.col("is_failed"), F.col("body")).alias("body"),
    )


def log_rows(log: DataFrame) -> DataFrame:
    """``observation_rows`` of captures that were written as rows."""
    return log.filter("NOT is_failed").select(
        "captured_at_utc", "source", "schema_version", F.to_json(F.try_parse_json("body")).alias("body")
    )


def observation_rows(batches: DataFrame) -> DataFrame:
    """One row per observation of each envelope; works on batch and streaming frames."""
    return batches.select(
        "captured_at_utc",
        "source",
        "schema_version",
        F.explode("observations").alias("observation"),
    ).withColumn("body", F.to_json("observation"))


def parse_observations(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Typed columns of an observation body. Unknown keys are ignored.

    ``is_valid`` is false where a required field is missing; the row is kept.
    """
    o = F.col("o")
    p = F.col("o.properties")
    columns = [
        o["id"].alias("observation_id"),
        o["type"].alias("feature_type"),
        p["stationId"].alias("station_id"),
        p["stationName"].alias("station_name"),
        p["timestamp"].alias("observed_at"),
        F.get(o["geometry"]["coordinates"], F.lit(0)).alias("lon"),
        F.get(o["geometry"]["coordinates"], F.lit(1)).alias("lat"),
        p["elevation"]["unitCode"].alias("elevation_unit"),
        p["elevation"]["value"].alias("elevation"),
        p["textDescription"].alias("text_description"),
        p["icon"].alias("icon"),
        F.coalesce(p["presentWeather"], F.array().cast("array<variant>")).alias("present_weather"),
    ]
    for m in MEASUREMENTS:
        snake = MEASUREMENT_NAMES[m]
        columns += [
            p[m]["value"].alias(snake),
            p[m]["unitCode"].alias(f"{snake}_unit"),
            p[m]["qualityControl"].alias(f"{snake}_qc"),
        ]
    required = [o["id"], o["type"], o["geometry"]["type"], o["geometry"]["coordinates"]]
    required += [p["stationId"], p["stationName"], p["timestamp"]]
    valid = F.lit(True)
    for field in required:
        valid = valid & field.isNotNull()
    others = [c for c in bodies.columns if c != body]
    parsed = bodies.withColumn("o", F.from_json(body, OBSERVATION_SCHEMA))
    return parsed.select(*others, *columns, p["cloudLayers"].alias("cloud_layers"), valid.alias("is_valid"))


# Column name of each measurement in the flat form.
MEASUREMENT_NAMES = {
    "temperature": "temperature",
    "windDirection": "wind_direction",
    "windSpeed": "wind_speed",
    "windGust": "wind_gust",
    "visibility": "visibility",
    "precipitationLastHour": "precipitation_1h",
    "precipitationLast3Hours": "precipitation_3h",
    "precipitationLast6Hours": "precipitation_6h",
}


def cloud_layers(parsed: DataFrame) -> DataFrame:
    """One row per cloud layer; an observation without layers keeps one row of nulls."""
    return parsed.select(
        "observation_id", "station_id", F.posexplode_outer("cloud_layers").alias("layer", "c")
    ).select(
        "observation_id",
        "station_id",
        "layer",
        F.col("c.amount").alias("amount"),
        F.col("c.base.value").alias("base"),
        F.col("c.base.unitCode").alias("base_unit"),
    )
