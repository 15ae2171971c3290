"""JSON inputs: feature collections, the station list, mappings, responses, batch files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadcast.specs import (
    BATCH_SCHEMA,
    MAPPING_READ_SCHEMA,
    OBSERVATION_LOG_SCHEMA,
    RESPONSE_SCHEMA,
    STATION_SCHEMA,
    STATIONS,
)


def read_collections(spark: SparkSession, path: str) -> DataFrame:
    """One row per GeoJSON container: ``source`` file, ``type``, and ``features`` (variant until checked)."""
    return (
        spark.read.schema("type string, features variant")
        .json(path, multiLine=True)
        .select(F.col("_metadata.file_path").alias("source"), "type", "features")
    )


def read_feature_lines(spark: SparkSession, path: str) -> DataFrame:
    """Newline-delimited features, for inputs too large for one document; files are splittable.

    ``feature_index`` identifies a feature but is not a position in a file.
    """
    return (
        spark.read.schema("properties variant, geometry variant")
        .json(path)
        .select(F.monotonically_increasing_id().alias("feature_index"), "properties", "geometry")
    )


def default_stations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *row) for i, row in enumerate(STATIONS)], STATION_SCHEMA)


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """The fields of a mapping the capture needs, from one JSON array or from JSON lines.

    The first non-blank line tells the form: an array begins with a bracket.
    """
    first = spark.read.text(path).filter(F.trim("value") != "").limit(1).collect()
    document = bool(first) and first[0]["value"].lstrip().startswith("[")
    return spark.read.schema(MAPPING_READ_SCHEMA).json(path, multiLine=document)


def read_responses(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed station replies with status and body text; a station may have several, in order of ``received_at``."""
    return spark.read.format(fmt).schema(RESPONSE_SCHEMA).load(path)


def read_observation_log(spark: SparkSession, path: str) -> DataFrame:
    """Captures that were written as rows."""
    return spark.read.schema(OBSERVATION_LOG_SCHEMA).json(path)


def read_batches(spark: SparkSession, prefix: str) -> DataFrame:
    """Envelopes of all batch files below ``prefix``."""
    return spark.read.schema(BATCH_SCHEMA).option("recursiveFileLookup", "true").json(prefix)
