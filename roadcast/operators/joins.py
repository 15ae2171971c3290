"""Joins that the reference announces and does not build (beyond its present behaviour)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def details_with_report(details: DataFrame, basic: DataFrame, columns: Sequence[str], prefix: str = "report_") -> DataFrame:
    """Every child record with ``columns`` of its parent, null where there is none.

    One equi-join on ``report_id``; its large partitions are split at run time.
    """
    parents = basic.select("report_id", *[F.col(c).alias(f"{prefix}{c}") for c in columns])
    return details.join(parents, "report_id", "left")


def beat_weather(mapping: DataFrame, observations: DataFrame) -> DataFrame:
    """Areas with every observation of the station they are mapped to.

    ``mapping`` has ``beat, station_id``; ``observations`` has ``station_id, captured_at``
    and whatever else is to be kept, one row per station and capture.
    """
    pairs = mapping.select("beat", "station_id").filter(F.col("station_id") != "").distinct()
    return pairs.join(observations, "station_id")
