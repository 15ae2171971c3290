"""One capture: requested stations, landed responses, batch document."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadcast.operators import observations as obs
from roadcast.plans.mapping_job import reject
from roadcast.sources.documents import read_mapping
from roadcast.sources.sinks import write_batches, write_observation_log
from roadcast.specs import BATCH_PREFIX


def capture_split(mapping: DataFrame, responses: DataFrame, captured_at: datetime) -> DataFrame:
    """Every requested station with its last response, success flag and the capture's UTC clock.

    Of several replies the one received last decides; of those received together, or without
    a time, the one with the greatest status and body.
    """
    if captured_at.tzinfo is None:
        raise ValueError("captured_at needs a time zone")
    clock = captured_at.astimezone(timezone.utc).replace(tzinfo=None).isoformat()
    if "received_at" not in responses.columns:
        responses = responses.withColumn("received_at", F.lit(None).cast("timestamp"))
    last = obs.last_attempt(responses, ["station_id"], ["received_at", "http_status", "body"])
    split = obs.split_responses(obs.requested_stations(mapping), last)
    return split.withColumn("captured_at", F.lit(clock).cast("timestamp_ntz"))


def capture(
    spark: SparkSession,
    mapping_path: str,
    responses: DataFrame,
    output_root: str,
    captured_at: datetime | None = None,
    document: bool = True,
) -> DataFrame:
    """Write one capture below ``output_root`` and return its metrics.

    A failed station does not fail the capture. The capture is one document, or without
    ``document`` rows with the same content (``obs.log_rows`` reads them). A rerun
    replaces the capture in either form.
    """
    mapping = read_mapping(spark, mapping_path)
    reject(obs.mapping_violations(mapping), "mapping row")
    split = capture_split(mapping, responses, captured_at or datetime.now(timezone.utc))
    prefix = f"{output_root.rstrip('/')}/{BATCH_PREFIX}"
    if document:
        write_batches(obs.batch_documents(split), prefix)
    else:
        write_observation_log(obs.observation_log(split), f"{prefix}_log")
    return obs.capture_metrics(split)
