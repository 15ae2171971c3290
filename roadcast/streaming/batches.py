"""Captures as a stream: every landed batch file is read once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from roadcast.operators.observations import observation_rows, parse_observations
from roadcast.specs import BATCH_SCHEMA


def stream_batches(spark: SparkSession, prefix: str, max_files: int | None = None) -> DataFrame:
    """Envelopes as they land under ``prefix``; ``max_files`` limits one micro-batch, not the stream."""
    reader = spark.readStream.schema(BATCH_SCHEMA).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.json(prefix)


def stream_observations(spark: SparkSession, prefix: str, max_files: int | None = None) -> DataFrame:
    """One typed row per observation. Row-wise only, so no state is kept."""
    rows = observation_rows(stream_batches(spark, prefix, max_files)).drop("observation")
    return parse_observations(rows)


def drain(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append everything available to a parquet folder and stop; reruns resume at the checkpoint."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
