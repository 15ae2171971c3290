"""Table and document sinks."""

from __future__ import annotations

import shutil
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadcast.operators.observations import batch_json
from roadcast.sources.files import _hadoop_path, delete_file, delete_folder
from roadcast.sources.releases import install
from roadcast.specs import DatasetSpec


def create_tables(spark: SparkSession, specs: Iterable[DatasetSpec], warehouse: str | None = None) -> None:
    """Create schema and tables, empty before the first load, where absent; errors are raised, not logged away."""
    install(spark, specs, warehouse or spark.conf.get("spark.sql.warehouse.dir"))


def write_run(df: DataFrame, root: str, table: str) -> str:
    """Write the rows of one run to a fresh folder and return it. No reader sees it yet."""
    target = f"{root.rstrip('/')}/{table}/run-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(target)
    return target


def jdbc_options(batch_size: int | str = 2000) -> dict[str, str]:
    """Options of a full-refresh database load: truncate, then insert in batches."""
    try:
        size = int(batch_size)
    except ValueError as exc:
        raise ValueError(f"batch size must be a whole number, got {batch_size!r}") from exc
    if size <= 0:
        raise ValueError(f"batch size must be positive, got {size}")
    return {"truncate": "true", "batchsize": str(size)}


def write_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 2000, **properties: str) -> None:
    df.write.mode("overwrite").options(**jdbc_options(batch_size)).jdbc(url, table, properties=properties)


def write_mapping_rows(mapping: DataFrame, path: str) -> None:
    """The mapping as JSON lines, in parallel."""
    mapping.write.mode("overwrite").json(path)


def mapping_document(mapping: DataFrame) -> DataFrame:
    """Lines of one JSON array ordered by area: ``section, beat, value``.

    Rows stay rows; only the first carries no leading comma, found by a scalar subquery.
    """
    first = mapping.select(F.min("beat")).scalar()
    lead = F.when(F.col("beat") == first, "  ").otherwise(", ")
    body = mapping.select(
        F.lit(1).alias("section"),
        "beat",
        F.concat(lead, F.to_json(F.struct(*mapping.columns), {"ignoreNullFields": "false"})).alias("value"),
    )
    bracket = lambda section, text: mapping.sparkSession.range(1).select(
        F.lit(section).alias("section"), F.lit(None).cast("bigint").alias("beat"), F.lit(text).alias("value")
    )
    return body.unionByName(bracket(0, "[")).unionByName(bracket(2, "]"))


PARTS = "part string, target string, at long, size long"


def _copied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Write each part into its place of the target. A repeated task writes the same bytes to the same place."""
    for batch in batches:
        for row in batch.to_pylist():
            with open(row["part"], "rb") as source, open(row["target"], "r+b") as target:
                target.seek(row["at"])
                shutil.copyfileobj(source, target, 1 << 20)
        yield batch


def join_parts(spark: SparkSession, folder: str, target: str) -> None:
    """Put the part files of a folder together as one file, in order of their names, and remove the folder.

    No byte passes the driver: a file system that can concatenate does so (only names move), and in a
    shared folder every part has its offset, the sum of the sizes before it, and is copied there by a task.
    """
    fs, final = _hadoop_path(spark, target)
    partial = _hadoop_path(spark, f"{target}-{uuid.uuid4().hex}")[1]
    status = {s.getPath().getName(): s for s in fs.listStatus(_hadoop_path(spark, folder)[1])}
    parts = [status[name] for name in sorted(status) if name.startswith("part-") and status[name].getLen()]
    fs.create(partial, False).close()
    if fs.getUri().getScheme() == "file":
        rows, at = [], 0
        for part in parts:
            rows.append((part.getPath().toUri().getPath(), partial.toUri().getPath(), at, part.getLen()))
            at += part.getLen()
        tasks = spark.createDataFrame(rows, PARTS).repartition(max(1, len(rows)), "part")
        tasks.mapInArrow(_copied, PARTS).write.format("noop").mode("overwrite").save()
        delete_file(spark, partial.getParent().toString() + f"/.{partial.getName()}.crc")  # of the empty file
    elif parts:
        paths = spark._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(parts))
        for i, part in enumerate(parts):
            paths[i] = part.getPath()
        fs.concat(partial, paths)
    if fs.exists(final):
        fs.delete(final, True)
    fs.rename(partial, final)
    delete_folder(spark, folder)


def write_mapping_document(mapping: DataFrame, path: str) -> None:
    """One file holding one JSON array: sorted parts are written by many tasks and then joined."""
    folder = f"{path}-parts-{uuid.uuid4().hex}"
    mapping_document(mapping).orderBy("section", "beat").select("value").write.text(folder)
    join_parts(mapping.sparkSession, folder, path)


def write_batches(batches: DataFrame, prefix: str, by_capture: bool = True) -> None:
    """Envelopes as JSON lines.

    By capture there is one file per envelope, under ``capture_date=.../capture=...``,
    and a rerun replaces its own captures only. Otherwise files are kept whole per
    day and appended, which suits loading many captures at once.
    """
    keyed = batch_json(batches).select(
        F.regexp_extract("batch_key", "([^/]+)/[^/]+$", 1).alias("capture_date"),
        F.regexp_extract("batch_key", r"([^/]+)\.json$", 1).alias("capture"),
        F.col("document").alias("value"),
    )
    if by_capture:
        writer = keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("capture_date", "capture").text(prefix)
    else:
        # rebalancing joins small outputs and splits a day that holds most of the rows
        days = keyed.drop("capture").hint("rebalance", "capture_date")
        days.write.mode("append").partitionBy("capture_date").text(prefix)


def write_observation_log(log: DataFrame, path: str) -> None:
    """Row form of the captures, a folder each; a rerun replaces its own captures only."""
    capture = F.regexp_replace(F.regexp_replace("captured_at_utc", r"\+00:00$", "Z"), ":", "-")
    writer = log.withColumn("capture", capture).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("capture_date", "capture").json(path)
