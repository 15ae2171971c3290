"""Releases: the tables of a load change together, by one rename.

Below the warehouse root every run of a table is a folder of its own, and ``releases/`` holds a
small file per release that names the run of each table. Tables are views: each reads its
runs' table and keeps the run that the newest release names, so all of them move at the moment
the release file gets its name. That rename is the only step readers can see; whatever a killed
load leaves behind (folders, registered runs, a file without its final name) is not looked at.
A release number can be taken once, so of two loads at the same time one fails.

Release files are read at every query; the runs of a table are partitions in the catalog.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from roadcast.sources.files import _hadoop_path
from roadcast.specs import DatasetSpec

FOLDER = "releases"
FORM = "version BIGINT, runs MAP<STRING, STRING>, row_counts MAP<STRING, BIGINT>"


class ReleaseConflict(RuntimeError):
    """Another load has released in the meantime."""


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def runs_table(spec: DatasetSpec) -> str:
    return f"{spec.table}_runs"


def _releases(root: str) -> str:
    return f"{root.rstrip('/')}/{FOLDER}"


def latest(spark: SparkSession, root: str) -> dict:
    """The newest release: ``version`` (0 if there is none), ``runs`` and ``row_counts`` by table."""
    fs, folder = _hadoop_path(spark, _releases(root))
    if not fs.exists(folder):
        return {"version": 0, "runs": {}, "row_counts": {}}
    rows = spark.read.text(_releases(root)).select(F.from_json("value", FORM).alias("r"))
    found = rows.agg(F.max_by("r", "r.version").alias("r")).first()["r"]
    return found.asDict() if found else {"version": 0, "runs": {}, "row_counts": {}}


def install(spark: SparkSession, specs: Iterable[DatasetSpec], root: str) -> None:
    """Create schemas, runs' tables and views where they are absent. Views of a root without releases are empty."""
    fs, folder = _hadoop_path(spark, _releases(root))
    fs.mkdirs(folder)
    for spec in specs:
        schema = spec.table.rpartition(".")[0]
        if schema:
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quoted(schema)}")
        if spark.catalog.tableExists(spec.table) and spark.catalog.getTable(spec.table).tableType != "VIEW":
            raise RuntimeError(f"{spec.table} is a table of its own; rename it before it is loaded by releases")
        columns = [f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in spec.table_schema().fields]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {_quoted(runs_table(spec))} ({', '.join(columns)}, run STRING) "
            f"USING parquet PARTITIONED BY (run) LOCATION '{root.rstrip('/')}/{spec.table}'"
        )
        newest = f"SELECT max_by(r.runs['{spec.table}'], r.version) FROM (SELECT from_json(value, '{FORM}') AS r FROM text.`{_releases(root)}`)"
        names = ", ".join(_quoted(f.name) for f in spec.table_schema().fields)
        spark.sql(
            f"CREATE OR REPLACE VIEW {_quoted(spec.table)} AS SELECT {names} FROM {_quoted(runs_table(spec))} WHERE run = ({newest})"
        )


def register_run(spark: SparkSession, spec: DatasetSpec, folder: str) -> str:
    """Make a written folder known as a run. No reader sees it before a release names it."""
    run = folder.rstrip("/").rpartition("/")[2]
    spark.sql(f"ALTER TABLE {_quoted(runs_table(spec))} ADD IF NOT EXISTS PARTITION (run = '{run}') LOCATION '{folder}'")
    return run


def forget_run(spark: SparkSession, spec: DatasetSpec, folder: str) -> None:
    """Undo ``register_run``."""
    run = folder.rstrip("/").rpartition("/")[2]
    if spark.catalog.tableExists(runs_table(spec)):
        spark.sql(f"ALTER TABLE {_quoted(runs_table(spec))} DROP IF EXISTS PARTITION (run = '{run}')")


def release(spark: SparkSession, root: str, base: dict, runs: dict[str, str], row_counts: dict[str, int]) -> int:
    """Name the runs of a release that follows ``base``; tables it does not mention keep theirs. Returns its number."""
    version = base["version"] + 1
    content = {"version": version, "runs": {**base["runs"], **runs}, "row_counts": {**base["row_counts"], **row_counts}}
    fs, partial = _hadoop_path(spark, f"{_releases(root)}/.{uuid.uuid4().hex}")
    stream = fs.create(partial, False)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    final = _hadoop_path(spark, f"{_releases(root)}/release-{version:010d}.json")[1]
    if fs.exists(final) or not fs.rename(partial, final):
        fs.delete(partial, False)
        raise ReleaseConflict(f"release {version} below {root} exists already")
    return version
