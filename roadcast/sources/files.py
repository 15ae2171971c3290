"""Paths: existence, listing, and the dated location of a dataset's file."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from roadcast.specs import DatasetSpec


class SourceMissing(RuntimeError):
    """One or more source files are absent; the message lists every one."""


def _hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop_path(spark, path)
    return fs.exists(target)


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The file itself, or the files of a folder by name; hidden ones are left out."""
    fs, target = _hadoop_path(spark, path)
    found = [s for s in fs.listStatus(target) if s.isFile() and s.getPath().getName()[0] not in "_."]
    return sorted(s.getPath().toString() for s in found)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that the calling job has made itself."""
    fs, target = _hadoop_path(spark, path)
    fs.delete(target, True)


def delete_file(spark: SparkSession, path: str) -> None:
    """Remove a file that the calling job has made itself, if it is there."""
    fs, target = _hadoop_path(spark, path)
    fs.delete(target, False)


def first_bytes(spark: SparkSession, path: str, count: int = 3) -> bytes:
    fs, target = _hadoop_path(spark, path)
    stream = fs.open(target)
    try:
        read = [stream.read() for _ in range(count)]
    finally:
        stream.close()
    return bytes(b for b in read if b >= 0)


def list_files(spark: SparkSession, prefix: str, pattern: str = "*") -> DataFrame:
    """Path, size and modification time of every file under ``prefix``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(prefix)
        .select("path", "length", "modificationTime")
    )


def dated_source(root: str, run_date: date, spec: DatasetSpec) -> str:
    root = root.rstrip("/")
    if not root:
        raise ValueError("a source root is required")
    return f"{root}/{run_date:%Y-%m-%d}/{spec.file_name}"


def resolve_sources(
    spark: SparkSession, root: str, run_date: date, specs: Iterable[DatasetSpec]
) -> dict[str, str]:
    """Path of every dataset, or one error naming all absent files."""
    paths = {spec.name: dated_source(root, run_date, spec) for spec in specs}
    absent = [f"{name}: {path}" for name, path in paths.items() if not path_exists(spark, path)]
    if absent:
        raise SourceMissing("source files not found: " + "; ".join(absent))
    return paths
