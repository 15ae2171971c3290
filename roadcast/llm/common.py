"""What the operators share: scratch tables, folds, Arrow chunking, file systems."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadcast.session import scratch_root

CHUNK_BYTES = 4 << 20


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder below the shared scratch root; it has a scheme only if the root has one."""
    return f"{scratch_root(spark)}/llm/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back, which cuts the lineage."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(id_column: str, parts: int) -> Column:
    """crc32 of the id's text modulo ``parts``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string")) % parts


def drawn(df: DataFrame, id_column: str, rows: int) -> DataFrame:
    """About ``rows`` rows by the hash of their id, never more than twice as many; all if there are fewer.

    A count and a filter, so that no task sends more than its share to the driver.
    """
    total = df.count()
    if total <= rows:
        return df
    return df.filter(F.xxhash64(id_column) / F.lit(2.0**64) + 0.5 <= rows / total).limit(2 * rows)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal rows over the cores when the input has fewer partitions than there are cores.

    ``key`` must be deterministic so that a retried task sees the rows it saw before.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, F.xxhash64(key))


def kept(key: tuple, make: Callable[[], object]) -> object:
    """The one large object (encoder, word table) that this worker process keeps between tasks.

    A task of another kind lets it go, so a worker that is used again never holds those of several operators.
    Functions travel to workers by value and with them their modules' variables, so the place is a module
    entry that only exists in the process.
    """
    place = sys.modules.setdefault("_roadcast_kept", types.ModuleType("_roadcast_kept")).__dict__
    if place.get("key") != key:
        place.update(key=None, held=None)
        place.update(held=make(), key=key)
    return place["held"]


def let_go() -> None:
    """Free what this worker keeps, and give freed memory back, before a task that needs none of it."""
    kept(("nothing",), dict)
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def row_chunks(batch: pa.RecordBatch, column: str, budget: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose ``column`` holds about ``budget`` bytes; a longer row stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > budget:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def regrouped(batches: Iterator[pa.RecordBatch], column: str, budget: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of about ``budget`` bytes in ``column``: large ones are cut, small ones put together."""
    waiting: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        for part in row_chunks(batch, column, budget):
            waiting.append(part)
            held += pc.sum(pc.binary_length(part.column(column))).as_py() or 0
            if held >= budget:
                yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
                waiting, held = [], 0
    if waiting:
        yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()


def file_system(uri: str):
    """``(pyarrow file system, path)`` of a folder given as a Hadoop-style URI or a plain path.

    Opened in the task that uses it. ``s3a`` and ``s3n`` are read as ``s3``.
    """
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    for old in ("s3a://", "s3n://"):
        if uri.startswith(old):
            uri = "s3://" + uri[len(old) :]
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def write_whole(uri: str, chunks: Iterator[bytes]) -> int:
    """Write a file under a temporary name and move it into place; returns its length.

    A retried or speculative task writes the same bytes, so whichever moves last leaves the same file.
    """
    system, path = file_system(uri)
    folder = path.rpartition("/")[0]
    system.create_dir(folder, recursive=True)
    partial = f"{folder}/.{uuid.uuid4().hex}"
    length = 0
    with system.open_output_stream(partial, compression=None) as out:
        for chunk in chunks:
            out.write(chunk)
            length += len(chunk)
    system.move(partial, path)
    return length
