"""Scans whose tasks need to know what lies before their split.

A first scan sums up each split in a row, windows over these rows tell where every split
starts (its state), and a second scan gets the state of its split beside every row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: States of so many splits are sent to all executors (about 50 bytes each); beyond, rows are joined and sorted.
MOST_SENT = 1_000_000


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """Parts of batches that belong to one split, and whether the split begins with it."""
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        file = batch.column("_file").dictionary_encode().indices.to_numpy()
        block = batch.column("_block").to_numpy()
        edges = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
        for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            part = batch.slice(a, b - a)
            split = part.column("_file")[0].as_py(), int(block[a])
            yield part, split != current
            current = split


def before(*partition: str) -> WindowSpec:
    """The splits of a file that come before the one at hand."""
    return Window.partitionBy(*(partition or ("_file",))).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)


def with_states(rows: DataFrame, states: DataFrame) -> DataFrame:
    """``rows`` of a scan, in its order, with the columns of ``states`` (``_file, _block`` and more).

    Both scans must find the same splits; a row whose split has no state fails the job.
    """
    sent = states.withColumn("_known", F.lit(True))
    if sent.count() <= MOST_SENT:
        joined = rows.join(F.broadcast(sent), ["_file", "_block"], "left")
    else:
        placed = rows.withColumn("_line", F.monotonically_increasing_id()).join(sent, ["_file", "_block"], "left")
        joined = placed.repartition("_file", "_block").sortWithinPartitions("_file", "_block", "_line").drop("_line")
    missing = F.raise_error(F.concat(F.lit("no state for this split of "), F.col("_file"))).cast("boolean")
    return joined.filter(F.coalesce("_known", missing)).drop("_known")
