"""Packing token sequences by minimum bin slack over the histogram of lengths.

Only how many pieces there are of each length decides how well they pack, and there are
at most ``capacity`` lengths, so the plan is made from a table that does not grow with
the data. One bin after another: the longest remaining piece opens it, and a subset-sum
dynamic programme over the remaining lengths, one bit a sum, finds the fullest feasible
combination beside it. That combination is removed as often as the counts allow, which
is what repeating the step would do. Spark then numbers the pieces of each length and
looks up which bin and place the plan gives to that number.

Defined cases: a null or empty text is its end id alone; repeated rows are packed each;
a null id is a document like any other; an empty table packs into nothing. Columns other
than the id and the text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roadcast.llm.common import regrouped, spread, stored
from roadcast.llm.tokens import WordEncoder

SALT_ROWS = 500


# --- the plan --------------------------------------------------------------------------


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths with the greatest sum up to ``room``: length to times.

    Bit ``s`` of ``reach`` says that the lengths so far can sum to ``s``. Long lengths
    come first, and the way back takes a length only where the sum needs it.
    """
    mask = (1 << room + 1) - 1
    reach, steps = 1, []
    for length in sorted((n for n, c in counts.items() if c and n <= room), reverse=True):
        left, power = min(counts[length], room // length), 1
        while left:
            take = min(power, left)
            steps.append((length, take, reach))
            reach |= reach << length * take & mask
            left, power = left - take, power * 2
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            chosen[length] = chosen.get(length, 0) + take
            at -= length * take
    return chosen


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """``(pattern, times)``: so many bins that hold each length of the pattern so many times."""
    counts = {n: c for n, c in histogram.items() if c}
    plan = []
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        pattern = fullest(counts, capacity - longest)
        counts[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(counts[n] // k for n, k in pattern.items())
        for n, k in pattern.items():
            counts[n] -= k * times
            if not counts[n]:
                del counts[n]
        plan.append((pattern, times))
    return plan


def plan_table(plan: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """For each length rows ``(first rank, first bin, pieces a bin, offset)``, ascending by rank."""
    rows: dict[int, list] = {}
    used: dict[int, int] = {}
    first_bin = 0
    for pattern, times in plan:
        offset = 0
        for length in sorted(pattern, reverse=True):
            each = pattern[length]
            rows.setdefault(length, []).append((used.get(length, 0), first_bin, each, offset))
            used[length] = used.get(length, 0) + each * times
            offset += each * length
        first_bin += times
    return {length: np.array(found, np.int64) for length, found in rows.items()}


# --- pieces ----------------------------------------------------------------------------


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    capacity: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``): documents beyond ``capacity`` ids are cut.

    The first piece of a cut document takes what does not fill the others.
    """
    rows = spread(docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")), "doc_id")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(tokenizer_path)
        for batch in regrouped(batches, "text"):
            ids, bounds = encoder.encode(batch.column("text").to_pylist(), end_id)
            raw = memoryview(ids.astype("<u4").tobytes())
            sizes = np.diff(bounds)
            parts = (sizes + capacity - 1) // capacity
            row = np.repeat(np.arange(len(sizes)), parts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
            short = sizes - (parts - 1) * capacity
            start = np.where(piece == 0, 0, short[row] + (piece - 1) * capacity)
            length = np.where(piece == 0, short[row], capacity)
            cuts = [raw[4 * a : 4 * (a + n)] for a, n in zip((bounds[row] + start).tolist(), length.tolist(), strict=True)]
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(row)),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(c) for c in cuts], pa.int64()),
            }
            if keep_ids:
                columns["ids"] = pa.array([c.tobytes() for c in cuts], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    ids = ", ids binary" if keep_ids else ""
    return rows.mapInArrow(of, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long{ids}")


# --- places ----------------------------------------------------------------------------


def ranked(pieces: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """Number the pieces of each length from 0 in ``rank``.

    A length is numbered in ``salt`` groups of about ``SALT_ROWS`` rows, so that no task gets
    all pieces of a common length; the groups' sizes give where each begins.
    """
    salts = [1 + histogram.get(n, 0) // SALT_ROWS for n in range(max(histogram, default=0) + 1)]
    order = ("doc_id", "piece", "start", "ids_crc32")
    own = F.get(F.array(*map(F.lit, salts)), F.col("length").cast("int"))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), own))
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = F.coalesce(
        F.sum("n").over(W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    begins = sizes.select("length", "salt", before.alias("before"))
    inside = F.row_number().over(W.partitionBy("length", "salt").orderBy(*order)) - 1
    numbered = salted.withColumn("inside", inside)
    return numbered.join(begins, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("inside")).drop(
        "salt", "inside", "before"
    )


def packed(pieces: DataFrame, capacity: int) -> DataFrame:
    """Stored ``pieces`` with ``sequence_id`` and ``offset`` added."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if histogram and not 0 < min(histogram) <= max(histogram) <= capacity:
        raise ValueError("lengths must lie between 1 and the capacity")
    table = plan_table(plan_bins(histogram, capacity))
    numbered = ranked(pieces, histogram)
    schema = numbered.drop("rank").schema.add("sequence_id", "long").add("offset", "long")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for n in np.unique(length).tolist():
                rows = np.flatnonzero(length == n)
                plan = table[n]
                found = plan[np.searchsorted(plan[:, 0], rank[rows], side="right") - 1]
                inside = rank[rows] - found[:, 0]
                sequence[rows] = found[:, 1] + inside // found[:, 2]
                offset[rows] = found[:, 3] + inside % found[:, 2] * n
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in schema.names[:-2]), pa.array(sequence), pa.array(offset)], names=schema.names
            )

    return numbered.mapInArrow(of, schema)


def packed_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 2048, keep_ids: bool = False
) -> DataFrame:
    pieces = stored(token_pieces(docs, tokenizer_path, end_id, capacity, keep_ids=keep_ids), "pieces")
    return packed(pieces, capacity)
