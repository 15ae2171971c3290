"""CSV records of files of any size, cut by many tasks although cells may hold line breaks.

A file is read as lines, each split by its own task. Whether a line begins inside a quoted
cell depends on everything before it, but only through one bit, so a line is a function of
two states: where it leaves a reader that starts at a record, and one that starts inside a
quoted cell. Both come from two regular expressions on the line alone. The functions of a
split are composed in its task (``split_states``: a row per split), the splits' functions are
composed by windows over those few rows, and with its starting state known every task cuts
its own records (``records``). Only pieces of records that cross a split's edge are
brought together.

The rules are those of the usual reader of quoted text with doubled quotes: a quote opens a
cell only at its start, a doubled quote inside is one quote, text after the closing quote
belongs to the cell and its quotes are literal, blank lines between records are skipped, the end of
the file closes an open cell. Line ends inside cells become ``\\n``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadcast.sources.splits import before, runs, with_states

# All loops are possessive, so matching neither goes back nor deep.
_BODY = r'[^"]*+(?:""[^"]*+)*+'
_CELL = rf'(?:"{_BODY}"[^,]*+|[^",][^,]*+)?+'
OPENS = rf'\A(?:{_CELL},)*+"{_BODY}\z'
STAYS = rf'\A{_BODY}(?:"[^,]*+,(?:{_CELL},)*+"{_BODY})?+\z'
CELLS = rf"\G({_CELL}),"
QUOTED = rf'(?s)\A"({_BODY})"(.*)\z'

POSITION = ("_file", "_block", "_order")


def _latin(raw: Column) -> Column:
    """A character for each byte, so that no byte is lost to decoding."""
    return F.decode(raw, "ISO-8859-1")


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``_file, _block, line, opens, stays``: the lines of each split in order, and their two end states."""
    text = _latin(F.col("line"))
    quoted = F.contains(F.col("line"), F.lit(b'"'))
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.col("value").cast("binary").alias("line"),
    )
    return lines.select(
        "*",
        F.when(quoted, text.rlike(OPENS)).otherwise(False).alias("opens"),
        F.when(quoted, text.rlike(STAYS)).otherwise(True).alias("stays"),
    )


def end_states(opens: np.ndarray, stays: np.ndarray, inside: bool) -> np.ndarray:
    """Whether a reader is inside a cell after each line, if it is or is not before the first.

    A line that ends alike from both states sets the state, one that ends opposite keeps or swaps it.
    """
    sets, swaps = opens == stays, np.cumsum(opens & ~stays)
    last = np.maximum.accumulate(np.where(sets, np.arange(len(sets)), -1))
    known = last >= 0
    base = np.where(known, opens[last], inside)
    return base ^ ((swaps - np.where(known, swaps[last], 0)) % 2).astype(bool)


def _bits(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


STATES = "_file string, _block long, ends_0 boolean, ends_1 boolean, records_0 long, records_1 long"
STATES_SCHEMA = pa.schema(
    [("_file", pa.string()), ("_block", pa.int64()), ("ends_0", pa.bool_()), ("ends_1", pa.bool_())]
    + [("records_0", pa.int64()), ("records_1", pa.int64())]
)


def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per split: where both starting states end, and how many records begin in it for each."""
    rows: list[dict] = []
    for part, new in runs(batches):
        if new:
            rows.append({"_file": part.column("_file")[0].as_py(), "_block": part.column("_block")[0].as_py()})
            rows[-1] |= {"ends_0": False, "ends_1": True, "records_0": 0, "records_1": 0}
        opens, stays, blank = (_bits(part, c) for c in ("opens", "stays", "blank"))
        for start in ("0", "1"):
            ends = end_states(opens, stays, rows[-1][f"ends_{start}"])
            begins = ~np.concatenate(([rows[-1][f"ends_{start}"]], ends[:-1]))
            rows[-1][f"records_{start}"] += int((begins & ~blank).sum())
            rows[-1][f"ends_{start}"] = bool(ends[-1])
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=STATES_SCHEMA)


def split_states(lines: DataFrame) -> DataFrame:
    """``_file, _block, inside, before, open``: the state in which each split starts, the records before it in
    its file, and whether it ends inside a cell. One scan that sends a row per split."""
    narrow = lines.select("_file", "_block", "opens", "stays", (F.length("line") == 0).alias("blank"))
    splits = narrow.mapInArrow(composed, STATES)
    earlier = before("_file")
    upto = earlier.rowsBetween(Window.unboundedPreceding, 0)
    sets = F.col("ends_0") == F.col("ends_1")
    swaps = (F.col("ends_0") & ~F.col("ends_1")).cast("long")
    summed = splits.withColumn("_swaps", F.sum(swaps).over(upto))
    base = F.coalesce(F.last(F.when(sets, F.col("ends_0")), ignorenulls=True).over(earlier).cast("long"), F.lit(0))
    since = F.coalesce(F.last("_swaps").over(earlier), F.lit(0)) - F.coalesce(
        F.last(F.when(sets, F.col("_swaps")), ignorenulls=True).over(earlier), F.lit(0)
    )
    placed = summed.withColumn("inside", F.pmod(base + since, F.lit(2)) == 1)
    begun = F.when(F.col("inside"), F.col("records_1")).otherwise(F.col("records_0"))
    return placed.select(
        "_file",
        "_block",
        "inside",
        F.coalesce(F.sum(begun).over(earlier), F.lit(0)).alias("before"),
        F.when(F.col("inside"), F.col("ends_1")).otherwise(F.col("ends_0")).alias("open"),
    )


CUT = "_file string, _block long, _order long, record binary, whole boolean, begins boolean, closed boolean"
CUT_SCHEMA = pa.schema(
    [("_file", pa.string()), ("_block", pa.int64()), ("_order", pa.int64()), ("record", pa.binary())]
    + [(c, pa.bool_()) for c in ("whole", "begins", "closed")]
)


class _Cutter:
    """Cuts the lines of one split, batch by batch, into records and the pieces at its edges."""

    def __init__(self, part: pa.RecordBatch):
        self.file, self.block = part.column("_file")[0], part.column("_block")[0]
        self.inside = self.head = bool(part.column("inside")[0].as_py())
        self.order, self.held = 0, []

    def rows(self, records: list[bytes], orders: np.ndarray, whole: bool, begins: bool, closed: bool) -> pa.RecordBatch:
        n = len(records)
        flags = [pa.repeat(pa.scalar(x), n) for x in (whole, begins, closed)]
        columns = [pa.repeat(self.file, n), pa.repeat(self.block, n), pa.array(orders, pa.int64()), pa.array(records, pa.binary())]
        return pa.RecordBatch.from_arrays([*columns, *flags], schema=CUT_SCHEMA)

    def cut(self, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ends = end_states(_bits(part, "opens"), _bits(part, "stays"), self.inside)
        self.inside = bool(ends[-1])
        lines = part.column("line").to_pylist()
        last = np.flatnonzero(~ends)
        if not len(last):
            self.held += lines
            return
        first = np.concatenate(([0], last[:-1] + 1))
        found = [lines[b] if a == b else b"\n".join(lines[a : b + 1]) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
        lone = first == last
        if self.held:
            found[0] = b"\n".join([*self.held, found[0]])
            lone[0] = False
        self.held = lines[last[-1] + 1 :]
        if self.head:
            yield self.rows(found[:1], np.zeros(1), False, False, True)
            found, lone, self.head = found[1:], lone[1:], False
        found = [record for record, one in zip(found, lone.tolist(), strict=True) if record or not one]
        if found:
            yield self.rows(found, np.arange(self.order, self.order + len(found)), True, True, True)
            self.order += len(found)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield self.rows([b"\n".join(self.held)], np.array([self.order]), False, not self.head, False)


def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cutter = None
    for part, new in runs(batches):
        if new:
            if cutter:
                yield from cutter.rest()
            cutter = _Cutter(part)
        yield from cutter.cut(part)
    if cutter:
        yield from cutter.rest()


def _cut(lines: DataFrame, states: DataFrame, crossed_only: bool = False) -> DataFrame:
    """Records and pieces of ``lines``, or of the splits at whose edges a record is cut."""
    starts = states.select("_file", "_block", "inside", (F.col("inside") | F.col("open")).alias("_crossed"))
    marked = with_states(lines, starts)
    chosen = marked.filter("_crossed") if crossed_only else marked
    return chosen.select("_file", "_block", "line", "opens", "stays", "inside").mapInArrow(cut_batches, CUT)


def joined_pieces(pieces: DataFrame) -> DataFrame:
    """Whole records from the pieces that splits cut them into; one that the file's end leaves open is closed."""
    ordered = Window.partitionBy("_file").orderBy("_block", "begins")
    numbered = pieces.withColumn("chain", F.sum(F.col("begins").cast("int")).over(ordered))
    piece = F.struct("_block", "begins", "_order", "closed", F.col("record").cast("string").alias("text"))
    chains = numbered.groupBy("_file", "chain").agg(F.sort_array(F.collect_list(piece)).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "\n")
    closing = F.when(F.element_at("parts", -1)["closed"], "").otherwise('"')
    first = F.element_at("parts", 1)
    return chains.select(
        "_file", first["_block"].alias("_block"), first["_order"].alias("_order"), F.concat(text, closing).cast("binary").alias("record")
    )


def first_record(spark: SparkSession, file: str) -> bytes:
    """The first record of a file, read no further than that takes."""
    lines, wanted = read_lines(spark, file).filter("_block = 0"), 1
    while True:
        rows = lines.take(wanted)
        ends = end_states(*(np.array([r[c] for r in rows], bool) for c in ("opens", "stays")), False)
        closed = np.flatnonzero(~ends)
        if len(closed) or len(rows) < wanted:
            return b"\n".join(bytes(r["line"]) for r in rows[: closed[0] + 1 if len(closed) else len(rows)])
        wanted *= 8


def records(spark: SparkSession, path: str, states: DataFrame | None) -> DataFrame:
    """``_file, _block, _order, record``: every record of every file, the header included, blank lines left out.

    ``states`` are the ``split_states`` of the same path, kept (they are read several times); None says that no
    cell of the files holds a line break.
    """
    lines = read_lines(spark, path)
    if states is None:
        free = lines.withColumns({"opens": F.lit(False), "stays": F.lit(False)}).withColumn("inside", F.lit(False))
        return free.mapInArrow(cut_batches, CUT).select(*POSITION, "record")
    whole = _cut(lines, states).filter("whole").select(*POSITION, "record")
    if states.filter("inside OR open").isEmpty():
        return whole
    pieces = _cut(lines, states, crossed_only=True).filter("NOT whole")
    return whole.unionByName(joined_pieces(pieces).select(*POSITION, "record"))


def cells(record: Column) -> Column:
    """The cells of a record as an array, a character a byte."""
    text = _latin(record)
    found = F.regexp_extract_all(F.concat(text, F.lit(",")), F.lit(CELLS), F.lit(1))

    def plain(cell: Column) -> Column:
        body = F.replace(F.regexp_extract(cell, QUOTED, 1), F.lit('""'), F.lit('"'))
        return F.when(F.startswith(cell, F.lit('"')), F.concat(body, F.regexp_extract(cell, QUOTED, 2))).otherwise(cell)

    # without a quote every comma ends a cell
    return F.when(F.contains(record, F.lit(b'"')), F.transform(found, plain)).otherwise(F.split(text, ",", -1))
