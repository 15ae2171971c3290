"""Features of JSON documents of any size, read by many tasks.

A document is read as stretches that end with a closing brace, each split by its own task.
What a byte means depends on what lies before it through two things: whether a string is
open, and how many brackets are. A split changes the first by the parity of its quotes and the second
by one of two sums, so a first scan sends a row per split and windows over these rows give
each split its start. A second scan cuts out what lies outside all containers of the top
level (the skeleton, a small document of its own that tells what the features are), and counts
containers and commas. A third scan cuts the elements of the features list at its commas;
elements that cross a split's edge are put together by their index, which is their position
in the list.

Only the skeleton of a document and one element at a time are ever in one place.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadcast.session import checkpointed
from roadcast.sources.splits import before, runs, with_states

END = b"}"
QUOTE, BACKSLASH, COMMA = b'"\\,'
SPACES = b" \t\r\n"
ELEMENT_DEPTH = 2  # of what lies between the elements of a list at the top level


def read_stretches(spark: SparkSession, path: str) -> DataFrame:
    """``_file, _block, _size, stretch``: the file cut after every closing brace, in order within each split."""
    return spark.read.option("lineSep", END.decode()).text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.col("_metadata.file_size").alias("_size"),
        F.col("value").cast("binary").alias("stretch"),
    )


def raw_of(part: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(END.join([*part.column("stretch").to_pylist(), b""]), np.uint8)


_STEP = np.zeros(256, np.int64)
_STEP[list(b"{[")], _STEP[list(b"}]")] = 1, -1


def open_strings(raw: np.ndarray, inside: bool) -> np.ndarray:
    """Whether a string is open before each byte, and at the end. ``raw`` does not begin behind a backslash."""
    quotes = raw == QUOTE
    slashes = np.flatnonzero(raw == BACKSLASH)
    if len(slashes):
        # of a row of backslashes every second is itself escaped; the byte behind an unescaped one is
        first = np.append(True, np.diff(slashes) != 1)
        nth = np.arange(len(slashes)) - np.maximum.accumulate(np.where(first, np.arange(len(slashes)), 0))
        behind = slashes[nth % 2 == 0] + 1
        quotes[behind[behind < len(raw)]] = False
    return np.concatenate(([inside], inside ^ (np.cumsum(quotes) % 2).astype(bool)))


def steps(raw: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """How each byte changes the number of open brackets."""
    return np.where(strings[:-1], 0, _STEP[raw])


SUMS = "_file string, _block long, bytes long, size long, swaps boolean, sum_0 long, sum_1 long"
SUMS_SCHEMA = pa.schema(
    [("_file", pa.string()), ("_block", pa.int64()), ("bytes", pa.int64()), ("size", pa.int64()), ("swaps", pa.bool_())]
    + [("sum_0", pa.int64()), ("sum_1", pa.int64())]
)


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[dict] = []
    for part, new in runs(batches):
        if new:
            rows.append({"_file": part.column("_file")[0].as_py(), "_block": part.column("_block")[0].as_py()})
            rows[-1] |= {"bytes": 0, "size": part.column("_size")[0].as_py(), "swaps": False, "sum_0": 0, "sum_1": 0}
        row, raw = rows[-1], raw_of(part)
        strings = open_strings(raw, False)
        sums = [int(steps(raw, s).sum()) for s in (strings, ~strings)]
        flipped = row["swaps"]
        row["sum_0"] += sums[flipped]
        row["sum_1"] += sums[not flipped]
        row["swaps"] ^= bool(strings[-1])
        row["bytes"] += len(raw)
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=SUMS_SCHEMA)


def split_starts(stretches: DataFrame) -> DataFrame:
    """``_file, _block, inside, depth`` and ``spare``: whether the file's last brace is the reader's, not its own."""
    sums = stretches.mapInArrow(summed, SUMS)
    earlier = before("_file")
    open_before = F.coalesce(F.sum(F.col("swaps").cast("long")).over(earlier), F.lit(0)) % 2 == 1
    placed = sums.withColumn("inside", open_before)
    own = F.when(F.col("inside"), F.col("sum_1")).otherwise(F.col("sum_0"))
    return placed.select(
        "_file",
        "_block",
        "inside",
        F.coalesce(F.sum(own).over(earlier), F.lit(0)).alias("depth"),
        (F.sum("bytes").over(Window.partitionBy("_file")) > F.col("size")).alias("spare"),
    )


OUTLINE = "_file string, _block long, skeleton binary, opened long, commas long"
OUTLINE_SCHEMA = pa.schema(
    [("_file", pa.string()), ("_block", pa.int64()), ("skeleton", pa.binary()), ("opened", pa.int64()), ("commas", pa.int64())]
)


def structure(raw: np.ndarray, inside: bool, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Open strings, depth behind each byte, and its change."""
    strings = open_strings(raw, inside)
    step = steps(raw, strings)
    return strings, depth + np.cumsum(step), step


def outlined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split: its bytes outside the containers of the top level, and how many of these it opens.

    ``commas`` counts separators at element depth since the last opening, or in the whole split if it opens none.
    """
    row: dict = {}
    for part, new in runs(batches):
        if new:
            if row:
                yield pa.RecordBatch.from_pylist([row], schema=OUTLINE_SCHEMA)
            row = {"_file": part.column("_file")[0].as_py(), "_block": part.column("_block")[0].as_py()}
            row |= {"skeleton": b"", "opened": 0, "commas": 0}
            inside, depth = part.column("inside")[0].as_py(), part.column("depth")[0].as_py()
        raw = raw_of(part)
        strings, after, step = structure(raw, inside, depth)
        outer = np.minimum(after, after - step) < ELEMENT_DEPTH
        row["skeleton"] += raw[outer].tobytes()
        opens = np.flatnonzero((step == 1) & (after == ELEMENT_DEPTH))
        commas = np.flatnonzero((raw == COMMA) & ~strings[:-1] & (after == ELEMENT_DEPTH))
        row["commas"] = len(commas) + row["commas"] if not len(opens) else int((commas > opens[-1]).sum())
        row["opened"] += len(opens)
        inside, depth = bool(strings[-1]), int(after[-1])
    if row:
        yield pa.RecordBatch.from_pylist([row], schema=OUTLINE_SCHEMA)


def split_outlines(stretches: DataFrame, starts: DataFrame) -> DataFrame:
    """``_file, _block, skeleton, inside, depth, spare``, and before the split ``opened`` containers and ``commas`` in the last."""
    marked = with_states(stretches.drop("_size"), starts.drop("spare"))
    outlines = marked.mapInArrow(outlined, OUTLINE).join(starts, ["_file", "_block"])
    earlier = before("_file")
    upto = earlier.rowsBetween(Window.unboundedPreceding, 0)
    grouped = outlines.withColumn("_group", F.sum((F.col("opened") > 0).cast("long")).over(upto))
    same = Window.partitionBy("_file", "_group").orderBy("_block")
    running = grouped.withColumn("_commas", F.sum("commas").over(same.rowsBetween(Window.unboundedPreceding, 0)))
    return running.select(
        "_file",
        "_block",
        "skeleton",
        "inside",
        "depth",
        "spare",
        F.coalesce(F.sum("opened").over(earlier), F.lit(0)).alias("opened"),
        F.coalesce(F.lag("_commas").over(Window.partitionBy("_file").orderBy("_block")), F.lit(0)).alias("commas"),
    )


CONTAINER = "source string, type string, kind string, ordinal long"
CONTAINER_SCHEMA = pa.schema([("source", pa.string()), ("type", pa.string()), ("kind", pa.string()), ("ordinal", pa.int64())])


def described(skeleton: bytes) -> dict:
    """``type``, the ``kind`` of ``features`` (list, object, other or null) and its number among the containers.

    A repeated key counts with its last value; a skeleton that is no JSON object has neither.
    """
    nested = {"type": None, "kind": None, "ordinal": None}
    try:
        pairs = json.loads(skeleton, object_pairs_hook=lambda found: tuple(found))
    except ValueError:
        return nested
    if not isinstance(pairs, tuple):
        return nested
    containers = 0
    for key, value in pairs:
        kind = "list" if isinstance(value, list) else "object" if isinstance(value, tuple) else "other"
        if key == "type":
            nested["type"] = value if isinstance(value, str) else None
        if key == "features":
            nested |= {"kind": kind, "ordinal": containers if kind == "list" else None}
        containers += kind != "other"
    return nested


def containers(outlines: DataFrame) -> DataFrame:
    """A row per file: ``source, type, kind, ordinal``."""
    parts = F.sort_array(F.collect_list(F.struct("_block", "skeleton", "spare")))
    whole = outlines.groupBy("_file").agg(parts.alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["skeleton"].cast("string")), "")
    spare = F.element_at("parts", 1)["spare"]
    skeleton = F.when(spare, F.regexp_replace(text, r"\}\z", "")).otherwise(text).cast("binary")
    joined = whole.select("_file", skeleton.alias("skeleton"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("_file").to_pylist(), batch.column("skeleton").to_pylist(), strict=True)
            yield pa.RecordBatch.from_pylist([{"source": f, **described(s)} for f, s in rows], schema=CONTAINER_SCHEMA)

    return joined.mapInArrow(of, CONTAINER)


ELEMENTS = "_file string, _block long, feature_index long, element binary, whole boolean"
ELEMENTS_SCHEMA = pa.schema(
    [("_file", pa.string()), ("_block", pa.int64()), ("feature_index", pa.int64()), ("element", pa.binary()), ("whole", pa.bool_())]
)


class _Cutter:
    """Cuts the elements of the wanted container out of one split, batch by batch."""

    def __init__(self, part: pa.RecordBatch):
        first = {c: part.column(c)[0].as_py() for c in ("_file", "_block", "inside", "depth", "opened", "commas", "wanted")}
        self.file, self.block, self.wanted = first["_file"], first["_block"], first["wanted"]
        self.inside, self.depth = first["inside"], first["depth"]
        self.container = first["opened"] - 1  # number of the container at hand
        self.index = first["commas"]
        self.held: list[bytes] = []
        self.cutting = self.depth >= ELEMENT_DEPTH and self.container == self.wanted
        self.head, self.opened_here = self.cutting, False

    def cut(self, part: pa.RecordBatch) -> tuple[list[int], list[bytes], list[bool]]:
        raw = raw_of(part)
        strings, after, step = structure(raw, self.inside, self.depth)
        self.inside, self.depth = bool(strings[-1]), int(after[-1])
        outside = ~strings[:-1]
        opens = (step == 1) & (after == ELEMENT_DEPTH)
        closes = (step == -1) & (after == ELEMENT_DEPTH - 1)
        commas = (raw == COMMA) & outside & (after == ELEMENT_DEPTH)
        text, start = raw.tobytes(), 0
        indices: list[int] = []
        elements: list[bytes] = []
        wholes: list[bool] = []
        for at in np.flatnonzero(opens | closes | commas).tolist():
            if opens[at]:
                self.container += 1
                self.index, self.held = 0, []
                self.cutting, self.head, self.opened_here = self.container == self.wanted, False, True
            elif self.cutting:
                element = b"".join([*self.held, text[start:at]])
                empty = self.opened_here and closes[at] and self.index == 0 and not element.strip(SPACES)
                if not empty:
                    indices.append(self.index)
                    elements.append(element)
                    wholes.append(not self.head)
                self.index, self.held, self.head = self.index + 1, [], False
                self.cutting = not closes[at]
            start = at + 1
        if self.cutting:
            self.held.append(text[start:])
        return indices, elements, wholes

    def batch(self, indices: list[int], elements: list[bytes], wholes: list[bool]) -> pa.RecordBatch:
        n = len(indices)
        columns = [pa.repeat(pa.scalar(x, t), n) for x, t in ((self.file, pa.string()), (self.block, pa.int64()))]
        columns += [pa.array(indices, pa.int64()), pa.array(elements, pa.binary()), pa.array(wholes, pa.bool_())]
        return pa.RecordBatch.from_arrays(columns, schema=ELEMENTS_SCHEMA)

    def rest(self) -> pa.RecordBatch:
        return self.batch([self.index], [b"".join(self.held)], [False]) if self.held else self.batch([], [], [])


def cut_elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cutter = None
    for part, new in runs(batches):
        if new:
            if cutter:
                yield cutter.rest()
            cutter = _Cutter(part)
        yield cutter.batch(*cutter.cut(part))
    if cutter:
        yield cutter.rest()


def read_documents(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The containers (``source, type, features``) and their features (``source, feature_index, properties, geometry``).

    The containers' ``features`` is an empty variant of the kind found. Features are in no order; those of a
    container that is no list are none. An element that is no JSON has neither properties nor geometry.
    """
    stretches = read_stretches(spark, path)
    starts = checkpointed(split_starts(stretches))
    outlines = checkpointed(split_outlines(stretches, starts))
    found = checkpointed(containers(outlines))
    kinds = F.when(F.col("kind") == "list", "[]").when(F.col("kind") == "object", "{}").when(F.col("kind") == "other", "0")
    described_ = found.select("source", "type", F.parse_json(kinds).alias("features"))
    wanted = found.filter("ordinal IS NOT NULL").select(F.col("source").alias("_file"), F.col("ordinal").alias("wanted"))
    states = checkpointed(outlines.drop("skeleton", "spare").join(wanted, "_file", "left").fillna(-1, ["wanted"]))
    cut = with_states(stretches.drop("_size"), states).filter("wanted >= 0").mapInArrow(cut_elements, ELEMENTS)
    whole = cut.filter("whole").select("_file", "feature_index", "element")
    edges = cut.filter("NOT whole").groupBy("_file", "feature_index").agg(
        F.sort_array(F.collect_list(F.struct("_block", F.col("element").cast("string").alias("text")))).alias("parts")
    )
    joined = edges.select(
        "_file", "feature_index", F.array_join(F.transform("parts", lambda p: p["text"]), "").cast("binary").alias("element")
    )
    blank = (F.col("feature_index") == 0) & F.col("element").cast("string").rlike(r"\A[ \t\r\n]*\z")
    elements = whole.unionByName(joined.filter(~blank))
    feature = F.try_parse_json(F.col("element").cast("string"))
    features = elements.select(F.col("_file").alias("source"), "feature_index", feature.alias("feature"))
    return described_, features.select(
        "source",
        "feature_index",
        F.try_variant_get("feature", "$.properties", "variant").alias("properties"),
        F.try_variant_get("feature", "$.geometry", "variant").alias("geometry"),
    )
