"""Document fingerprints by locally consistent parsing.

A text's bytes are parsed into phrases, the phrases into phrases of phrases, and so on to a
root. Where a phrase begins is decided by deterministic coin tossing: each symbol is
labelled by the lowest bit in which it differs from its left neighbour and that bit's
value, again and again until six labels are left, and a phrase begins at every label
greater than both neighbours'. That depends on a few symbols around, not on the offset,
so equal substrings are parsed alike except near their ends. A phrase's name is a hash
of the names in it, the same in every document.

A fingerprint sketches the set of a text's phrase names from level ``FIRST_LEVEL`` up (for
texts with few of them, of all levels) in ``SLOTS`` slots: a name falls into the slot of
its hash and the least one stays. The likeness of two fingerprints is the share of slots
in which they agree among those that either fills, an estimate of the sets' Jaccard
similarity; equal texts have equal fingerprints.

Defined cases: null is an empty text; an empty text's fingerprint has no slot filled, is
like itself (1) and unlike every other (0); rows that repeat an id follow each other in the
order of their texts, null ids come first; the only document of a table is its own next
one; an empty table gives an empty result. Columns other than the id and the text are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 64
FIRST_LEVEL = 3
FEW_NAMES = 8
CHUNK_CHARS = 1 << 20
BLOCK_ROWS, MOST_BLOCKS = 500, 10_000
LOWEST = -(2**63)
_POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def coin_labels(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels 0 to 5 of symbols that differ from their left neighbours; neighbours' labels differ.

    ``first`` marks the first symbol of each text, which has no left neighbour.
    """
    labels = symbols
    most = 8 * symbols.dtype.itemsize - 1  # the highest bit that may differ
    while True:
        before = np.empty_like(labels)
        before[1:] = labels[:-1]
        before[first] = labels[first] ^ labels.dtype.type(1)
        differing = labels ^ before
        lowest = np.bitwise_count((differing & -differing) - labels.dtype.type(1))
        labels = 2 * lowest + (labels >> lowest.astype(labels.dtype) & labels.dtype.type(1)).astype(np.uint8)
        if most <= 2:
            return labels
        most = int(2 * most + 1).bit_length() - 1


def parse_level(names: np.ndarray, text: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The names one level up and the text each belongs to. ``text`` numbers the texts, ascending."""
    head = np.ones(len(names), bool)
    head[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(head)
    run = np.diff(np.append(at, len(names)))
    symbols, owner = names[at], text[at]
    first = np.ones(len(at), bool)
    first[1:] = owner[1:] != owner[:-1]
    labels = coin_labels(symbols, first).astype(np.int8)
    left, right = np.full(len(at), -1, np.int8), np.full(len(at), -1, np.int8)
    left[1:] = labels[:-1]
    right[:-1] = labels[1:]
    left[first] = -1
    right[:-1][first[1:]] = -1
    starts = np.flatnonzero(first | ((labels > left) & (labels > right)))
    sizes = np.diff(np.append(starts, len(at)))
    place = np.arange(len(at)) - np.repeat(starts, sizes)
    value = symbols.astype(np.uint64) + np.uint64(1)
    long = run > 1
    value[long] = _mix(value[long] ^ (run[long].astype(np.uint64) << np.uint64(40)))
    value *= _POWERS[place]
    total = np.add.reduceat(value, starts) + sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return _mix(total + np.uint64(level)), owner[starts]


def phrase_names(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(names, texts)``: the distinct phrase names that a fingerprint sketches, by text."""
    sizes = np.fromiter(map(len, raws), np.int64, len(raws))
    names: np.ndarray = np.frombuffer(b"".join(raws), np.uint8)
    text = np.repeat(np.arange(len(raws), dtype=np.int32), sizes)
    kept, low = [], []
    level = 0
    while len(names):
        level += 1
        names, text = parse_level(names, text, level)
        (low if level < FIRST_LEVEL else kept).append((names, text))
        if level == FIRST_LEVEL:
            few = np.bincount(text, minlength=len(raws)) < FEW_NAMES
            kept += [(n[few[t]], t[few[t]]) for n, t in low]
        more = np.bincount(text, minlength=len(raws)) > 1
        if level >= FIRST_LEVEL:  # a root is not parsed again
            names, text = names[more[text]], text[more[text]]
    if not kept:
        return np.empty(0, np.uint64), np.empty(0, np.int32)
    return np.concatenate([n for n, _ in kept]), np.concatenate([t for _, t in kept])


def fingerprints(raws: list[bytes]) -> np.ndarray:
    """``(texts, SLOTS)`` of 16-bit values; 0 is an empty slot."""
    names, text = phrase_names(raws)
    hashed = _mix(names * np.uint64(0x9E3779B97F4A7C15))
    slot = text.astype(np.int64) * SLOTS + (hashed % np.uint64(SLOTS)).astype(np.int64)
    least = np.full(len(raws) * SLOTS, np.iinfo(np.uint64).max, np.uint64)
    order = np.lexsort((hashed, slot))
    slot, hashed = slot[order], hashed[order]
    lead = np.flatnonzero(np.concatenate((np.ones(min(1, len(slot)), bool), slot[1:] != slot[:-1])))
    least[slot[lead]] = hashed[lead]
    filled = np.zeros(len(least), bool)
    filled[slot[lead]] = True
    value = (least >> np.uint64(6)).astype(np.uint64) % np.uint64(65_535) + np.uint64(1)
    return np.where(filled, value, 0).astype(np.uint16).reshape(len(raws), SLOTS)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, the share of agreeing slots among those that either fills; 1 if neither fills any."""
    used = ((a > 0) | (b > 0)).sum(axis=1)
    same = ((a > 0) & (a == b)).sum(axis=1)
    return np.where(used > 0, same / np.maximum(used, 1), 1.0)


def as_hex(prints: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in prints.astype(">u2")]


# --- documents beside the next one -----------------------------------------------------


def _below(bounds: list[int], key: Column) -> Column:
    """How many of the ascending ``bounds`` are below ``key``, by a coarse and a fine look."""
    width = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    if not groups:
        return F.lit(0)
    lasts = F.array(*[F.lit(g[-1]) for g in groups])
    coarse = F.size(F.filter(lasts, lambda b: b < key))
    fine = F.array(*[F.array(*map(F.lit, g)) for g in [*groups, [2**63 - 1]]])
    inside = F.size(F.filter(F.get(fine, coarse), lambda b: b < key))
    return coarse * width + inside


def in_blocks(docs: DataFrame) -> DataFrame:
    """``doc_id, text, block, trailing``: ranges of ids, each with the document that follows it as ``trailing``.

    What the driver sees is one bound and one least id a block.
    """
    key = F.coalesce("doc_id", F.lit(LOWEST))
    keyed = docs.withColumn("key", key)
    blocks = min(MOST_BLOCKS, 1 + docs.count() // BLOCK_ROWS)
    cuts = [i / blocks for i in range(1, blocks)]
    found = keyed.select(F.percentile_approx("key", cuts, 100 * blocks)).first()[0] if cuts else None
    bounds = sorted(set(found or ()))
    keyed = keyed.withColumn("block", _below(bounds, F.col("key")))
    least = dict(keyed.groupBy("block").agg(F.min("key")).collect())
    order = sorted(least)
    # the block before, in a ring, gets a copy of the first document
    before = {b: order[i - 1] for i, b in enumerate(order)}
    size = (order[-1] if order else 0) + 1
    first = F.array(*[F.lit(least.get(b, LOWEST)).cast("long") for b in range(size)])
    target = F.array(*[F.lit(before.get(b, 0)) for b in range(size)])
    own = F.struct(F.col("block").alias("block"), F.lit(0).alias("trailing"))
    copy = F.struct(F.get(target, F.col("block")).alias("block"), F.lit(1).alias("trailing"))
    places = F.when(F.col("key") == F.get(first, F.col("block")), F.array(own, copy)).otherwise(F.array(own))
    return keyed.select("doc_id", "text", "key", F.explode(places).alias("to")).select("doc_id", "text", "key", "to.*")


def edited(text: str, following: str) -> str:
    """The last half of the code points (rounded down) replaced by as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprint_chunk(ids: list, texts: list[str]) -> pa.RecordBatch:
    """Rows of all documents but the last of ``texts``, which only follows the one before."""
    count = len(ids)
    changed = [edited(a, b).encode() for a, b in zip(texts[:-1], texts[1:], strict=True)]
    prints = fingerprints([*(t.encode() for t in texts), *changed])
    own, after, edit = prints[:count], prints[1 : count + 1], prints[count + 1 :]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array(map(len, texts[:-1]), pa.int64()),
            pa.array([hashlib.sha256(c).hexdigest() for c in changed]),
            pa.array(as_hex(own)),
            pa.array(as_hex(edit)),
            pa.array(likeness(own, edit)),
            pa.array(likeness(own, after)),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def neighbour_fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``SCHEMA``: every document's fingerprint, its edited text's, and their likeness and the next document's."""
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    placed = in_blocks(rows).repartition("block").sortWithinPartitions("block", "trailing", "key", "text")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        held, block, ended = 0, None, False
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "block", "trailing"))
            for doc_id, text, of_block, trailing in zip(*columns, strict=True):
                if of_block != block:
                    block, ended = of_block, False
                elif ended:
                    continue  # another copy of a repeated first id
                if texts and (trailing or held > CHUNK_CHARS):
                    yield fingerprint_chunk(ids, [*texts, text])
                    ids, texts, held = [], [], 0
                if trailing:
                    ended = True
                else:
                    ids.append(doc_id)
                    texts.append(text)
                    held += 2 * len(text)

    return placed.mapInArrow(of, SCHEMA)
