"""Benchmark decontamination with an FM-index per training shard.

Test phrases are windows of ``window`` consecutive words of a benchmark item, or the whole
item if it is shorter. A shard is a run of whole documents in one task. Its words are
numbered by the phrases' vocabulary; stretches too short to hold a phrase fall away, which
loses nothing since a phrase lies inside a stretch of known words. The rest is indexed,
all phrases are searched backwards at once through the wavelet tree, occurrences are
located by sampled suffix positions, and their words are merged to spans.

The benchmark is the query set: it is taken in blocks of about ``BLOCK_WORDS`` words, each
broadcast on its own, and a shard goes through all blocks before the next is read.

Defined cases: null and empty texts have no words and are clean; items without words match
nothing; items that repeat an id are one item; a null item id is written ``null``; repeated
documents are rows of their own; an empty benchmark leaves everything clean. Columns other
than the id and the text pass through ``scan`` untouched, whatever their names, except that
``RESULT`` columns replace columns so called.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadcast.llm.common import let_go, regrouped, spread
from roadcast.llm.fm_index import FmIndex

WINDOW = 10
BLOCK_WORDS = 500_000
SHARD_BYTES = 8 << 20
#: Bytes that are no part of a word become blanks; A-Z are lowered before.
WORD_BYTES = bytes(b if b >= 0x80 or chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" else 0x20 for b in range(256))
WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "stop")]))),
    ]
)
_ARROW_RESULT = {
    "n_words": pa.int64(), "n_hit": pa.int64(), "item_ids": pa.list_(pa.string()),
    "spans": pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])),
}


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(WORD_BYTES).split()


class Phrases:
    """The distinct windows of a block of items, by length, with the items that have each."""

    def __init__(self, vocabulary: dict[bytes, int], by_length: dict[int, tuple[np.ndarray, list[set]]]):
        self.vocabulary, self.by_length = vocabulary, by_length

    @classmethod
    def of_items(cls, items: list[tuple[str, str | None]], window: int) -> Phrases:
        vocabulary: dict[bytes, int] = {}
        owners: dict[int, dict[tuple, set]] = {}
        for item, text in items:
            ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
            length = min(window, len(ids))
            for at in range(len(ids) - length + 1 if ids else 0):
                owners.setdefault(length, {}).setdefault(tuple(ids[at : at + length]), set()).add(item)
        return cls(vocabulary, {n: (np.array(list(f), np.int64), list(f.values())) for n, f in owners.items()})

    def candidates(self, ids: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Which words lie in a stretch, inside one document, that some phrase length fits into."""
        keep = np.zeros(len(ids), bool)
        for length, (patterns, _) in self.by_length.items():
            known = np.zeros(len(self.vocabulary) + 1, bool)
            known[patterns] = True
            inside = known[ids]
            begins = inside.copy()
            begins[1:] &= ~inside[:-1] | edges[1:]
            run = np.cumsum(begins) * inside
            keep |= inside & (np.bincount(run)[run] >= length)
        return keep


def search_shard(words: np.ndarray, edges: np.ndarray, phrases: Phrases) -> Iterator[tuple[int, np.ndarray, list]]:
    """``(length, first words, item sets)`` of all occurrences. ``edges`` marks each document's first word."""
    place = np.flatnonzero(phrases.candidates(words, edges))
    if not len(place):
        return
    breaks = np.flatnonzero(np.concatenate(([False], (np.diff(place) > 1) | edges[place[1:]])))
    text = np.append(np.insert(words[place], breaks, 0), 0)
    origin = np.append(np.insert(place, breaks, -1), -1)
    index = FmIndex(text)
    for length, (patterns, owners) in phrases.by_length.items():
        low, high = index.search(patterns)
        found = high - low
        which = np.repeat(np.arange(len(found)), found)
        rows = np.repeat(low - (np.cumsum(found) - found), found) + np.arange(len(which))
        yield length, origin[index.locate(rows)], [owners[i] for i in which.tolist()]


def scan_batch(texts: list[str | None], blocks: list[Phrases]) -> dict[str, list]:
    """``RESULT`` columns of the documents of one shard."""
    lists = [words_of(t) for t in texts]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    total = int(bounds[-1])
    edges = np.zeros(total + 1, bool)
    edges[bounds[:-1]] = True
    document = np.repeat(np.arange(len(lists)), sizes)
    step = np.zeros(total + 1, np.int64)
    items: dict[int, set] = {}
    for phrases in blocks:
        ids = np.fromiter(
            (i for ws in lists for i in map(phrases.vocabulary.get, ws, repeat(0))), np.int64, total
        )
        for length, at, owners in search_shard(ids, edges[:-1], phrases):
            np.add.at(step, at, 1)
            np.add.at(step, at + length, -1)
            for d, found in zip(document[at].tolist(), owners, strict=True):
                items.setdefault(d, set()).update(found)
    hit = np.cumsum(step)[:-1] > 0
    n_hit = np.add.reduceat(np.append(hit, False).astype(np.int64), bounds[:-1]) * (sizes > 0) if len(lists) else sizes
    spans: list[list] = [[] for _ in lists]
    for d in items:
        own = np.flatnonzero(np.diff(np.concatenate(([False], hit[bounds[d] : bounds[d + 1]], [False])).astype(np.int8)))
        places = [m.span() for m in WORD.finditer(texts[d])]
        spans[d] = [{"start": places[a][0], "stop": places[b - 1][1]} for a, b in zip(own[::2], own[1::2], strict=True)]
    return {
        "n_words": sizes.tolist(),
        "n_hit": n_hit.tolist(),
        "item_ids": [sorted(items.get(d, ())) for d in range(len(lists))],
        "spans": spans,
    }


def phrase_blocks(benchmark: DataFrame, id_column: str, text_column: str, window: int) -> Iterator[Phrases]:
    """The benchmark in blocks of about ``BLOCK_WORDS`` words, one on the driver at a time."""
    items = benchmark.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("null")).alias("item"), F.col(text_column).alias("text")
    )
    # a word takes two bytes at least, with what parts it from the next
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = 1 + size // (2 * BLOCK_WORDS)
    block = F.pmod(F.xxhash64("item"), F.lit(count))
    for number in range(count):
        rows = items.filter(block == number).select("item", "text").collect()
        yield Phrases.of_items([tuple(r) for r in rows], window)


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text_column: str = "text",
    key_column: str = "doc_id",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """The columns of ``docs`` and ``n_words``, ``n_hit``, ``item_ids`` (sorted texts), ``spans``.

    ``spans`` are maximal stretches of hit words as code point offsets into the text.
    """
    sc = docs.sparkSession.sparkContext
    blocks = [sc.broadcast((p.vocabulary, p.by_length)) for p in phrase_blocks(benchmark, item_column, item_text_column, window)]
    kept = [c for c in docs.columns if c not in RESULT.names]
    rows = spread(docs.select(*kept), key_column)
    schema = T.StructType([*rows.schema.fields, *RESULT.fields])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in regrouped(batches, text_column, SHARD_BYTES):
            found = scan_batch(batch.column(text_column).to_pylist(), [Phrases(*b.value) for b in blocks])
            columns = [pa.array(found[n], kind) for n, kind in _ARROW_RESULT.items()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.names)

    return rows.mapInArrow(of, schema)


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` without the spans; what stood on both sides of one is parted by a blank."""
    begins = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text).cast("long")))
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["stop"]))
    parts = F.zip_with(ends, begins, lambda a, b: F.substring(text, a.cast("int") + 1, (b - a).cast("int")))
    return F.when(F.size(spans) > 0, F.array_join(parts, " ")).otherwise(text)
