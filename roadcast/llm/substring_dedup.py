"""Removal of repeated byte strings with suffix arrays over shards.

A byte is removed if a string of ``length`` bytes that covers it also starts in a document
with a smaller id. Equal strings must meet in one shard, so every window of ``length``
bytes goes by the least hash among the short grams inside it: equal windows have equal
keys wherever they stand, and neighbouring windows mostly share one, so that they travel
together as one stretch of text.

1. Documents are put into packs of a few megabytes, written once.
2. Every pack sends the distinct keys of its stretches; shards answer which of them occur
   in more than one document. The text of all other stretches never leaves its pack.
3. Packs send each distinct text of the remaining stretches once, with the least id that
   has it. A shard joins its distinct texts, sorts all suffixes by induced sorting,
   takes windows together whose common prefix reaches ``length`` (permuted common
   prefixes), and gives each the least id of its group. It answers with a bit a window.
4. Packs mark windows, merge them to spans and cut their documents.

Common strings cost a pack one entry however often it holds them, and a shard one entry a
pack, so no task sees all copies of a document. Keys only bring candidates together; what
is removed is decided by comparing text.

Defined cases: a null text is empty; texts shorter than ``length`` are kept; documents that
share an id are not smaller than each other, so their common text stays; a document with
a null id is kept whole and removes nothing elsewhere; an empty table gives an empty
result. Other columns pass through, except that ``RESULT`` columns replace columns so called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadcast.llm.common import let_go, regrouped, spread, stored
from roadcast.llm.suffix_array import permuted_common_prefixes, suffix_array

LENGTH = 50
GRAM = 20
PACK_BYTES = 6 << 20
SHARD_BYTES = 3 << 20
SLICE = 1 << 19
MOST_WINDOWS = 256
RESULT = T.StructType(
    [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "stop")]))),
        T.StructField("kept", T.BinaryType()),
    ]
)
_ARROW_RESULT = {
    "n_bytes": pa.int64(), "n_removed": pa.int64(),
    "spans": pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), "kept": pa.binary(),
}


# --- packs -----------------------------------------------------------------------------


def packs(docs: DataFrame) -> DataFrame:
    """``pack, n_bytes, rows``: whole documents with all columns, as compressed Arrow streams sorted by id."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for number, batch in enumerate(regrouped(batches, "text", PACK_BYTES)):
            batch = batch.take(pc.sort_indices(batch.column("doc_id"), null_placement="at_end"))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
                writer.write_batch(batch)
            size = pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([(TaskContext.get().partitionId() << 32) + number]),
                    pa.array([size], pa.int64()),
                    pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                ],
                names=["pack", "n_bytes", "rows"],
            )

    return stored(spread(docs, "doc_id").mapInArrow(of, "pack long, n_bytes long, rows binary"), "substring-packs")


def unpacked(rows: bytes) -> pa.Table:
    return pa.ipc.open_stream(rows).read_all().combine_chunks()


# --- stretches -------------------------------------------------------------------------


def window_keys(raw: np.ndarray, length: int, gram: int) -> np.ndarray:
    """For every window of ``length`` bytes, the least hash of the grams inside it; the last bit is free."""
    words = np.ndarray((len(raw) - 7,), "<u8", np.ascontiguousarray(raw).data, strides=(1,)).astype(np.uint64)
    n = len(raw) - gram + 1
    hashes = words[:n] * np.uint64(0x9E3779B97F4A7C15)
    for at, factor in zip((*range(8, gram - 7, 8), gram - 8), (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9), strict=True):
        hashes ^= hashes >> np.uint64(29)
        hashes += words[at : at + n]
        hashes *= np.uint64(factor)
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    least, width, span = hashes, 1, length - gram + 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    return least & ~np.uint64(1)


def stretches(raw: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(key, first window, windows)`` of runs of windows with one key; none crosses a document or ``MOST_WINDOWS``."""
    found: list[tuple] = []
    last = len(raw) - length  # the last window's start
    inside = np.ones(max(0, last + 1), bool)
    for edge in bounds[1:-1].tolist():
        inside[max(0, edge - length + 1) : edge] = False
    for low in range(0, last + 1, SLICE):
        high = min(low + SLICE, last + 1)
        valid = inside[low:high]
        if not valid.any():
            continue
        keys = window_keys(raw[low : high + length - 1], length, GRAM)
        begins = valid.copy()
        begins[1:] &= ~valid[:-1] | (keys[1:] != keys[:-1])
        ends = np.append(valid[:-1] & (~valid[1:] | begins[1:]), valid[-1])
        start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        parts = (stop - start + MOST_WINDOWS - 1) // MOST_WINDOWS
        if (parts > 1).any():
            run = np.repeat(np.arange(len(start)), parts)
            nth = np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts)
            stop = np.minimum(stop[run], start[run] + (nth + 1) * MOST_WINDOWS)
            start = start[run] + nth * MOST_WINDOWS
        found.append((keys[start], start + low, stop - start))
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


class Pack:
    """A pack's documents and their stretches, the same whenever it is opened."""

    def __init__(self, rows: bytes, length: int):
        self.table = unpacked(rows)
        text = self.table["text"]
        sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy()
        self.bounds = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        self.raw = np.frombuffer(b"".join(t.as_buffer() for chunk in text.chunks for t in chunk if t.is_valid), np.uint8)
        ids = self.table["doc_id"]
        self.named = len(ids) - ids.null_count  # documents without an id come last
        self.doc_ids = ids.slice(0, self.named).to_numpy().astype(np.int64)
        self.key, self.start, self.windows = stretches(self.raw[: self.bounds[self.named]], self.bounds[: self.named + 1], length)
        self.document = np.searchsorted(self.bounds[: self.named + 1], self.start, side="right") - 1

    def distinct_keys(self, shards: int) -> list[tuple[int, np.ndarray]]:
        """Per shard the distinct keys, ascending; the last bit says that several documents have it."""
        if not len(self.key):
            return []
        order = np.argsort(self.key, kind="stable")
        key, document = self.key[order], self.document[order]
        fresh = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        several = np.append(fresh[1:], len(key)) - 1
        several = document[several] != document[fresh]
        values = key[fresh] | several.astype(np.uint64)
        return _dealt(values, shards)

    def repeated(self, answers: dict[int, bytes], shards: int) -> np.ndarray:
        """Which stretches have a key that occurs in several documents."""
        hits = []
        for shard, values in self.distinct_keys(shards):
            bits = np.unpackbits(np.frombuffer(answers[shard], np.uint8), count=len(values)).astype(bool)
            hits.append(values[bits] & ~np.uint64(1))
        return np.isin(self.key, np.concatenate([np.empty(0, np.uint64), *hits]))

    def texts(self, chosen: np.ndarray, length: int) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """Number of each chosen stretch's text, the distinct texts, and the first stretch with each."""
        raw = self.raw.tobytes()
        numbers: dict[bytes, int] = {}
        start = self.start[chosen]
        stop = start + self.windows[chosen] + length - 1
        number = np.fromiter(
            (numbers.setdefault(raw[a:b], len(numbers)) for a, b in zip(start.tolist(), stop.tolist(), strict=True)),
            np.int64, len(start),
        )
        first = np.unique(number, return_index=True)[1]
        return number, list(numbers), chosen[first]


def _dealt(values: np.ndarray, shards: int) -> list[tuple[int, np.ndarray]]:
    shard = ((values >> np.uint64(1)) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    return [(int(shard[part[0]]), values[part]) for part in np.split(order, cuts) if len(part)]


def _numbered(values: list[int]) -> bytes:
    return np.array(values, "<i8").tobytes()


# --- what packs send and shards answer -------------------------------------------------

SENT = "shard int, pack long, sent binary"


def sent_keys(table: DataFrame, shards: int, length: int) -> DataFrame:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for row in batch.to_pylist():
                found = Pack(row["rows"], length).distinct_keys(shards)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([s for s, _ in found], pa.int32()),
                        pa.array([row["pack"]] * len(found), pa.int64()),
                        pa.array([v.astype("<u8").tobytes() for _, v in found], pa.binary()),
                    ],
                    names=["shard", "pack", "sent"],
                )

    return table.mapInArrow(of, SENT)


def answer_keys(table: pa.Table) -> pa.Table:
    """A bit for every key sent: whether several packs, or several documents of a pack, have it."""
    lists = [np.frombuffer(sent, "<u8") for sent in table["sent"].to_pylist()]
    values, inverse, counts = np.unique(np.concatenate(lists) >> np.uint64(1), return_inverse=True, return_counts=True)
    flagged = np.zeros(len(values), bool)
    flagged[inverse[np.concatenate(lists) & np.uint64(1) == 1]] = True
    bits = ((counts > 1) | flagged)[inverse]
    ends = np.cumsum([len(x) for x in lists])
    answers = [np.packbits(part).tobytes() for part in np.split(bits, ends[:-1])]
    return table.drop_columns(["sent"]).append_column("sent", pa.array(answers, pa.binary()))


def _chosen(pack: Pack, row: dict, shards: int, length: int) -> tuple:
    """The pack's repeated stretches, their texts, and the texts of each shard in the order sent."""
    answers = {a["shard"]: a["sent"] for a in row["keys"] or ()}
    chosen = np.flatnonzero(pack.repeated(answers, shards))
    number, texts, first = pack.texts(chosen, length)
    shard = ((pack.key[first] >> np.uint64(1)) % np.uint64(shards)).astype(np.int64)
    return chosen, number, texts, first, shard


def sent_texts(joined: DataFrame, shards: int, length: int) -> DataFrame:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for row in batch.to_pylist():
                pack = Pack(row["rows"], length)
                _, _, texts, first, shard = _chosen(pack, row, shards, length)
                owner = pack.doc_ids[pack.document[first]]
                names, blobs = [], []
                order = np.argsort(shard, kind="stable")
                for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                    if len(part):
                        own = [texts[i] for i in part.tolist()]
                        names.append(int(shard[part[0]]))
                        head = np.array([len(own), *map(len, own), *owner[part].tolist()], "<i8").tobytes()
                        blobs.append(squeeze(head + b"".join(own)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.int32()),
                        pa.array([row["pack"]] * len(names), pa.int64()),
                        pa.array(blobs, pa.binary()),
                    ],
                    names=["shard", "pack", "sent"],
                )

    return joined.mapInArrow(of, SENT)


def least_owners(texts: list[bytes], owners: list[int], length: int) -> np.ndarray:
    """For every place of the texts joined by one byte, the least owner of a text with the window there."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 1)
    raw = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    symbols = raw.astype(np.int32) + 2
    symbols[ends - 1] = 1
    sa = suffix_array(np.append(symbols, 0))[1:].astype(np.int64)
    room = np.repeat(ends - 1, sizes + 1) - np.arange(len(raw))  # bytes left in the text
    common = permuted_common_prefixes(raw, sa)[sa]
    common = np.minimum(common, np.minimum(room[sa], np.append(0, room[sa[:-1]])))
    groups = np.flatnonzero(common < length)
    owner = np.repeat(np.array(owners, np.int64), sizes + 1)[sa]
    least = np.empty(len(raw), np.int64)
    least[sa] = np.repeat(np.minimum.reduceat(owner, groups), np.diff(np.append(groups, len(sa))))
    return least


def answer_texts(table: pa.Table, length: int) -> pa.Table:
    """A bit for every window of every text sent: whether a smaller id has it."""
    numbers: dict[bytes, int] = {}
    owners: list[int] = []
    sent = []
    for blob in table["sent"].to_pylist():
        raw = zstandard.decompress(blob)
        count = int.from_bytes(raw[:8], "little")
        head = np.frombuffer(raw, "<i8", 2 * count, 8)
        at, own = 8 * (2 * count + 1), []
        for size, owner in zip(head[:count].tolist(), head[count:].tolist(), strict=True):
            text = raw[at : at + size]
            at += size
            number = numbers.setdefault(text, len(numbers))
            if number == len(owners):
                owners.append(owner)
            elif owner < owners[number]:
                owners[number] = owner
            own.append(number)
        sent.append((np.array(own, np.int64), head[count:]))
    texts = list(numbers)
    least = least_owners(texts, owners, length)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(sizes + 1) - sizes - 1
    answers = []
    for own, owner in sent:
        windows = sizes[own] - length + 1
        place = np.repeat(begins[own] - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
        answers.append(np.packbits(least[place] < np.repeat(owner, windows)).tobytes())
    return table.drop_columns(["sent"]).append_column("sent", pa.array(answers, pa.binary()))


# --- cutting ---------------------------------------------------------------------------


def removed_bytes(pack: Pack, row: dict, shards: int, length: int) -> np.ndarray:
    """Which bytes of the pack go."""
    chosen, number, _, first, shard = _chosen(pack, row, shards, length)
    windows = pack.windows[chosen]
    # the first document with a text goes by the shard's bits, later ones with a greater id lose all of it
    size_of = pack.windows[first]
    bit_at = np.cumsum(size_of) - size_of
    bits = np.zeros(int(size_of.sum()), bool)
    answers = {a["shard"]: a["sent"] for a in row["texts"] or ()}
    order = np.argsort(shard, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
        if len(part):
            own = size_of[part]
            place = np.repeat(bit_at[part] - (np.cumsum(own) - own), own) + np.arange(own.sum())
            bits[place] = np.unpackbits(np.frombuffer(answers[int(shard[part[0]])], np.uint8), count=len(place))
    inside = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    later = pack.doc_ids[pack.document[chosen]] > pack.doc_ids[pack.document[first[number]]]
    marked = np.repeat(later, windows) | bits[np.repeat(bit_at[number], windows) + inside]
    starts = np.zeros(len(pack.raw) + 1, np.int32)
    starts[(np.repeat(pack.start[chosen], windows) + inside)[marked]] = 1
    covered = np.cumsum(starts[:-1], dtype=np.int32)
    covered[length:] -= covered[:-length].copy()
    return covered > 0


def kept_text(raw: bytes, turns: list[int]) -> str:
    """What lies outside the removed runs (``turns``: start, stop, start, ...), run by run as text."""
    edges = [0, *turns, len(raw)]
    return "".join(raw[a:b].decode("utf-8", "ignore") for a, b in zip(edges[::2], edges[1::2], strict=True))


def cut(joined: DataFrame, fields: T.StructType, shards: int, length: int, as_text: bool) -> DataFrame:
    result_fields = [T.StructField("kept", T.StringType()) if as_text and f.name == "kept" else f for f in RESULT.fields]
    schema = T.StructType([*fields.fields, *result_fields])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for row in batch.to_pylist():
                pack = Pack(row["rows"], length)
                gone = removed_bytes(pack, row, shards, length)
                result: dict[str, list] = {n: [] for n in RESULT.names}
                for a, b in zip(pack.bounds[:-1].tolist(), pack.bounds[1:].tolist(), strict=True):
                    own = gone[a:b]
                    turns = np.flatnonzero(np.diff(np.concatenate(([False], own, [False])).astype(np.int8))).tolist()
                    result["n_bytes"].append(b - a)
                    result["n_removed"].append(int(own.sum()))
                    result["spans"].append([{"start": x, "stop": y} for x, y in zip(turns[::2], turns[1::2], strict=True)])
                    result["kept"].append(
                        kept_text(pack.raw[a:b].tobytes(), turns) if as_text else pack.raw[a:b][~own].tobytes()
                    )
                kinds = _ARROW_RESULT | ({"kept": pa.string()} if as_text else {})
                columns = [pa.array(result[n], kind) for n, kind in kinds.items()]
                table = pa.Table.from_arrays([*pack.table.columns, *columns], names=schema.names)
                for part in regrouped(iter(table.to_batches()), "text"):
                    yield part

    return joined.mapInArrow(of, schema)


def deduplicated(
    docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text", as_text: bool = False
) -> DataFrame:
    """The columns of ``docs`` (id and text as ``doc_id`` and ``text``) and

    ``n_bytes``, ``n_removed``, ``spans`` (byte offsets of maximal removed runs), ``kept`` (the other
    bytes, or with ``as_text`` their text, without characters of which a part was removed).
    """
    if not GRAM + 8 <= length <= 56:
        raise ValueError("length must lie between 28 and 56")
    others = [c for c in docs.columns if c not in (id_column, text_column, "doc_id", "text", *RESULT.names)]
    named = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), *others)
    table = packs(named)
    total = table.agg(F.sum("n_bytes")).first()[0] or 0
    shards = 1 + total // SHARD_BYTES

    def answers(sent: DataFrame, name: str) -> DataFrame:
        return sent.groupBy("pack").agg(F.collect_list(F.struct("shard", "sent")).alias(name))

    keys = sent_keys(table.select("pack", "rows"), shards, length).groupBy("shard").applyInArrow(answer_keys, SENT)
    keys = stored(answers(keys, "keys"), "substring-keys")
    texts = (
        sent_texts(table.join(keys, "pack", "left"), shards, length)
        .groupBy("shard")
        .applyInArrow(lambda part: answer_texts(part, length), SENT)
    )
    texts = stored(answers(texts, "texts"), "substring-texts")
    return cut(table.join(keys, "pack", "left").join(texts, "pack", "left"), named.schema, shards, length, as_text)
