"""SimHash near-duplicates by pivot distance tables, and documents of a Jaccard similarity.

``fingerprints`` gives each text a SimHash over word shingles, ``near_links`` finds
fingerprints within a Hamming radius and ``near_classes`` labels documents by the
connected component of their fingerprint.

Candidates meet through keys: fingerprints that agree on a choice of bits share a row
group. Inside a group every fingerprint carries its distances to fixed reference
fingerprints (pivots). By the triangle inequality two fingerprints within ``radius``
differ by at most ``radius`` in each of these distances, so pairs with a larger
coordinate difference are discarded and only the survivors' bits are compared. A group of
over ``LONG_GROUP`` fingerprints is dealt again by choices among the bits it does not share yet;
fingerprints are distinct, so a group then has at most 2 to the power of the bits left.

Defined cases: a null or empty text, or one of white space, has fingerprint zero and
links like any other; equal texts have equal fingerprints; repeated rows are rows of
their own, also if they share an id: the class of each follows from its text; a null id keeps its row
but never names a class unless the class has no other id, and then the class is null. Columns other than the id and the text are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadcast.llm.common import let_go, spread, stored
from roadcast.operators.components import component_labels

HASH_SEED = 42
PIVOTS = 16
SMALL_RUN = 64
LONG_GROUP = 4096
FINER_BLOCKS = 4
BLOCK = 2048


# --- fingerprints ----------------------------------------------------------------------


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of every word shingle of a text, repeats included; of the whole sequence if shorter."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(joined, HASH_SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-shingle])).tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    return np.fromiter(
        (digest(joined[a:b], HASH_SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, len(stops)
    )


def _mixed(h: np.ndarray, lane: int) -> np.ndarray:
    """The ``lane``-th 64-bit word derived from a hash; lane 0 is the hash itself (splitmix64)."""
    if lane == 0:
        return h
    z = h + np.uint64(lane * 0x9E3779B97F4A7C15 % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def simhash(hashes: np.ndarray, lanes: int) -> bytes:
    """Big-endian fingerprint of ``64 * lanes`` bits: a bit is 1 if set in over half the hashes."""
    if not len(hashes):
        return bytes(8 * lanes)
    out = b""
    for lane in range(lanes):
        ones = np.zeros(64, np.int64)
        mixed = _mixed(hashes, lane)
        for at in range(0, len(mixed), BLOCK * 8):
            block = mixed[at : at + BLOCK * 8].astype(">u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int32)
        out += np.packbits(2 * ones > len(hashes)).tobytes()
    return out


def fingerprints(
    docs: DataFrame, id_column: str, text_column: str, shingle: int, lanes: int, keep: Sequence[str] = ()
) -> DataFrame:
    """``doc_id, fp`` (binary) and the columns to keep for every row of ``docs``."""
    rows = spread(docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), *keep), "doc_id")
    names = ["doc_id", *keep]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            prints = [simhash(shingle_hashes(t.as_py(), shingle), lanes) for t in batch.column("text")]
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(prints, pa.binary())], names=[*names, "fp"])

    return rows.mapInArrow(of, T.StructType([*(rows.schema[c] for c in names), T.StructField("fp", T.BinaryType())]))


# --- keys ------------------------------------------------------------------------------


def block_choices(bits: int, radius: int) -> list[np.ndarray]:
    """Bit choices of which two fingerprints within ``radius`` share at least one exactly.

    The bits fall into ``radius + 2`` blocks; ``radius`` differing bits leave two blocks untouched.
    """
    blocks = np.array_split(np.arange(bits), radius + 2)
    return [np.concatenate(pair) for pair in combinations(blocks, 2)]


def keyed(classes: DataFrame, choices: list[np.ndarray]) -> DataFrame:
    """``tab, key, node, fp``: each class once for every choice of bits."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("fp").to_pylist()
            bits = np.unpackbits(np.frombuffer(b"".join(prints), np.uint8).reshape(len(prints), -1), axis=1)
            for tab, choice in enumerate(choices):
                weights = np.int64(1) << np.arange(len(choice), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(prints), tab, np.int32)),
                        pa.array(bits[:, choice].astype(np.int64) @ weights),
                        batch.column("node"),
                        batch.column("fp"),
                    ],
                    names=["tab", "key", "node", "fp"],
                )

    return classes.select("node", "fp").mapInArrow(of, "tab int, key long, node long, fp binary")


# --- pairs -----------------------------------------------------------------------------


def pivot_fingerprints(lanes: int, count: int = PIVOTS, seed: int = 11) -> np.ndarray:
    """Reference fingerprints, the same in every task: random words, each beside its left-half complement."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**64, (count // 2, lanes), np.uint64, endpoint=False)
    return np.concatenate([base, base ^ np.uint64(0xFFFFFFFF00000000)])


def pivot_table(prints: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distances ``(n, pivots)`` of fingerprints ``(n, lanes)`` to every pivot."""
    table = np.zeros((len(prints), len(pivots)), np.int16)
    for lane in range(prints.shape[1]):
        table += np.bitwise_count(prints[:, lane, None] ^ pivots[None, :, lane])
    return table


def _survivors(a: np.ndarray, b: np.ndarray, table: np.ndarray, prints: np.ndarray, radius: int) -> np.ndarray:
    """Which of the pairs ``(a[i], b[i])`` are within ``radius``: pivots discard, bits decide."""
    alive = np.arange(len(a))
    for pivot in range(table.shape[1]):
        near = np.abs(table[a[alive], pivot] - table[b[alive], pivot]) <= radius
        alive = alive[near]
    differing = np.bitwise_count(prints[a[alive]] ^ prints[b[alive]]).sum(axis=1, dtype=np.int32)
    return alive[differing <= radius]


def _long_run(table: np.ndarray, prints: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Links that connect a long run exactly as all its links would, by breadth-first search.

    Every member is taken once and compared with the members that no search has reached
    yet. They stay sorted by their distance to the first pivot, so only the stretch
    within ``radius`` of it is looked at; the other coordinates thin that stretch before
    bits are compared. At most one link a member comes out.
    """
    rest = np.argsort(table[:, 0], kind="stable")
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            first = table[rest, 0]
            low, high = np.searchsorted(first, (table[at, 0] - radius, table[at, 0] + radius + 1))
            span = np.arange(low, high)
            for pivot in range(1, table.shape[1]):
                span = span[np.abs(table[rest[span], pivot] - table[at, pivot]) <= radius]
                if not len(span):
                    break
            if len(span):
                differing = np.bitwise_count(prints[rest[span]] ^ prints[at]).sum(axis=1, dtype=np.int32)
                span = span[differing <= radius]
                found = rest[span]
                rest = np.delete(rest, span)
                for other in found.tolist():
                    yield at, other
                queue.extend(found.tolist())


def links_in_runs(run: np.ndarray, prints: np.ndarray, radius: int, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions ``(a, b)`` of linked rows. ``run`` numbers the groups of a sorted table.

    Short runs give all their links, lag by lag over the whole table at once; long ones
    give the links of ``_long_run``, which connect the same members.
    """
    starts = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
    sizes = np.diff(np.append(starts, len(run)))
    size_of = np.repeat(sizes, sizes)
    left, right = [], []
    table = pivot_table(prints, pivots)
    position = np.arange(len(run)) - np.repeat(starts, sizes)
    for lag in range(1, min(int(sizes.max(initial=0)), SMALL_RUN)):
        a = np.flatnonzero((size_of <= SMALL_RUN) & (position + lag < size_of))
        if not len(a):
            break
        alive = _survivors(a, a + lag, table, prints, radius)
        left.append(a[alive])
        right.append(a[alive] + lag)
    for i in np.flatnonzero(sizes > SMALL_RUN):
        rows = slice(starts[i], starts[i] + sizes[i])
        pairs = np.array(list(_long_run(table[rows], prints[rows], radius)), np.int64).reshape(-1, 2)
        left.append(pairs[:, 0] + starts[i])
        right.append(pairs[:, 1] + starts[i])
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def finer(groups: DataFrame, choices: list[np.ndarray], radius: int) -> DataFrame:
    """The rows of large groups dealt again: each once for every choice among blocks of the bits not in its key.

    ``radius`` differing bits leave ``FINER_BLOCKS - radius`` of these blocks untouched, so linked rows meet again.
    """
    bits = np.arange(64)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tabs, keys = batch.column("tab").to_numpy(), batch.column("key").to_numpy()
            raw = np.frombuffer(b"".join(batch.column("fp").to_pylist()), np.uint8).reshape(len(tabs), -1)
            prints = np.unpackbits(raw, axis=1)
            for tab in np.unique(tabs).tolist():
                own = np.flatnonzero(tabs == tab)
                blocks = np.array_split(np.setdiff1d(bits, choices[tab]), FINER_BLOCKS)
                for nth, chosen in enumerate(combinations(blocks, FINER_BLOCKS - radius)):
                    choice = np.concatenate(chosen)
                    weights = np.int64(1) << np.arange(len(choice), dtype=np.int64)
                    key = keys[own] << np.int64(len(choice)) | prints[own][:, choice].astype(np.int64) @ weights
                    table = pa.array(np.full(len(own), len(choices) * (nth + 1) + tab, np.int32))
                    kept = [batch.column(c).take(pa.array(own)) for c in ("node", "fp")]
                    yield pa.RecordBatch.from_arrays([table, pa.array(key), *kept], names=["tab", "key", "node", "fp"])

    return groups.select("tab", "key", "node", "fp").mapInArrow(of, "tab int, key long, node long, fp binary")


def near_links(classes: DataFrame, choices: list[np.ndarray], radius: int) -> DataFrame:
    """``a, b``: linked nodes. ``classes`` has ``node`` (unique) and ``fp`` (distinct, 64 bits)."""
    groups = keyed(classes, choices)
    large = groups.groupBy("tab", "key").count().filter(F.col("count") > LONG_GROUP).select("tab", "key")
    large = stored(large, "simhash-large")
    if large.isEmpty():
        return links_of_groups(groups, radius)
    rest = groups.join(large, ["tab", "key"], "left_anti").select("tab", "key", "node", "fp")
    again = finer(groups.join(large, ["tab", "key"], "left_semi"), choices, radius)
    return links_of_groups(rest.unionByName(again), radius)


def links_of_groups(keyed_rows: DataFrame, radius: int) -> DataFrame:
    lanes = 1
    groups = keyed_rows.repartition("tab", "key").sortWithinPartitions("tab", "key")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = pivot_fingerprints(lanes)
        held: list[pa.RecordBatch] = []  # the last run so far, which the next batch may go on with

        def done(table: pa.Table) -> pa.RecordBatch:
            tab, key = table["tab"].to_numpy(), table["key"].to_numpy()
            run = np.cumsum(np.concatenate(([0], (tab[1:] != tab[:-1]) | (key[1:] != key[:-1]))))
            raw = b"".join(table["fp"].to_pylist())
            prints = np.frombuffer(raw, ">u8").astype(np.uint64).reshape(-1, lanes)
            a, b = links_in_runs(run, prints, radius, pivots)
            node = table["node"].to_numpy()
            return pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            tab, key = batch.column("tab").to_numpy(), batch.column("key").to_numpy()
            other = np.flatnonzero((tab != tab[-1]) | (key != key[-1]))
            cut = int(other[-1]) + 1 if len(other) else 0
            ahead = held and (held[0]["tab"][0].as_py(), held[0]["key"][0].as_py()) != (int(tab[-1]), int(key[-1]))
            if cut or ahead:
                yield done(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield done(pa.Table.from_batches(held))

    return groups.mapInArrow(of, "a long, b long")


def near_classes(prints: DataFrame, choices: list[np.ndarray], radius: int) -> DataFrame:
    """Stored ``prints`` (``doc_id`` long, ``fp`` of 64 bits, and more) with ``component`` and ``component_id``.

    Equal fingerprints are one class before any comparison, numbered by the fingerprint itself, so
    that a class is right whatever ids its rows have. ``component`` is the least number in a component,
    ``component_id`` the least id.
    """
    number = F.expr("CAST(conv(hex(fp), 16, -10) AS BIGINT)")
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")).withColumn("node", number), "simhash-classes")
    links = stored(near_links(classes, choices, radius), "simhash-links")
    joined = classes.join(component_labels(links), "node", "left").select("fp", "least", F.coalesce("component", "node").alias("component"))
    named = stored(joined, "simhash-named")
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return prints.join(named.drop("least").join(ids, "component"), "fp")


def linked_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 3,
    radius: int = 2,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Exact components of 64-bit fingerprints that differ in at most ``radius`` bits, and the columns to keep."""
    prints = stored(fingerprints(docs, id_column, text_column, shingle, 1, keep), "simhash-prints")
    return near_classes(prints, block_choices(64, radius), radius).select("doc_id", "fp", "component_id", "component", *keep)
