"""Two tokenizers aligned on the bytes of the same text.

A text has the tokens of a byte-level BPE file (A, of the text behind one space) and of a
SentencePiece model (B, which puts that space there itself). For each text the byte
offset at which a token ends leads to the token's number, in a dictionary for either side;
the offsets that both dictionaries have, sorted, cut both lists into groups that cover the
same bytes. Inside a group every stretch between neighbouring ends lies in one token of A
and one of B, and these two are a link: that is every pair whose byte ranges overlap.

How often each id pair is linked is counted over the whole corpus in two steps, since the
links themselves outnumber the input. A task turns about ``BLOCK_BYTES`` of text into a block:
its distinct pairs with their counts, and for every text which of these it has, as compressed
arrays. Spark sums the pairs of all blocks, marks the commonest pairs of each B id, and joins
the totals back to the blocks' pairs; a block meets its answers in one group of bounded size.
Blocks are written before they are counted, so later stages and retries see the same ones.

Defined cases: a null or empty text, and one whose tokens of A or B put together are not
the space and the text, has no tokens: zeros and an empty ``groups_sha256``. Long texts are
whole; one longer than a block is a block. Repeated rows and ids count as texts of their own,
a null id stays null, ties for the commonest pair all count, an empty table gives an
empty result, other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadcast.llm.bpe import CHAR_TO_BYTE
from roadcast.llm.common import kept, regrouped, stored
from roadcast.llm.tokens import WordEncoder

BATCH_BYTES, BLOCK_BYTES = 1 << 20, 8 << 20
PIECE_SPACE = "▁"
Groups = list[tuple[list[int], list[int]]]


class TokenPair:
    """Both tokenizers with the bytes of their entries."""

    def __init__(self, byte_bpe_path: str, piece_path: str):
        import sentencepiece

        self.a = WordEncoder(byte_bpe_path)
        self.a.tokenizer.encode_special_tokens = True  # their strings are plain text
        vocabulary = self.a.tokenizer.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.bytes_a[i] = entry.translate(CHAR_TO_BYTE).encode("latin-1", "ignore")
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = [(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if byte else piece.replace(PIECE_SPACE, " ").encode() for piece, byte in pieces
        ]
        # a byte-level vocabulary with every single byte gives any text back
        self.lossless = self.a.tokenizer.normalizer is None and {bytes([i]) for i in range(256)} <= set(self.bytes_a)
        self.groups_text = GroupsText(len(self.bytes_a), len(self.bytes_b))
        self.lengths_a, self.lengths_b = (np.array([*map(len, x)], np.int64) for x in (self.bytes_a, self.bytes_b))

    def encode(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """The ids of A and of B for each text, or None where a text has no tokens."""
        filled = [t for t in texts if t]
        ids, bounds = self.a.encode([" " + t for t in filled], 0)
        bounds = bounds.tolist()
        pieces = self.b.encode(filled, num_threads=1) if filled else []
        nth = 0
        for text in texts:
            if not text:
                yield None
                continue
            a, b = ids[bounds[nth] : bounds[nth + 1] - 1], pieces[nth]
            nth += 1
            whole = b" " + text.encode()
            fits = (self.lossless or b"".join(map(self.bytes_a.__getitem__, a.tolist())) == whole) and (
                b"".join(map(self.bytes_b.__getitem__, b)) == whole
            )
            yield (a.astype(np.int64), np.array(b, np.int64)) if fits else None


def pair_of(byte_bpe_path: str, piece_path: str) -> TokenPair:
    """The tokenizers of this worker process; they outlive a task."""
    return kept(("pair", byte_bpe_path, piece_path), lambda: TokenPair(byte_bpe_path, piece_path))


def common_cuts(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[list[int], list[int]]:
    """Where both lists are cut: the numbers of tokens up to each end that both have, and 0."""
    index_a = dict(zip(ends_a.tolist(), range(1, len(ends_a) + 1), strict=True))
    index_b = dict(zip(ends_b.tolist(), range(1, len(ends_b) + 1), strict=True))
    common = sorted(index_a.keys() & index_b.keys())
    return [0, *map(index_a.__getitem__, common)], [0, *map(index_b.__getitem__, common)]


def links_of(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the tokens of all links in text order, one link a stretch between neighbouring ends."""
    ends = np.concatenate([ends_a, ends_b])
    ends.sort(kind="stable")  # two ascending runs: merged, not sorted
    ends = ends[np.append(ends[1:] != ends[:-1], True)] if len(ends) else ends
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


class GroupsText:
    """Writes groups as ``a1,a2|b1;a3|b2,b3``: every id is a ready string that brings the sign behind it along."""

    def __init__(self, entries_a: int, entries_b: int):
        self.tables = [f"{i}{sign}" for entries, signs in ((entries_a, ",|"), (entries_b, ",;")) for sign in signs for i in range(entries)]
        self.starts = 0, entries_a, 2 * entries_a, 2 * entries_a + entries_b

    def __call__(self, a: np.ndarray, b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> str:
        order = np.empty(len(a) + len(b), np.int64)
        one, two = a + self.starts[0], b + self.starts[2]
        one[cuts_a[1:] - 1] += self.starts[1] - self.starts[0]
        two[cuts_b[1:] - 1] += self.starts[3] - self.starts[2]
        order[np.arange(len(a)) + np.repeat(cuts_b[:-1], np.diff(cuts_a))] = one
        order[np.arange(len(b)) + np.repeat(cuts_a[1:], np.diff(cuts_b))] = two
        return "".join(map(self.tables.__getitem__, order.tolist()))[:-1]


BLOCK_SCHEMA = pa.schema(
    [
        ("block", pa.int64()),
        ("pairs", pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int64())]))),
        (
            "docs",
            pa.list_(
                pa.struct(
                    [("doc_id", pa.int64())]
                    + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
                    + [("groups_sha256", pa.string())]
                )
            ),
        ),
        ("links", pa.binary()),
    ]
)
BLOCK = (
    "block long, pairs array<struct<pair: long, n: long>>, docs array<struct<doc_id: long, n_a: long, n_b: long, "
    "n_groups: long, n_links: long, groups_sha256: string>>, links binary"
)


class _Block:
    """What a task gathers until it writes a block."""

    def __init__(self):
        self.bytes, self.docs, self.keys, self.times = 0, [], [], []

    def add(self, doc_id: int | None, ids: tuple[np.ndarray, np.ndarray] | None, pair: TokenPair, size: int) -> None:
        row = {"doc_id": doc_id, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": ""}
        keys = times = np.empty(0, np.int64)
        if ids is not None:
            a, b = ids
            ends_a, ends_b = np.cumsum(pair.lengths_a[a]), np.cumsum(pair.lengths_b[b])
            cuts_a, cuts_b = common_cuts(ends_a, ends_b)
            at_a, at_b = links_of(ends_a, ends_b)
            keys, times = np.unique(a[at_a] * len(pair.bytes_b) + b[at_b], return_counts=True)
            digest = hashlib.sha256(pair.groups_text(a, b, np.array(cuts_a), np.array(cuts_b)).encode()).hexdigest()
            row.update(n_a=len(a), n_b=len(b), n_groups=len(cuts_a) - 1, n_links=len(at_a), groups_sha256=digest)
        self.docs.append(row)
        self.keys.append(keys)
        self.times.append(times)
        self.bytes += size

    def batch(self, number: int) -> pa.RecordBatch:
        """One row. ``links`` holds, for each text in a row, its distinct pairs (by place in ``pairs``) and their counts."""
        coded = pa.array(np.concatenate(self.keys)).dictionary_encode()
        times = np.concatenate(self.times)
        found = coded.dictionary.to_numpy()
        order = np.argsort(found)
        nth = np.empty(len(order), np.int64)
        nth[order] = np.arange(len(order))
        place, pairs = nth[coded.indices.to_numpy()], found[order]
        counts = np.zeros(len(pairs), np.int64)
        np.add.at(counts, place, times)
        arrays = np.array([*map(len, self.keys)]), place, times
        packed = zstandard.compress(b"".join(x.astype("<u4").tobytes() for x in arrays), 1)
        entries = pa.StructArray.from_arrays([pa.array(pairs), pa.array(counts, pa.int64())], ["pair", "n"])
        listed = pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), entries)
        columns = [pa.array([number], pa.int64()), listed, pa.array([self.docs], BLOCK_SCHEMA.field("docs").type), pa.array([packed])]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, BLOCK_SCHEMA, strict=True)], schema=BLOCK_SCHEMA)


def written_blocks(docs: DataFrame, byte_bpe_path: str, piece_path: str) -> DataFrame:
    """The corpus as blocks, written to the scratch folder."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(byte_bpe_path, piece_path)
        block, number = _Block(), TaskContext.get().partitionId() << 32
        for batch in regrouped(batches, "text", BATCH_BYTES):
            texts = batch.column("text").to_pylist()
            for doc_id, text, ids in zip(batch.column("doc_id").to_pylist(), texts, pair.encode(texts), strict=True):
                block.add(doc_id, ids, pair, len(text or ""))
                if block.bytes >= BLOCK_BYTES:
                    yield block.batch(number)
                    block, number = _Block(), number + 1
        if block.docs:
            yield block.batch(number)

    return stored(docs.mapInArrow(of, BLOCK), "aligned-blocks")


def pair_counts(blocks: DataFrame, pieces: int) -> DataFrame:
    """``pair, total, best``: links of each id pair in the corpus, and whether its B id has no commoner pair."""
    pairs = blocks.select(F.explode("pairs").alias("e")).select("e.*")
    totals = pairs.groupBy("pair").agg(F.sum("n").alias("total"))
    totals = stored(totals.withColumn("b", F.col("pair") % pieces), "pair-totals")
    most = totals.groupBy("b").agg(F.max("total").alias("most"))
    return totals.join(most, "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)
RESULT_SCHEMA = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    + [("groups_sha256", pa.string())]
)


def answered(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """The rows of one block's texts; ``answers`` has the totals of its pairs in any order."""
    order = np.argsort(answers.column("pair").to_numpy())
    total = answers.column("total").to_numpy()[order]
    best = answers.column("best").to_numpy()[order]
    parts = []
    for number in range(blocks.num_rows):
        docs = pa.Table.from_struct_array(blocks.column("docs").combine_chunks().slice(number, 1).flatten())
        raw = np.frombuffer(zstandard.decompress(blocks.column("links")[number].as_py()), "<u4").astype(np.int64)
        sizes, (place, times) = raw[: docs.num_rows], raw[docs.num_rows :].reshape(2, -1)
        ends = np.concatenate(([0], np.cumsum(sizes)))
        for name, of_pair in (("n_best", best), ("count_sum", total)):
            running = np.concatenate(([0], np.cumsum(times * of_pair[place])))
            docs = docs.append_column(name, pa.array(np.diff(running[ends]), pa.int64()))
        parts.append(docs.select(RESULT_SCHEMA.names).cast(RESULT_SCHEMA))
    return pa.concat_tables(parts) if parts else RESULT_SCHEMA.empty_table()


def aligned(
    docs: DataFrame, byte_bpe_path: str, piece_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per text: its tokens, groups and links, and how common its links are in the corpus."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    blocks = written_blocks(rows, byte_bpe_path, piece_path)
    pieces = len(pair_of(byte_bpe_path, piece_path).bytes_b)
    asked = blocks.select(F.col("block").alias("of_block"), F.explode("pairs").alias("e")).select("of_block", "e.pair")
    answers = asked.join(pair_counts(blocks, pieces), "pair")
    both = blocks.select("block", "docs", "links").groupBy("block").cogroup(answers.groupBy("of_block"))
    return both.applyInArrow(answered, RESULT)
