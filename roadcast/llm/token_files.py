"""Token ids in binary shards: documents compressed one by one with a shared dictionary.

A folder holds ``dictionary`` (a Zstandard dictionary trained on serialized id arrays) and
one ``shard-NNNNN.tids`` per range of ids. A shard is

* ``TIDS1\\n``, a byte for the width of an id (2 or 4), the SHA-256 of the dictionary file,
* one Zstandard frame per document, of its ids as little-endian unsigned integers,
* the index: a frame of the document ids, one of their null marks, of the frames' offsets
  and of the id counts (each little-endian, 64 or 8 bits),
* four lengths of these index frames, the index offset, and the number of documents (u64).

``TokenShard`` opens one and gives any document by position without reading the others.

Defined cases: a null or empty text is its end id alone; a null document id sorts first;
repeated ids are documents of their own, ordered by a hash of their text; an empty
table gives a folder with a dictionary and no documents. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadcast.llm.common import drawn, file_system, regrouped, scratch_path, stored, write_whole
from roadcast.llm.bpe import ForcedBoundaryBPE, coder_of

MAGIC = b"TIDS1\n"
TAIL = "<6Q"
LEVEL, TEXT_BYTES = 3, 2 << 20
#: The dictionary is fitted on about so many texts, of longer ones on so many characters of their middle.
SAMPLE_TEXTS, SAMPLE_CHARS, DICTIONARY_BYTES, LEAST_DICTIONARY = 400, 20_000, 32_768, 512


def id_width(tokenizer_path: str) -> int:
    return 2 if len(coder_of(tokenizer_path).entries) <= 1 << 16 else 4


def train_dictionary(texts: list[str], tokenizer_path: str, end_id: int) -> bytes:
    """A dictionary from the id arrays of ``texts``, the smaller the less there is; empty if they have nothing in common."""
    dtype = f"<u{id_width(tokenizer_path)}"
    ids, bounds = coder_of(tokenizer_path).encode_ended(texts, end_id)
    samples = [ids[a:b].astype(dtype).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    try:
        return zstandard.train_dictionary(max(size, LEAST_DICTIONARY), samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:  # a handful of texts, or none
        return b""


def dictionary_sample(docs: DataFrame) -> list[str]:
    """About ``SAMPLE_TEXTS`` texts, in a fixed order."""
    start = F.greatest(F.lit(1), (F.length("text") / 2 - SAMPLE_CHARS / 2).cast("int"))
    fitting = drawn(docs, "doc_id", SAMPLE_TEXTS).filter(F.length("text") > 0)
    return sorted(r["text"] for r in fitting.select(F.substr("text", start, F.lit(SAMPLE_CHARS)).alias("text")).collect())


def shard_bytes(
    batches: Iterator[pa.RecordBatch], encoder: ForcedBoundaryBPE, end_id: int, width: int, dictionary: bytes, totals: dict
) -> Iterator[bytes]:
    """The bytes of one shard; ``totals`` gets its numbers of documents and ids."""
    compressor = zstandard.ZstdCompressor(
        level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    )
    head = MAGIC + bytes([width]) + hashlib.sha256(dictionary).digest()
    yield head
    at, offsets, counts, ids_of, nulls = len(head), [len(head)], [], [], []
    for batch in regrouped(batches, "text", TEXT_BYTES):
        ids, bounds = encoder.encode_ended(batch.column("text").to_pylist(), end_id)
        raw = memoryview(ids.astype(f"<u{width}").tobytes())
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            frame = compressor.compress(raw[a * width : b * width])
            at += len(frame)
            offsets.append(at)
            yield frame
        counts.append(np.diff(bounds))
        ids_of.append(batch.column("doc_id").fill_null(0).to_numpy())
        nulls.append(batch.column("doc_id").is_null().to_numpy(zero_copy_only=False))
    empty = np.empty(0, np.int64)
    index = [
        np.concatenate([empty, *ids_of]).astype("<i8"), np.concatenate([empty, *nulls]).astype("u1"),
        np.array(offsets, "<u8"), np.concatenate([empty, *counts]).astype("<u8"),
    ]
    frames = [zstandard.compress(part.tobytes()) for part in index]
    yield from frames
    yield struct.pack(TAIL, *map(len, frames), at, len(index[0]))
    totals.update(documents=len(index[0]), ids=int(index[3].sum()))


class TokenShard:
    """Random access to a shard's documents."""

    def __init__(self, source, size: int, dictionary: bytes):
        self.source = source
        *lengths, index_at, self.documents = struct.unpack(TAIL, self._read(size - struct.calcsize(TAIL), struct.calcsize(TAIL)))
        head = self._read(0, len(MAGIC) + 33)
        if head[: len(MAGIC)] != MAGIC or head[len(MAGIC) + 1 :] != hashlib.sha256(dictionary).digest():
            raise ValueError("not a shard written with this dictionary")
        self.width = head[len(MAGIC)]
        parts = []
        for length in lengths:
            parts.append(zstandard.decompress(self._read(index_at, length)))
            index_at += length
        self.doc_ids, self.nulls, self.offsets, self.counts = (
            np.frombuffer(p, kind) for p, kind in zip(parts, ("<i8", "u1", "<u8", "<u8"), strict=True)
        )
        self.decompressor = zstandard.ZstdDecompressor(
            dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        )

    def _read(self, at: int, length: int) -> bytes:
        self.source.seek(at)
        return self.source.read(length)

    def __getitem__(self, position: int) -> np.ndarray:
        start, stop = int(self.offsets[position]), int(self.offsets[position + 1])
        raw = self.decompressor.decompress(self._read(start, stop - start))
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")


def open_shard(folder: str, name: str) -> TokenShard:
    system, root = file_system(folder)
    with system.open_input_stream(f"{root}/dictionary", compression=None) as source:
        dictionary = source.read()
    return TokenShard(system.open_input_file(f"{root}/{name}"), system.get_file_info(f"{root}/{name}").size, dictionary)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Write ``docs`` in ascending id order. Returns the manifest: ``shard, documents, ids``, a row per file."""
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    dictionary = train_dictionary(dictionary_sample(docs), tokenizer_path, end_id)
    write_whole(f"{folder}/dictionary", iter([dictionary]))
    width = id_width(tokenizer_path)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, totals = TaskContext.get().partitionId(), {}
        encoder = coder_of(tokenizer_path)
        name = f"{folder}/shard-{shard:05d}.tids"
        write_whole(name, shard_bytes(batches, encoder, end_id, width, dictionary, totals))
        yield pa.RecordBatch.from_pylist([{"shard": shard, **totals}], schema=manifest)

    manifest = pa.schema([("shard", pa.int32()), ("documents", pa.int64()), ("ids", pa.int64())])
    tied = docs.withColumn("tie", F.xxhash64("text"))
    ordered = tied.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").drop("tie")
    return stored(ordered.mapInArrow(of, "shard int, documents long, ids long"), "token-manifest")


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files.

    ``start`` is the number of ids of all documents before it: a running total over the
    shards (a row per file) plus one inside the shard.
    """
    rows, base = [], 0
    for shard, documents, ids in sorted(map(tuple, manifest.collect())):
        if documents:
            rows.append((shard, base))
        base += ids
    tasks = spark.createDataFrame(rows, "shard int, base long").repartition(max(1, len(rows)), "shard")
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    )

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch.to_pylist():
                shard = open_shard(folder, f"shard-{task['shard']:05d}.tids")
                crcs, lengths = [], []
                for position in range(shard.documents):
                    ids = shard[position]
                    crcs.append(zlib.crc32(ids.tobytes()))
                    lengths.append(len(ids))
                lengths = np.array(lengths, np.int64)
                starts = task["base"] + np.cumsum(lengths) - lengths
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.doc_ids, pa.int64(), mask=shard.nulls.astype(bool)),
                        pa.array(starts),
                        pa.array(lengths),
                        pa.array(crcs, pa.int64()),
                    ],
                    schema=schema,
                )

    return tasks.mapInArrow(of, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_table(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write to a scratch folder and read back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-files")
    return read_token_files(spark, folder, write_token_files(docs, folder, tokenizer_path, end_id))
