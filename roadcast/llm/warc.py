"""WARC archives as ``.warc.zst``: a dictionary in a leading skippable frame, a frame a record.

Every file starts with a skippable frame (magic 0x184D2A5D) that holds the Zstandard
dictionary, itself compressed, and goes on with one frame per record, as the WARC
Zstandard convention has it, so a file is read without any other and a record without
the records before it. The dictionary is trained on records as they are archived.

Payloads of equal bytes from ``min_revisit`` bytes on are stored once: the record with
the least page id is the ``response``, the others are ``revisit`` records with the
``identical-payload-digest`` profile, which keep the HTTP header and name the response.

Defined cases: a null payload is empty; a null URL gives ``urn:page:<id>``, and blanks and
control characters in a URL are percent-encoded; a null page id never is the one
referred to unless the whole group has none, and then each is a response; rows that repeat
the least page id are all responses; an empty table gives no records. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadcast.llm.common import drawn, file_system, regrouped, scratch_path, stored, write_whole

SKIPPABLE_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_REVISIT = 100
LEVEL = 3
READ_BYTES = 1 << 20
#: The dictionary is fitted on about so many records, none with a longer payload than this.
SAMPLE_RECORDS, SAMPLE_CHARS, DICTIONARY_BYTES = 400, 50_000, 65_536
LEAST_DICTIONARY = 512
MANIFEST = "file string, records long"


# --- records ---------------------------------------------------------------------------


def record_uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(uri: str) -> int | None:
    number = uri.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool, date: str) -> bytes:
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    target = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else record_uri(page_id)[1:-1]
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_uri(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_uri(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Header fields in lower case, ``payload`` (None in a revisit) and ``payload_bytes``."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [v for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")) if k.lower() == b"content-length"]
    revisit = fields["warc-type"] == "revisit"
    return fields | {"payload": None if revisit else payload, "payload_bytes": int(sizes[0])}


# --- files -----------------------------------------------------------------------------


def dictionary_frame(dictionary: bytes) -> bytes:
    content = zstandard.compress(dictionary)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(content)) + content


def read_records(source) -> Iterator[bytes]:
    """Records of an open ``.warc.zst`` one by one; the file is never held whole."""
    magic, length = struct.unpack("<II", source.read(8))
    if magic != SKIPPABLE_MAGIC:
        raise ValueError("no dictionary frame at the start")
    dictionary = zstandard.decompress(source.read(length))
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    decompressor = zstandard.ZstdDecompressor(dict_data=shared)
    ahead = source.read(READ_BYTES)
    while ahead:
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            if not ahead:
                raise ValueError("the file ends inside a record")
            parts.append(frame.decompress(ahead))
            ahead = b"" if frame.eof else source.read(READ_BYTES)
        yield b"".join(parts)
        ahead = frame.unused_data or source.read(READ_BYTES)


def train_dictionary(records: list[bytes]) -> bytes:
    """The smaller the less there is to train on; empty if the records have nothing in common."""
    size = min(DICTIONARY_BYTES, sum(map(len, records)) // 8)
    try:
        return zstandard.train_dictionary(max(size, LEAST_DICTIONARY), records, k=256, d=8).as_bytes()
    except zstandard.ZstdError:  # a handful of records, or none
        return b""


# --- jobs ------------------------------------------------------------------------------


def with_revisits(pages: DataFrame, id_column: str, url_column: str, payload_column: str, min_revisit: int) -> DataFrame:
    """``page_id, url, payload, digest, refers_to, revisit``.

    Groups of equal payloads are counted on digests alone. Only digests that occur more
    than once are joined back, and a digest that very many pages share is one row on that
    side, so the join's large partitions can be split.
    """
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        F.coalesce(F.col(payload_column).cast("string"), F.lit("")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    groups = (
        rows.filter(F.octet_length("payload") >= min_revisit)
        .groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
        .filter("n > 1 AND refers_to IS NOT NULL")
        .drop("n")
    )
    joined = rows.join(stored(groups, "warc-groups"), "digest", "left")
    return joined.withColumn("revisit", F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to")))


def write_archives(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    min_revisit: int = MIN_REVISIT,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write one file a task. Returns the manifest: ``file, records``."""
    rows = with_revisits(pages, id_column, url_column, payload_column, min_revisit)
    sample = (
        drawn(pages, id_column, SAMPLE_RECORDS)
        .filter(F.length(payload_column).between(1, SAMPLE_CHARS))
        .select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), F.col(payload_column).alias("payload"))
        .collect()
    )
    dictionary = train_dictionary(
        [
            record_bytes(r["page_id"], r["url"], raw := r["payload"].encode(), hashlib.sha256(raw).hexdigest(), None, False, date)
            for r in sample
        ]
    )

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        written = 0

        def frames() -> Iterator[bytes]:
            nonlocal written
            yield dictionary_frame(dictionary)
            for batch in regrouped(batches, "payload"):
                for r in batch.to_pylist():
                    written += 1
                    yield compressor.compress(
                        record_bytes(
                            r["page_id"], r["url"], r["payload"].encode(), r["digest"], r["refers_to"], r["revisit"], date
                        )
                    )

        name = f"part-{TaskContext.get().partitionId():05d}.warc.zst"
        write_whole(f"{folder}/{name}", frames())
        yield pa.RecordBatch.from_pydict({"file": [name], "records": [written]})

    return stored(rows.mapInArrow(of, MANIFEST), "warc-manifest")


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """``page_id, url, record_type, payload, payload_bytes, payload_digest, refers_to`` of every record.

    A response's digest is computed from the payload that was read.
    """
    files = manifest.filter("records > 0").select("file")
    tasks = files.repartition(max(1, files.count()), "file")
    schema = pa.schema(
        [
            ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
        ]
    )

    def rows_of(name: str) -> Iterator[dict]:
        system, root = file_system(folder)
        with system.open_input_stream(f"{root}/{name}", compression=None) as source:
            for raw in read_records(source):
                record = parse_record(raw)
                payload = record["payload"]
                yield {
                    "page_id": page_of(record["warc-record-id"]),
                    "url": record["warc-target-uri"],
                    "record_type": record["warc-type"],
                    "payload": payload,
                    "payload_bytes": record["payload_bytes"],
                    "payload_digest": record["warc-payload-digest"].removeprefix("sha256:")
                    if payload is None
                    else hashlib.sha256(payload).hexdigest(),
                    "refers_to": page_of(record["warc-refers-to"]) if payload is None else None,
                }

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                waiting, held = [], 0
                for row in rows_of(name):
                    waiting.append(row)
                    held += row["payload_bytes"]
                    if held > 4 << 20 or len(waiting) >= 2000:
                        yield pa.RecordBatch.from_pylist(waiting, schema=schema)
                        waiting, held = [], 0
                yield pa.RecordBatch.from_pylist(waiting, schema=schema)

    return tasks.mapInArrow(
        of,
        "page_id long, url string, record_type string, payload binary, payload_bytes long, "
        "payload_digest string, refers_to long",
    )


def archived(pages: DataFrame) -> DataFrame:
    """Write to a scratch folder and read back."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    return read_archives(spark, folder, write_archives(pages, folder))
