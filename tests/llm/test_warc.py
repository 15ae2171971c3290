import hashlib
import io

import pytest
import zstandard
from pyspark.sql import functions as F

from roadcast.llm import warc
from roadcast.llm.common import file_system, scratch_path

LONG = "<p>" + "déjà vu " * 40 + "</p>"
SCHEMA = "page_id long, url string, html string"
ROWS = [
    (1, "http://a/x y", LONG), (2, None, LONG), (3, "http://a/\n\tü", None), (4, "", ""), (5, "u", "short"), (6, "u", "short"),
    (7, "big", "x" * 3_000_000), (8, "u", "a" * 99), (9, "u", "a" * 99), (10, "u", "a" * 100), (11, "u", "a" * 100),
    (None, "no id", LONG), (12, "twice", "t" * 200), (12, "twice", "t" * 200), (13, "u", "t" * 200), (14, "crlf", "a\r\n\r\nb" * 50),
    (None, "q", "only without id" * 20), (None, "q", "only without id" * 20),
]


def expected(rows):
    out = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if p is not None and (h or "") == (html or "")]
        revisit = len(raw) >= 100 and bool(same) and page_id != min(same)
        out.append(
            (page_id, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", min(same) if revisit else None)
        )
    return sorted(out, key=str)


def columns(frame):
    return sorted(
        map(tuple, frame.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str
    )


def test_round_trip_of_edge_cases(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    records = warc.archived(pages.withColumn("digest", F.lit(1)).withColumn("payload", F.lit("clash"))).cache()
    assert columns(records) == expected(ROWS)
    payloads = sorted((r["page_id"] or 0, bytes(r["payload"])) for r in records.collect() if r["payload"] is not None)
    wanted = [(p or 0, (h or "").encode()) for p, _, h in ROWS]
    kept = [(r[0] or 0, r[3]) for r in expected(ROWS)]
    assert len(payloads) == sum(kind == "response" for _, kind in kept)
    assert all(p in wanted for p in payloads)
    urls = {r["page_id"]: r["url"] for r in records.collect()}
    assert urls[1] == "http://a/x%20y" and urls[2] == "urn:page:2" and urls[3] == "http://a/%0A%09%C3%BC"


def test_empty_table(spark):
    assert warc.archived(spark.createDataFrame([], SCHEMA)).count() == 0


def test_files_start_with_a_dictionary_and_hold_a_frame_a_record(spark):
    rows = [(i, f"http://h/{i}", f"<html><head><title>page {i}</title></head>" + f"<p>common words {i % 7}</p>" * 150) for i in range(400)]
    folder = scratch_path(spark, "test-warc")
    manifest = warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(2), folder).collect()
    assert sum(r["records"] for r in manifest) == 400
    system, root = file_system(folder)
    sizes = 0
    for r in manifest:
        raw = system.open_input_file(f"{root}/{r['file']}").read()
        assert int.from_bytes(raw[:4], "little") == warc.SKIPPABLE_MAGIC
        length = int.from_bytes(raw[4:8], "little")
        dictionary = zstandard.decompress(raw[8 : 8 + length])
        assert len(dictionary) > 1000
        shared = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        frames, at = 0, 8 + length
        while at < len(raw):
            one = shared.decompressobj()
            assert one.decompress(raw[at:]).startswith(b"WARC/1.1\r\n")
            at, frames = len(raw) - len(one.unused_data), frames + 1
        assert frames == r["records"]
        sizes += len(raw)
    assert sizes < sum(len(h) for _, _, h in rows) / 10


def test_a_cut_file_is_refused():
    frame = zstandard.compress(b"WARC/1.1\r\n" * 50)
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(warc.dictionary_frame(b"") + frame[:-4])))


def test_small_tables_carry_a_dictionary(spark):
    """The archives of the smallest given table, which once had none."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    records = [(r["html"] or "").encode() for r in pages.select("html").collect()]
    dictionary = warc.train_dictionary(records)
    assert warc.LEAST_DICTIONARY <= len(dictionary) <= sum(map(len, records)) // 8
    shared = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    plain = zstandard.ZstdCompressor()
    assert sum(len(shared.compress(r)) for r in records) < sum(len(plain.compress(r)) for r in records)
    assert warc.train_dictionary([]) == b"" and isinstance(warc.train_dictionary([b"a"] * 3), bytes)
