import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roadcast.llm import packing, token_files
from roadcast.llm.common import scratch_path
from roadcast.llm.queries import QUERIES
from roadcast.llm.tokens import WordEncoder

SF_DIR = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = {path: Tokenizer.from_file(path) for path in (WORDS, BYTES)}
AWKWARD = [
    None, "", " ", "\n\n", "a", " a", "a ", "it's we'll 'tis O'Neil's", "a,b. c!?d", "x  y\n z\t\tw \n", "1,000.50 ½ ²",
    "a  b", "a  b", "é ́x", "<|endoftext|>", "a<|endoftext|> b", "x <|startoftext|>y,", "日本語 テキスト。",
    "İ ß ﬁ", "\x1c a\x85b \x0b\x0c c", "naïve,éé.Ça", "a." * 50, "emoji 👩‍👩‍👧 !", "\r\n x",
]


def plain(path, text, end_id):
    return WHOLE[path].encode(text or "", add_special_tokens=False).ids + [end_id]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_words_encode_like_whole_texts(path):
    ids, bounds = WordEncoder(path).encode(AWKWARD, 2)
    for i, text in enumerate(AWKWARD):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == plain(path, text, 2), repr(text)


@pytest.mark.parametrize("path", [WORDS, BYTES])
@settings(max_examples=400, deadline=None)
@given(text=st.text(st.sampled_from("aéßÄ zZ \n\t.,;:'!?s0½_-|<> ́ \x1c\x85日İ"), max_size=40))
def test_any_text_encodes_alike(path, text):
    ids, _ = WordEncoder.of(path).encode([text], 0)
    assert ids.tolist() == plain(path, text, 0)


def texts_of(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def test_token_query_equals_plain_encoding(spark):
    start, expected = 0, []
    for doc_id, text in sorted(texts_of(spark).items()):
        ids = np.array(plain(WORDS, text, 2), "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = QUERIES["op8_token_files"](spark, SF_DIR)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == expected


def test_shards_give_any_document(spark):
    rows = list(enumerate(AWKWARD)) + [(None, "no id"), (3, "a"), (5000, "lang " * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash")).repartition(3)
    folder = scratch_path(spark, "test-token-files")
    manifest = token_files.write_token_files(docs, folder, WORDS, 2)
    found = []
    for r in manifest.collect():
        shard = token_files.open_shard(folder, f"shard-{r['shard']:05d}.tids")
        for i in reversed(range(shard.documents)):
            found.append((None if shard.nulls[i] else int(shard.doc_ids[i]), shard[i].tolist()))
    order = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(found, key=order) == sorted(((i, plain(WORDS, t, 2)) for i, t in rows), key=order)


def test_shard_refuses_another_dictionary(spark):
    folder = scratch_path(spark, "test-token-files")
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    shard = token_files.write_token_files(docs, folder, WORDS, 2).filter("documents > 0").first()["shard"]
    token_files.write_whole(f"{folder}/dictionary", iter([b"other"]))
    with pytest.raises(ValueError):
        token_files.open_shard(folder, f"shard-{shard:05d}.tids")


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.token_table(empty, WORDS, 2).count() == 0
    assert packing.packed_documents(empty, BYTES, 0).count() == 0


# --- packing ---------------------------------------------------------------------------


def check_packing(result, texts, capacity=2048):
    """Every piece once and right, bins gapless and within capacity. Returns the number of bins."""
    pieces, bins = {}, {}
    for r in result:
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for doc_id, text in texts.items():
        ids = np.array(plain(BYTES, text, 0), "<u4")
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        expected = [
            (i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
        ]
        assert sorted(pieces[doc_id]) == expected
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_query(spark):
    result = QUERIES["op9_packed_sequences"](spark, SF_DIR).collect()
    bins = check_packing(result, texts_of(spark))
    total = sum(r["length"] for r in result)
    assert bins <= -(-total // 2048) + 1


def test_packing_edge_cases(spark):
    texts = dict(enumerate(AWKWARD)) | {900: "word " * 100_000, None: "no id"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    clashing = docs.withColumn("rank", F.lit(1)).withColumn("length", F.lit(None).cast("int"))
    check_packing(packing.packed_documents(clashing, BYTES, 0).collect(), texts)
    doubled = packing.packed_documents(docs.union(docs), BYTES, 0, keep_ids=True).collect()
    assert len(doubled) == 2 * len(packing.packed_documents(docs, BYTES, 0).collect())
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in doubled)


def best_sum(items, room):
    sums = {0}
    for item in items:
        sums |= {s + item for s in sums if s + item <= room}
    return max(sums)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=12), st.integers(0, 90))
def test_fullest_is_optimal(items, room):
    counts = {n: items.count(n) for n in set(items)}
    chosen = packing.fullest(dict(counts), room)
    assert all(counts[n] >= k for n, k in chosen.items())
    assert sum(n * k for n, k in chosen.items()) == best_sum(items, room)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_plan_holds_every_piece(items):
    plan = packing.plan_bins({n: items.count(n) for n in set(items)}, 50)
    placed = [n for pattern, times in plan for n, k in pattern.items() for _ in range(k * times)]
    assert sorted(placed) == sorted(items)
    assert all(sum(n * k for n, k in pattern.items()) <= 50 for pattern, _ in plan)


# --- dictionaries ----------------------------------------------------------------------


def test_small_tables_carry_a_dictionary(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter("length(text) < 1500").select("doc_id", F.substring("text", 1, 300).alias("text"))
    dictionary = token_files.train_dictionary(token_files.dictionary_sample(docs), WORDS, 2)
    assert token_files.LEAST_DICTIONARY <= len(dictionary) < token_files.DICTIONARY_BYTES
    assert token_files.train_dictionary([], WORDS, 2) == b""


def test_repeated_ids_are_ordered_by_their_text(spark):
    rows = [(7, f"text {i}") for i in range(40)] + [(None, "b"), (None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    both = [token_files.token_table(docs.repartition(n), WORDS, 2).select("doc_id", "start", "ids_crc32") for n in (1, 5)]
    order = lambda r: (r[0] is not None, r[1])
    assert sorted(map(tuple, both[0].collect()), key=order) == sorted(map(tuple, both[1].collect()), key=order)
