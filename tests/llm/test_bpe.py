import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roadcast.llm import bpe
from roadcast.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = {path: Tokenizer.from_file(path) for path in (WORDS, BYTES)}
CODER = {path: bpe.ForcedBoundaryBPE(path) for path in (WORDS, BYTES)}
AWKWARD = [
    "", " ", "\n\n", "a", " A", "a ", "it's WE'LL 'tis O'Neil's ''s 's's 'd!'re", "a,b. c!?d", "x  y\n z\t\tw \n", "1,000.50 ½ ²",
    "é ́x", "École", "<|endoftext|>", "a<|endoftext|≯ b", "x <|startoftext|>y,<|STARTOFTEXT|>", "日本語 テキスト。",
    "İ ß ﬁ ΑΣ Σ", "\x1c a\x85b \x0b\x0c c\xa0d", "naïve,éé.Ça×3÷2ÿÀÞ", "a." * 50, "emoji 👩‍👩‍👧 !", "\r\n x", "z" * 5000, "\x00\x7f", "'", "'l", "x'",
]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_awkward_texts_encode_and_decode_like_the_library(path):
    ids, bounds = CODER[path].encode([t.encode() for t in AWKWARD])
    for text, a, b in zip(AWKWARD, bounds[:-1], bounds[1:], strict=True):
        expected = WHOLE[path].encode(text, add_special_tokens=False).ids
        assert ids[a:b].tolist() == expected, repr(text)
        assert CODER[path].decode(ids[a:b]).decode() == WHOLE[path].decode(expected, skip_special_tokens=False), repr(text)


ANY = st.text(st.one_of(st.sampled_from("aéßÄÀ×zZqx \n\t.,;:'!?s0½_-|<>lrevdmT ́\x1c\x85日İΣ"), st.characters(codec="utf-8")), max_size=40)


@pytest.mark.parametrize("path", [WORDS, BYTES])
@settings(max_examples=400, deadline=None)
@given(texts=st.lists(ANY, max_size=4))
def test_any_texts_encode_alike(path, texts):
    ids, bounds = CODER[path].encode([t.encode() for t in texts])
    for text, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        assert ids[a:b].tolist() == WHOLE[path].encode(text, add_special_tokens=False).ids
        assert CODER[path].decode(ids[a:b]).decode() == WHOLE[path].decode(ids[a:b].tolist(), skip_special_tokens=False)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50_256), max_size=12))
def test_any_ids_decode_alike(ids):
    """Ids that cut characters apart give the same replacement characters."""
    assert CODER[BYTES].decode(np.array(ids, np.uint32)).decode() == WHOLE[BYTES].decode(ids, skip_special_tokens=False)


def test_forced_pairs_are_in_no_entry_and_do_cut():
    forced = CODER[WORDS].forced
    entries = [CODER[WORDS]._bytes(e.removesuffix("</w>")) for e in WHOLE[WORDS].get_vocab() if not e.startswith("<|")]
    assert not any(forced[a * 256 + b] for e in entries for a, b in zip(e, e[1:], strict=False))
    assert forced[ord("q") * 256 + ord("0")] and forced.sum() > 30_000
    coder = bpe.ForcedBoundaryBPE(WORDS)
    seen = []
    merged = coder._merged
    coder._merged = lambda fragments, tokenizer: (seen.extend(fragments.to_pylist()), merged(fragments, tokenizer))[1]
    coder.encode(["jqzxvbqj".encode()])
    assert len(seen) > 1 and sum(map(len, seen)) == 8


def test_words_are_forgotten_in_time(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_WORDS", 5)
    coder = bpe.ForcedBoundaryBPE(WORDS)
    for text in ("one two three four five six", "seven one", "two two eight"):
        assert coder.encode([text.encode()])[0].tolist() == WHOLE[WORDS].encode(text, add_special_tokens=False).ids
    assert len(coder.places) < 6


def expected(doc_id, text):
    ids = WHOLE[WORDS].encode(text or "", add_special_tokens=False).ids
    back = WHOLE[WORDS].decode(ids, skip_special_tokens=False)
    raw = np.array(ids, "<u4").tobytes()
    return doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))


def test_query_equals_the_library(spark):
    got = QUERIES["op12_bpe_round_trip"](spark, SF_DIR)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert by_id(map(tuple, got.collect())) == by_id(expected(r["doc_id"], r["text"]) for r in docs)


def test_nulls_long_texts_ties_and_clashes(spark):
    rows = [*enumerate(AWKWARD), (None, "no id"), (3, "a"), (3, "a"), (7, None), (5000, "Lang qx0 " * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash")).repartition(3)
    got = bpe.coded(docs, WORDS, keep=True).collect()
    assert by_id(tuple(r)[:4] for r in got) == by_id(expected(i, t) for i, t in rows)
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in got)
    kept = spark.createDataFrame(got)
    again = {(r["doc_id"], r["text"]) for r in bpe.decoded(kept, WORDS).collect()}
    assert again == {(r["doc_id"], r["decoded"]) for r in got}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.coded(empty, WORDS).count() == 0 and bpe.decoded(bpe.coded(empty, WORDS, keep=True), WORDS).count() == 0
