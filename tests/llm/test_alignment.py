import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.decoders import ByteLevel

from roadcast.llm import alignment
from roadcast.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(PATHS[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
AWKWARD = [
    "", " ", "a", "  a  b ", "\n\tx\n\n", "naïve café", "日本語 テキスト。", "<|endoftext|> </s> <s> <0x41>", "a▁b", "▁", "é ﬁ",
    "emoji 👩‍👩‍👧 !", "x\x00y", "1,000.50 ½", "word " * 50, "z" * 300, "\xa0\x85",
]


def entry_bytes(i):
    return bytes(alignment.CHAR_TO_BYTE[ord(c)] for c in A.id_to_token(i))


def piece_bytes(i):
    return bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode()


def plain(texts):
    """Every byte names the token of A and of B that it lies in."""
    rows, counts = [], Counter()
    for doc_id, text in texts:
        a = A.encode(" " + text, add_special_tokens=False).ids if text else []
        b = B.encode(text) if text else []
        of_a, of_b = [entry_bytes(i) for i in a], [piece_bytes(i) for i in b]
        if not text or not b"".join(of_a) == b" " + text.encode() == b"".join(of_b):
            rows.append((doc_id, [], [], [], []))
            continue
        owner_a = [i for i, x in enumerate(of_a) for _ in x]
        owner_b = [i for i, x in enumerate(of_b) for _ in x]
        links = sorted(set(zip(owner_a, owner_b, strict=True)))
        groups = [[[], []]]
        for at, (i, k) in enumerate(zip(owner_a, owner_b, strict=True)):
            if at and owner_a[at - 1] != i and owner_b[at - 1] != k:
                groups.append([[], []])
            for side, number, owner in ((0, i, owner_a), (1, k, owner_b)):
                if not at or owner[at - 1] != number:
                    groups[-1][side].append((a, b)[side][number])
        links = [(a[i], b[k]) for i, k in links]
        counts.update(links)
        rows.append((doc_id, a, b, groups, links))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    result = []
    for doc_id, a, b, groups, links in rows:
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(counts[p] == most[p[1]] for p in links)
        digest = hashlib.sha256(shown.encode()).hexdigest() if a else ""
        result.append((doc_id, len(a), len(b), len(groups), len(links), best, sum(counts[p] for p in links), digest))
    return result


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def test_query_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = QUERIES["op11_aligned_tokens"](spark, SF_DIR)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert got.columns == names and {t for _, t in got.dtypes} == {"bigint", "string"}
    expected = plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert by_id(map(tuple, got.collect())) == by_id(expected)
    assert sum(r[4] for r in expected) > 10_000


def test_blocks_of_few_bytes_give_the_same(spark, monkeypatch):
    """Nulls, texts without tokens, repeated rows and ids, clashing names, and a text longer than a block."""
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 300)
    rows = [*enumerate(AWKWARD), (None, "no id"), (3, "a"), (3, "a"), (7, None), (50, "the cat sat " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("pairs", F.lit("clash")).repartition(3)
    got = alignment.aligned(docs.withColumn("block", F.lit(1)), *PATHS)
    assert by_id(map(tuple, got.collect())) == by_id(plain(rows))


def test_texts_that_do_not_come_back_have_no_tokens():
    assert [r[1] > 0 for r in plain([(0, "a▁b"), (1, "x")])] == [False, True]


def test_empty_table(spark):
    assert alignment.aligned(spark.createDataFrame([], "doc_id long, text string"), *PATHS).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=30), st.lists(st.integers(1, 5), min_size=1, max_size=30))
def test_cuts_and_links_of_any_lengths(a, b):
    a, b = (a + [sum(b) - sum(a)], b) if sum(a) < sum(b) else (a, b + [sum(a) - sum(b)]) if sum(b) < sum(a) else (a, b)
    ends_a, ends_b = np.cumsum(a), np.cumsum(b)
    cuts_a, cuts_b = alignment.common_cuts(ends_a, ends_b)
    both = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
    assert [ends_a[i - 1] for i in cuts_a[1:]] == both == [ends_b[i - 1] for i in cuts_b[1:]]
    spans = lambda ends: list(zip([0, *ends[:-1]], ends, strict=True))
    expected = [
        (i, k) for i, (s, e) in enumerate(spans(ends_a)) for k, (t, f) in enumerate(spans(ends_b)) if max(s, t) < min(e, f)
    ]
    assert list(zip(*(x.tolist() for x in alignment.links_of(ends_a, ends_b)), strict=True)) == expected


def test_byte_entries():
    pair = alignment.pair_of(*PATHS)
    decoder = ByteLevel()
    assert all(pair.bytes_a[i].decode("utf-8", "replace") == decoder.decode([A.id_to_token(i)]) for i in range(0, 50_256, 97))
    assert pair.bytes_b[B.piece_to_id("<0x41>")] == b"A" and len(pair.bytes_b) == 32_000
