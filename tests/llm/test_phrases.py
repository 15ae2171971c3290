import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadcast.llm import phrases
from roadcast.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def expected(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for n, (doc_id, text) in enumerate(rows):
        after = rows[(n + 1) % len(rows)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        one = lambda t: phrases.fingerprints([t.encode()])
        out.append(
            (
                doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), phrases.as_hex(one(text))[0],
                phrases.as_hex(one(changed))[0], float(phrases.likeness(one(text), one(changed))[0]),
                float(phrases.likeness(one(text), one(after))[0]),
            )
        )
    return sorted(out, key=str)


def test_query_equals_one_text_at_a_time(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = QUERIES["op1_phrase_fingerprints"](spark, SF_DIR).collect()
    assert sorted(map(tuple, got), key=str) == expected([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert np.mean([r["near_edited"] > r["near_next"] for r in got if r["n_chars"] > 200]) > 0.95


ROWS = [
    (5, None), (1, ""), (9, "one"), (None, "no id"), (None, None), (7, "same text " * 30), (8, "same text " * 30), (8, "b"), (8, "a"),
    (20, "é" * 7), (30, "long äöü text " * 60_000), (31, "日本語"), (32, "x"),
]


@pytest.mark.parametrize("block_rows", [1, 3, 500])
def test_edge_rows_in_blocks_of_any_size(spark, block_rows, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_ROWS", block_rows)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("block", F.lit("clash")).withColumn("key", F.lit(1))
    assert sorted(map(tuple, phrases.neighbour_fingerprints(docs).collect()), key=str) == expected(ROWS)


def test_one_and_no_document(spark):
    one = spark.createDataFrame([(3, "abcdef")], "doc_id long, text string")
    row = phrases.neighbour_fingerprints(one).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and row["near_next"] == 1
    assert phrases.neighbour_fingerprints(one.limit(0)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 255), min_size=1, max_size=40), min_size=1, max_size=4), st.sampled_from([np.uint8, np.uint64]))
def test_labels_are_few_and_differ(texts, kind):
    texts = [[a for a, b in zip(t, [None, *t[:-1]], strict=True) if a != b] for t in texts]
    symbols = np.array([s for t in texts for s in t], kind) * kind(0x0101010101010101 & np.iinfo(kind).max)
    first = np.array([i == 0 for t in texts for i in range(len(t))])
    labels = phrases.coin_labels(symbols, first)
    assert labels.max() <= 5
    assert all(first[i] or labels[i] != labels[i - 1] for i in range(len(labels)))


def test_equal_substrings_share_interior_names():
    rng = random.Random(4)
    shared = bytes(rng.choices(b"abcdefgh ,.", k=3000))
    texts = [bytes(rng.choices(b"xyz uvw", k=n)) + shared + bytes(rng.choices(b"klm", k=m)) for n, m in ((0, 10), (1, 0), (777, 5))]
    names, text = phrases.phrase_names(texts)
    level = [set(names[text == i].tolist()) for i in range(3)]
    alone = set(phrases.phrase_names([shared])[0].tolist())
    assert all(len(alone & own) > 0.85 * len(alone) for own in level)


def test_likeness_estimates_overlap():
    rng = random.Random(5)
    a, b, c = (" ".join(str(rng.randrange(10**6)) for _ in range(3000)).encode() for _ in range(3))
    prints = phrases.fingerprints([a, a, a[: len(a) // 2] + b[len(b) // 2 :], c, b"", b""])
    near = lambda i, j: float(phrases.likeness(prints[i : i + 1], prints[j : j + 1])[0])
    assert near(0, 1) == 1 and 0.15 < near(0, 2) < 0.55 and near(0, 3) < 0.1 and near(4, 5) == 1 and near(0, 4) == 0
