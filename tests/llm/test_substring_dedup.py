import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadcast.llm import substring_dedup as sd
from roadcast.llm.suffix_array import permuted_common_prefixes, suffix_array


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=80))
def test_suffix_array(symbols):
    s = [*symbols, 0]
    assert suffix_array(np.array(s)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


@pytest.mark.parametrize("unit", [b"a" * 300, b"ab" * 200, b"abcabd" * 60, bytes(range(255)) * 2, b"\xff" * 99 + b"\0" * 99])
def test_suffix_array_and_prefixes_of_repetitive_text(unit):
    raw = np.frombuffer(unit, np.uint8)
    sa = suffix_array(np.append(raw.astype(int) + 1, 0))[1:]
    assert sa.tolist() == sorted(range(len(unit)), key=lambda i: unit[i:])
    common = permuted_common_prefixes(raw, sa)
    for before, i in zip(sa[:-1].tolist(), sa[1:].tolist(), strict=True):
        room = min(56, len(unit) - max(i, before))
        same = next((k for k in range(room) if unit[i + k] != unit[before + k]), room)
        assert min(common[i], room) == same


def plain(rows, length=50):
    """Spans and kept bytes by comparing sets of windows."""
    raws = [(i, (t or "").encode()) for i, t in rows]
    least = {}
    for doc_id, raw in raws:
        if doc_id is not None:
            for at in range(len(raw) - length + 1):
                window = raw[at : at + length]
                least[window] = min(least.get(window, doc_id), doc_id)
    out = []
    for doc_id, raw in raws:
        gone = [False] * len(raw)
        for at in range(len(raw) - length + 1 if doc_id is not None else 0):
            if least[raw[at : at + length]] < doc_id:
                gone[at : at + length] = [True] * length
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(frame):
    return sorted(
        ((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in frame.collect()), key=str
    )


def made_texts(seed, n):
    rng = random.Random(seed)
    words = ["alpha", "béta", "gam", "δelta", "e", "zeta zeta", "%%%", "\n", "日本"]
    passages = [" ".join(rng.choices(words, k=30)) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [" ".join(rng.choices(words, k=rng.randrange(40)))]
        for _ in range(rng.randrange(4)):
            passage = rng.choice(passages)
            a = rng.randrange(len(passage))
            parts += [passage[a:], rng.choice(words)]
        rows.append((rng.choice([i, i, i, None, 5]), rng.choice(["".join(parts), "".join(parts), passages[0], None, "", "a" * 400])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(sd, "PACK_BYTES", 3000)
    monkeypatch.setattr(sd, "SHARD_BYTES", 4000)
    rows = made_texts(seed, 120)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("pack", F.lit("clash")).withColumn("kept", F.lit(1))
    assert result(sd.deduplicated(docs.repartition(3))) == plain(rows)


def test_long_and_repetitive_documents(spark):
    rng = random.Random(3)
    long = "".join(rng.choices("abcdefgh ", k=1_200_000))
    rows = [(1, long), (2, "x" + long[500_000:] + "y"), (3, "ab" * 30_000), (4, "c" + "ab" * 100), (5, long[:49]), (6, long[:50])]
    got = {r[0]: r[1:4] for r in result(sd.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert got[1] == (1_200_000, 0, 0) and got[2] == (700_002, 700_000, 1) and got[3] == (60_000, 0, 0)
    assert got[4] == (201, 200, 1) and got[5] == (49, 0, 0) and got[6] == (50, 50, 1)


def test_empty_table(spark):
    assert sd.deduplicated(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_kept_text_drops_broken_characters():
    raw = "aéb日c".encode()
    assert sd.kept_text(raw, [2, 3, 4, 5]) == "abc" and sd.kept_text(raw, []) == "aéb日c"
    assert sd.kept_text("éèx".encode(), [1, 3]) == "x"  # the two halves left make no new character
