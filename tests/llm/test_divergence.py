import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadcast.llm import divergence
from roadcast.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain(rows, least_docs, top):
    """``rows`` of (text, lang, source)."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(LOWER))
        groups[lang].add(source)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    result = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= least_docs)
        share = lambda count: {
            t: 1 + 10**9 * (count[t] + 5) // (sum(count[x] for x in kept) + 5 * len(kept)) for t in kept
        }
        whole = share(sum((counts[lang, s] for s in sources), Counter()))
        shares = {s: share(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(shares[s][t] - shares[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(whole[t] - shares[s][t], t.encode()) for t in kept if counts[lang, s][t] and shares[s][t] > whole[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                result += [(lang, s, part, item.decode(), -v, rank) for rank, (v, item) in enumerate(found, 1)]
    return sorted(result)


WORDS = ["the", "The", "cat", "naïve", "Ünder", "x1y", "日本", "a.b", "É", "z_z", "of", "to", "and"]


def rows_of(seed, count):
    random = np.random.default_rng(seed)
    langs, sources = [None, "en", "de", ""], [None, "s1", "s2", "s3", "é"]
    return [
        (" ".join(random.choice(WORDS, random.integers(0, 30), p=random.dirichlet([0.3] * len(WORDS)))), langs[random.integers(4)], sources[random.integers(5)])
        for _ in range(count)
    ]


def test_small_shards_and_blocks_equal_plain_version(spark, monkeypatch):
    """Nulls, empty texts, a language without kept terms, a group without terms, repeated rows, ties, clashing names."""
    for name, value in (("SHARD_ROWS", 7), ("BLOCK_SOURCES", 2), ("CHUNK_CELLS", 6), ("SKY_BLOCK", 3), ("TASK_ROWS", 10)):
        monkeypatch.setattr(divergence, name, value)
    rows = rows_of(1, 300) + [("the cat", "en", "s1")] * 4 + [(None, "en", None), ("", "fr", "s1"), ("", "fr", "s2"), ("123", "en", "s9")]
    rows += [("the of cat " * 30_000, "de", "s3")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("term", F.lit(1)).repartition(5)
    for top in (2, 50):
        got = divergence.audit(docs.withColumn("shard", F.lit("x")), least_docs=12, top=top)
        assert got.dtypes == [(c, "string") for c in ("lang", "source", "part", "item")] + [("value", "bigint"), ("rank", "int")]
        assert sorted(map(tuple, got.collect())) == plain(rows, 12, top)


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_query_has_both_parts(spark):
    rows = QUERIES["op13_source_divergence"](spark, "/root/testdata/sf0.001").collect()
    assert {r["part"] for r in rows} == {"pair", "term"}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), max_size=40), st.integers(1, 5), st.integers(1, 9))
def test_skyband_is_exact(items, k, block):
    often, seldom = (np.array([i[j] for i in items], np.int64) for j in range(2))
    place = np.random.default_rng(3).permutation(len(items))
    over = lambda a, b: often[a] >= often[b] and seldom[a] <= seldom[b] and place[a] < place[b]
    expected = [b for b in range(len(items)) if sum(over(a, b) for a in range(len(items))) < k]
    old, divergence.SKY_BLOCK = divergence.SKY_BLOCK, block
    try:
        assert sorted(divergence.skyband(often, seldom, place, k).tolist()) == expected
    finally:
        divergence.SKY_BLOCK = old


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**12), st.integers(0, 10**12), st.integers(1, 10**9))
def test_shares_are_exact(count, more, terms):
    total = count + more + 5 * terms
    assert divergence.shares(np.array([count]), total)[0] == 1 + 10**9 * (count + 5) // total
