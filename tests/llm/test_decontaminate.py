import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadcast.llm import decontaminate
from roadcast.llm.decontaminate import Phrases, scan_batch, without_spans
from roadcast.llm.fm_index import FmIndex, suffix_order


def plain(texts, items, window):
    def words(text):
        out, word = [], ""
        for c in (text or "") + " ":
            c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
            if c.isdecimal() and c < "\x80" or "a" <= c <= "z" or c >= "\x80":
                word += c
            else:
                out += [word] if word else []
                word = ""
        return out

    result = []
    for text in texts:
        own, hit, found = words(text), set(), set()
        for item, phrase in items:
            theirs = words(phrase)
            m = min(window, len(theirs))
            for a in range(len(theirs) - m + 1 if m else 0):
                for b in range(len(own) - m + 1):
                    if own[b : b + m] == theirs[a : a + m]:
                        hit |= set(range(b, b + m))
                        found.add(item)
        result.append((len(own), len(hit), sorted(found)))
    return result


TEXT = st.lists(st.sampled_from("a b c A, é. x1 -- zz".split()), max_size=14).map(" ".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=5), st.lists(st.none() | TEXT, max_size=4), st.integers(1, 4))
def test_any_texts(texts, phrases, window):
    items = [(str(i), p) for i, p in enumerate(phrases)]
    got = scan_batch(texts, [Phrases.of_items(items, window)])
    expected = plain(texts, items, window)
    assert list(zip(got["n_words"], got["n_hit"], got["item_ids"], strict=True)) == expected
    halves = [Phrases.of_items(items[:2], window), Phrases.of_items(items[2:], window)]
    assert scan_batch(texts, halves) == got
    for text, spans, (_, n_hit, _) in zip(texts, got["spans"], expected, strict=True):
        marked = " ".join(text[s["start"] : s["stop"]] for s in spans) if spans else ""
        assert len(decontaminate.words_of(marked)) == n_hit


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=60), st.lists(st.integers(1, 6), min_size=1, max_size=3))
def test_index_finds_all_places(text, pattern):
    text = np.array([*text, 0], np.int64)
    index = FmIndex(text)
    low, high = index.search(np.array([pattern]))
    places = sorted(index.locate(np.arange(low[0], high[0])).tolist())
    n = len(pattern)
    assert places == [i for i in range(len(text) - n + 1) if text[i : i + n].tolist() == pattern]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=50))
def test_suffix_order(symbols):
    got = suffix_order(np.array(symbols, np.int64)).tolist()
    assert got == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_scan_passes_columns_through(spark):
    docs = spark.createDataFrame(
        [(1, "One two THREE four.", "x", 1.5), (None, None, None, None), (1, "one", "y", None), (4, "", "z", 0.0)],
        "doc_id long, text string, n_hit string, item_id double",
    )
    bench = spark.createDataFrame([(7, "two three"), (None, "one"), (8, None), (9, "!")], "item_id int, text string")
    rows = decontaminate.scan(docs, bench.withColumn("doc_id", F.lit(1)), window=2).collect()
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_hit"], r["item_ids"], r["item_id"]) for r in rows)
    assert got == [(0, 0, 0, [], None), (1, 1, 1, ["null"], None), (1, 4, 3, ["7", "null"], 1.5), (4, 0, 0, [], 0.0)]
    found = decontaminate.scan(docs, bench, window=2).select(without_spans(F.col("text"), F.col("spans")).alias("left"))
    assert sorted(str(r["left"]) for r in found.collect()) == ["", " ", "  four.", "None"]
    assert decontaminate.scan(docs.limit(0), bench).count() == 0
    assert {r["n_hit"] for r in decontaminate.scan(docs, bench.limit(0)).collect()} == {0}


def test_long_document(spark):
    phrase = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, "filler w1 w2 " * 200_000 + phrase)], "doc_id long, text string")
    row = decontaminate.scan(docs, spark.createDataFrame([(1, phrase)], "item_id int, text string")).first()
    assert row["n_hit"] == 30 and row["n_words"] == 600_030
