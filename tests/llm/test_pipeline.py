"""Each stage against a plain version of its decision, on its own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_decontaminate import plain as plain_overlap
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_substring_dedup import plain as plain_repeats
from tests.llm.test_tokens import check_packing

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """Each stage's input, and the result."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frames[-1], SF_DIR).write.parquet(str(folder / name))
        frames.append(spark.read.parquet(str(folder / name)))
    return [[r.asDict() for r in f.collect()] for f in frames]


def texts(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def test_columns_and_order(inputs):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language", "near_duplicates", "repeated_substrings", "benchmark_overlap", "packing",
    ]
    assert all(list(r) == COLUMNS for frame in inputs[:-1] for r in frame)
    assert all(r["n_chars"] == len(r["text"]) for frame in inputs[1:-1] for r in frame)


def test_language_stage_keeps_clean_documents(inputs):
    before, after = texts(inputs[0]), texts(inputs[1])
    assert all(before[i] == t for i, t in after.items()) and len(after) > 0.97 * len(before)


def test_texts_in_four_languages_stay(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter("length(text) BETWEEN 400 AND 4000").collect()
    by_lang = {}
    for r in docs:
        by_lang.setdefault(r["lang"], []).append(r["text"])
    langs = [k for k in by_lang if k]
    mixed = [(10_000 + i, " ".join(by_lang[k][i % len(by_lang[k])][:400] for k in langs), None, "s", 0) for i in range(20)]
    table = spark.createDataFrame([tuple(r) for r in docs] + mixed, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in corpus_pipeline.keep_languages(spark, table, SF_DIR).collect()}
    assert {i for i, *_ in mixed} <= kept


def test_without_labels_all_texts_stay(spark):
    rows = [(i, f"some text {i}", None, "s", 0) for i in range(3)] + [(7, "12 34", None, "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.keep_languages(spark, docs, SF_DIR).count() == 4


def test_one_of_each_group_stays(inputs):
    """The groups by brute force over all pairs of fingerprints."""
    before, after = texts(inputs[1]), texts(inputs[2])
    label = plain_components({i: plain_fingerprint(t) for i, t in before.items()}, corpus_pipeline.MOST_BITS)
    assert after == {i: before[i] for i in set(label.values())}


def test_rows_that_share_an_id_and_not_the_text_stay(spark):
    rows = [(5, "one text about cats", "en"), (5, "another text about the sea", "en"), (5, "one text about cats", "en"),
            (5, "one text about cats", None), (2, "something else again", "en"), (None, "no id here", "en"), (None, "no id here", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR).collect()]
    assert sorted(kept, key=str) == sorted({(i, t) for i, t, _ in rows}, key=str)


def test_repeats_are_cut(inputs):
    before, after = texts(inputs[2]), texts(inputs[3])
    plain = {r[0]: r for r in plain_repeats(list(before.items()))}
    for i, text in before.items():
        if plain[i][2] == 0:
            assert after[i] == text
        elif i in after:
            # a character goes with any of its bytes, so up to three bytes more an edge
            assert 0 <= plain[i][1] - plain[i][2] - len(after[i].encode()) <= 6 * plain[i][3]


def test_benchmark_spans_are_cut(inputs, spark):
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    before, after = texts(inputs[3]), texts(inputs[4])
    found = dict(zip(before, plain_overlap(list(before.values()), items, 10), strict=True))
    for i, text in before.items():
        if found[i][1] == 0:
            assert after[i] == text
        elif i in after:
            assert plain_overlap([after[i]], [], 10)[0][0] == found[i][0] - found[i][1]


def test_rest_is_packed(inputs):
    check_packing(inputs[5], texts(inputs[4]))


def awkward(spark):
    rows = [(1, None, None, "s", None), (None, "no id no words", "en", None, 3), (None, "no id no words", "en", None, 3), (3, "", "en", "s", 0),
            (4, "a few words", "en", "s", 11), (4, "a few words", "en", "s", 11), (5, "ein paar wörter " * 50_000, "de", "s", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")


@pytest.mark.parametrize("number", range(5))
def test_awkward_and_empty_tables(spark, number):
    stage = corpus_pipeline.STAGES[number][1]
    docs = awkward(spark)
    for name in ("rest", "kept", "spans", "fp", "content", "nth", "lang_pred", "n_hit", "pack", "node"):
        docs = docs.withColumn(name, F.lit("clash"))
    for frame in (docs, docs.limit(0)):
        result = stage(spark, frame, SF_DIR)
        rows = result.collect()
        assert bool(rows) == (frame is docs)
        if number < 4:
            assert result.columns == docs.columns and all(r[n] == "clash" for r in rows for n in docs.columns[5:])
    if number == 1:
        assert sorted(r["doc_id"] or 0 for r in stage(spark, docs, SF_DIR).collect()) == [0, 1, 4, 5]
