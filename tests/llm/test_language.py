import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadcast.llm import language
from roadcast.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("lengths", [[1], [4, 1, 3], [2, 5]])
def test_marginals_equal_enumeration(lengths, monkeypatch):
    monkeypatch.setattr(language, "CHUNK", 3)
    rng = np.random.default_rng(sum(lengths))
    labels, total = 3, sum(lengths)
    scores, transition, initial = rng.normal(size=(total, labels)), rng.normal(size=(labels, labels)), rng.normal(size=labels)
    starts = np.zeros(total, bool)
    starts[np.cumsum([0, *lengths[:-1]])] = True
    moves = np.zeros((labels, labels))
    got = language.marginals(scores, starts, transition, initial, moves)
    expected, steps, at = np.zeros((total, labels)), np.zeros((labels, labels)), 0
    for n in lengths:
        weights, paths = [], list(itertools.product(range(labels), repeat=n))
        for path in paths:
            w = initial[path[0]] + sum(scores[at + i, k] for i, k in enumerate(path))
            weights.append(np.exp(w + sum(transition[a, b] for a, b in zip(path[:-1], path[1:], strict=True))))
        for path, w in zip(paths, np.array(weights) / sum(weights), strict=True):
            for i, k in enumerate(path):
                expected[at + i, k] += w
            for a, b in zip(path[:-1], path[1:], strict=True):
                steps[a, b] += w
        at += n
    assert np.allclose(got, expected)
    # the padding behind the last word makes sequences of one word, which have no steps
    assert np.allclose(moves, steps)


def test_features_do_not_depend_on_neighbours():
    words = ["straße", "el", "x", "élan"]
    together, bounds = language.feature_ids(words)
    for i, word in enumerate(words):
        alone, _ = language.feature_ids([word])
        assert sorted(together[bounds[i] : bounds[i + 1]]) == sorted(alone)


def test_held_out_accuracy(spark):
    rows = QUERIES["op3_language_labels"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    found = rows.join(truth, "doc_id").collect()
    assert len(found) == truth.count()
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r for r in found if r["held_out"] and r["lang"]]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.98


@pytest.fixture(scope="module")
def model():
    texts = ["the cat and the dog were here with them", "le chat et le chien sont dans la maison"] * 20
    return language.train(texts, ["en", "fr"] * 20)


def test_switched_text_is_labelled_by_word(model):
    found = language.predict_batch(["the cat and the dog le chat et le chien sont"], model, language.WordScores(model))
    _, scores, sure, words, shares = found
    assert words == [11] and 0.35 < shares[0]["en"] < 0.55 and scores[0] == max(shares[0].values()) and sure[0] > 0.9


def test_a_language_of_long_texts_only_is_learned(spark):
    rows = [(i, "the cat and the dog were here " * 5, "en") for i in range(30)] + [(100 + i, "le chat et le chien " * 5000, "fr") for i in range(4)]
    model = language.fitted(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert language.predict_batch(["le chat et le chien"], model, language.WordScores(model))[0] == ["fr"]


def test_words_are_forgotten_in_time(model, monkeypatch):
    monkeypatch.setattr(language, "MEMO_WORDS", 3)
    table = language.WordScores(model)
    lists = [["the", "cat"], ["le", "chat", "the"], ["dog"]]
    assert all(np.allclose(table.of([own]), model.scores(own), atol=1e-4) for own in lists)


def test_edge_texts(spark, model):
    texts = [None, "", " 12 ... ²½ _", "The Dog", "le chat " * 200_000, "x", "the dog", "日本"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("lang_pred", F.lit("clash"))
    docs = docs.withColumn("lang", F.lit(None).cast("string"))
    rows = {r["doc_id"]: r for r in language.languages(docs, model).collect()}
    assert [rows[i]["lang_pred"] for i in range(3)] == ["und"] * 3 and [rows[i]["lang_score"] for i in range(3)] == [0] * 3
    assert rows[3]["lang_pred"] == "en" and rows[4]["lang_pred"] == "fr" and rows[4]["lang_words"] == 400_000
    assert rows[3]["lang_score"] == rows[6]["lang_score"] and rows[7]["lang_pred"] in ("en", "fr")
    assert language.languages(docs.limit(0), model).count() == 0


def test_nothing_labelled(spark):
    docs = spark.createDataFrame([(1, "text", None), (2, None, "en"), (None, "", "fr")], "doc_id long, text string, lang string")
    model = language.fitted(docs)
    assert model is None
    assert {(r["lang_pred"], r["lang_score"]) for r in language.languages(docs, model).collect()} == {("und", 0.0)}
