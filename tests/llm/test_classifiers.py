import zlib

import numpy as np
from pyspark.sql import functions as F

from roadcast.llm import hashed, quality, toxicity
from roadcast.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string"


def joined(spark, name):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = QUERIES[name](spark, SF_DIR)
    assert rows.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    found = rows.join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    return [r for r in found if r["held_out"]]


def auc(scores, truth):
    scores, truth = np.array(scores), np.array(truth, bool)
    pairs = scores[truth][:, None] - scores[~truth][None, :]
    return (pairs > 0).mean() + (pairs == 0).mean() / 2


def test_toxicity_held_out(spark):
    held = joined(spark, "op6_toxicity_scores")
    assert auc([r["score"] for r in held], [r["toxic"] for r in held]) > 0.8
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in held)


def test_quality_held_out(spark):
    held = joined(spark, "op2_quality_grades")
    assert auc([r["p_good"] for r in held], [r["quality"] for r in held]) > 0.9
    assert np.mean([r["keep"] == bool(r["quality"]) for r in held]) > 0.9
    assert all(0 <= r["p_clean"] <= r["p_good"] <= 1 and 0 <= r["expected_grade"] <= 2 for r in held)


def biased_corpus():
    """Insults make texts toxic; gay stands in many toxic texts and straight in few, without being the reason."""
    rng = np.random.default_rng(1)
    fillers = [f"word{i}" for i in range(200)]
    rows = []
    for i in range(600):
        words = list(rng.choice(fillers, 12))
        toxic = i % 3 == 0
        if toxic and rng.random() < 0.7:  # some toxic texts carry no insult, so the name looks telling
            words.append("vile")
        if rng.random() < (0.6 if toxic else 0.05):
            words.append("gay")
        elif rng.random() < 0.1:
            words.append("straight")
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_counterfactual_penalty_lowers_the_score_of_neutral_mentions(spark, monkeypatch):
    rows = biased_corpus()
    docs, labels = spark.createDataFrame([r[:2] for r in rows], SCHEMA), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, label int")
    probe = spark.createDataFrame([(1, "word1 word2 gay"), (2, "word1 word2 vile"), (3, "word1 word2 straight")], SCHEMA)

    def scores():
        found = toxicity.scored(probe, toxicity.fitted(docs, labels)).collect()
        return {r["doc_id"]: r["score"] for r in found}

    fair = scores()
    monkeypatch.setattr(toxicity, "FAIRNESS", 0.0)
    plain = scores()
    assert plain[1] > 0.5 and fair[1] < plain[1] - 0.15 and fair[2] > 0.5
    assert abs(fair[1] - fair[3]) < abs(plain[1] - plain[3])


def test_every_labelled_text_has_a_counterfactual():
    own = np.array([3, 9])
    rows = [(own, 1, None), (own, 0, np.array([9, 11])), (own, 0, None), (own, 1, None)]
    left, right = toxicity.counterfactuals(rows, (("women", "men"),))
    terms = [hashed.hash_of("women"), hashed.hash_of("men")]
    assert [x.tolist() for x in left] == [[3, 9], terms[:1], terms[1:], terms[:1]]
    assert [x.tolist() for x in right] == [[9, 11], terms[1:], terms[:1], terms[1:]]
    assert toxicity.counterfactuals(rows, ())[0][0] is own and len(toxicity.counterfactuals(rows, ())[0]) == 1


def test_neutral_mentions_do_not_make_documents_toxic(spark):
    """The model of the registered query, on clean documents with a mention of each group put in."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.fitted(docs, labels)
    clean = [r["text"] for r in docs.join(labels.filter("label = 0"), "doc_id").orderBy("doc_id").limit(60).collect()]
    terms = [t for g in toxicity.IDENTITY_GROUPS for t in g]
    made = [(i, f"{text} {terms[i % len(terms)]}") for i, text in enumerate(clean)]
    with_mention = toxicity.scored(spark.createDataFrame(made, SCHEMA), model)
    without = toxicity.scored(spark.createDataFrame(list(enumerate(clean)), SCHEMA), model)
    one, other = ({r["doc_id"]: r["score"] for r in x.collect()} for x in (with_mention, without))
    assert max(abs(one[i] - other[i]) for i in one) < 0.02


def test_swap():
    swap = toxicity.Swap((("women", "men"),))
    assert swap("Women met men; amended.") == "Men met women; amended." and swap("omen") is None
    assert toxicity.Swap(())("women") is None


TEXTS = [None, "", " ... ", "fine words here", "FINE, words!", "long words " * 100_000, "fine words here"]


def test_edge_texts_and_labels(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), SCHEMA).withColumn("score", F.lit("clash")).withColumn("label", F.lit(9))
    for labels in ([], [(0, None), (None, 1)], [(3, 1)], [(3, 1), (3, 0), (4, 0), (99, 1)]):
        frame = spark.createDataFrame(labels, "doc_id long, label int")
        scores = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, toxicity.fitted(docs, frame)).collect()}
        assert len(scores) == 7 and all(0 <= s <= 1 for s in scores.values()) and scores[0] == scores[1] and scores[3] == scores[6]
        grades = {r["doc_id"]: r for r in quality.graded(docs, quality.fitted(docs, frame)).collect()}
        assert len(grades) == 7 and (grades[0]["expected_grade"] is None) == (not labels or labels[0][1] is None)
    assert toxicity.scored(docs.limit(0), toxicity.fitted(docs, frame)).count() == 0
    assert quality.graded(docs.limit(0), quality.fitted(docs, frame)).count() == 0


def test_ordinal_thresholds_recover_grades():
    rng = np.random.default_rng(2)
    values = [np.array(sorted(rng.choice(20, 6, replace=False)), np.int64) for _ in range(1500)]
    weights = np.linspace(-2, 2, 20)
    latent = np.array([weights[v].sum() for v in values]) + rng.logistic(size=1500) * 0.5
    rows = [(v, int(np.digitize(x, [-1.5, 0.5, 2])), None) for v, x in zip(values, latent, strict=True)]
    grades, chosen, fitted, thresholds = quality.fit(rows)
    assert grades == [0, 1, 2, 3] and (np.diff(thresholds) > 0).all()
    full = np.zeros(20)
    full[chosen] = fitted
    assert np.corrcoef(full[chosen], weights[chosen])[0, 1] > 0.97


def test_features_are_whole_text_and_distinct():
    tokens = hashed.Tokens(False)
    text = "a b A b, c " * 50 + "last"
    assert hashed.features(text, tokens).tolist() == sorted(map(hashed.hash_of, ["a", "b", "c", "last"]))
    shaped = hashed.features("x! y! z!", hashed.Tokens(True))
    assert len(shaped) == 6 and len(np.unique(shaped)) == 6
