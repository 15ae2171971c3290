"""Toxicity by a logistic model that is regularised against counterfactual texts.

Every labelled text has a counterfactual. One that mentions a group is copied with all names
swapped for others of their kind; into any other a mention is put, of one group in the text and of another
in its copy, all pairs of names of a kind taking turns. Beside the likelihood of the labels, training
penalises the squared difference of the two scores, so that a name alone does not make a
neutral sentence toxic. Names are a parameter; by default they are in four languages.

Features are the distinct words of the whole text, chosen on a sample of about
``SAMPLE_ROWS`` labelled documents; identity terms are always among them.

Defined cases: a null or empty text has no words and gets the score of the intercept; with
no labelled row every score is 0; if all labels agree the score is that rate, smoothed;
repeated rows are scored each; an empty table gives an empty result. Columns other than
the id and the text never reach a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadcast.llm import hashed
from roadcast.llm.common import regrouped, spread

SAMPLE_ROWS = 20_000
ROUNDS, RATE, RIDGE, FAIRNESS, LEAST_Z = 400, 0.5, 1e-4, 1.0, 4.0
# Names of groups by kind, in English, German, French and Spanish. A counterfactual exchanges them within a kind.
IDENTITY_GROUPS = (
    ("women", "men"),
    ("woman", "man"),
    ("girl", "boy"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab"),
    ("immigrant", "native"),
    ("disabled", "abled"),
    ("french", "german", "spanish", "english"),
    ("frauen", "männer"),
    ("schwule", "lesben", "heterosexuelle"),
    ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"),
    ("ausländer", "einheimische", "flüchtlinge"),
    ("femmes", "hommes"),
    ("homosexuels", "lesbiennes", "hétérosexuels"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("immigrés", "étrangers", "réfugiés"),
    ("mujeres", "hombres"),
    ("homosexuales", "lesbianas", "heterosexuales"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("inmigrantes", "extranjeros", "refugiados"),
)


class Swap:
    """Exchanges every identity term for the next of its group; the pattern keeps the case of the first letter."""

    def __init__(self, groups: tuple[tuple[str, ...], ...]):
        self.after = {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}
        self.pattern = re.compile(rf"\b({'|'.join(map(re.escape, self.after))})\b", re.IGNORECASE) if self.after else None

    def __call__(self, text: str) -> str | None:
        """The counterfactual, or None for a text without terms."""
        if not self.pattern or not self.pattern.search(text):
            return None

        def other(match: re.Match) -> str:
            new = self.after[match[0].lower()]
            return new.capitalize() if match[0][0].isupper() else new

        return self.pattern.sub(other, text)


def counterfactuals(rows: list[tuple], groups: tuple[tuple[str, ...], ...]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Features of all texts and of their counterfactuals, without what a mention put in leaves equal on both sides.

    Texts with a mention of their own come first.
    """
    left = [own for own, _, twin in rows if twin is not None]
    right = [twin for _, _, twin in rows if twin is not None]
    pairs = [[np.array([hashed.hash_of(t)]) for t in (g[i], g[(i + 1) % len(g)])] for g in groups for i in range(len(g))]
    for nth in range((len(rows) - len(left)) if pairs else 0):
        one, other = pairs[nth % len(pairs)]
        left.append(one)
        right.append(other)
    return left, right


def fit(rows: list[tuple], groups: tuple[tuple[str, ...], ...]) -> tuple[np.ndarray, np.ndarray, float]:
    """``(chosen features, weights, intercept)`` from ``(features, label, twin's features)`` rows."""
    empty = np.empty(0, np.int64), np.empty(0), -np.inf
    if not rows:
        return empty
    labels = np.array([1.0 if label > 0 else 0.0 for _, label, _ in rows])
    rate = (labels.sum() + 0.5) / (len(labels) + 1)
    always = tuple(hashed.hash_of(t) for g in groups for t in g)
    chosen = hashed.chosen_features([(f, y) for (f, _, _), y in zip(rows, labels, strict=True)], LEAST_Z, always)
    row, column = hashed.design([f for f, _, _ in rows], chosen)
    texts, twins = counterfactuals(rows, groups)
    left, right = hashed.design(texts, chosen), hashed.design(twins, chosen)
    own = sum(t is not None for _, _, t in rows)
    # both kinds of counterfactuals count by their mean, so that mentions put in do not thin out the others
    share = np.repeat([1 / max(1, own), 1 / max(1, len(twins) - own)], [own, len(twins) - own])
    weights, bias = np.zeros(len(chosen)), float(np.log(rate / (1 - rate)))
    step, bias_step = np.full(len(chosen), 1e-8), 1e-8
    for _ in range(ROUNDS):
        score = bias + np.bincount(row, weights[column], len(labels))
        error = (1 / (1 + np.exp(-score)) - labels) / len(labels)
        gradient = np.bincount(column, error[row], len(chosen)) + RIDGE * weights
        if twins:
            change = np.bincount(left[0], weights[left[1]], len(twins)) - np.bincount(right[0], weights[right[1]], len(twins))
            pull = 2 * FAIRNESS * change * share
            gradient += np.bincount(left[1], pull[left[0]], len(chosen)) - np.bincount(right[1], pull[right[0]], len(chosen))
        step += gradient * gradient
        bias_step += error.sum() ** 2
        weights -= RATE * gradient / np.sqrt(step)
        bias -= RATE * error.sum() / np.sqrt(bias_step)
    return chosen, weights, bias


def fitted(docs: DataFrame, labels: DataFrame, groups=IDENTITY_GROUPS, most_rows: int = SAMPLE_ROWS) -> tuple:
    """A model from ``docs`` (``doc_id``, ``text``) and ``labels`` (``doc_id``, ``label`` 0 or 1)."""
    sample = hashed.labelled_sample(docs, labels, most_rows)
    return fit(hashed.sampled_features(sample, False, Swap(groups)), groups)


def scored(docs: DataFrame, model: tuple, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, score`` of every row."""
    rows = spread(docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")), "doc_id")
    parts = docs.sparkSession.sparkContext.broadcast(model)  # hashed.MOST_FEATURES weights and the identity terms'
    kind = rows.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, (chosen, weights, bias) = hashed.Tokens(False), parts.value
        for batch in regrouped(batches, "text"):
            total = bias + hashed.linear_scores(batch.column("text").to_pylist(), chosen, weights, tokens)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(1 / (1 + np.exp(-total)))], names=["doc_id", "score"]
            )

    return rows.mapInArrow(of, f"doc_id {kind}, score double")
