"""Quality grades by ordinal cumulative-link regression over hashed text.

All grades share one set of weights; ordered thresholds cut the text's score into them:
``P(grade <= k) = sigmoid(threshold[k] - score)``. The model gives the expected grade and
tail probabilities ``P(grade >= k)``, by which texts are selected.

Features are distinct words and token shapes of the whole text (``hashed``), chosen on a
sample of about ``SAMPLE_ROWS`` graded documents.

Defined cases: a null or empty text has score 0; with no graded row the expected grade is
null and nothing is kept; a single grade is always expected; repeated rows are graded
each; an empty table gives an empty result. Columns other than the id and the text never
reach a grade.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadcast.llm import hashed
from roadcast.llm.common import regrouped, spread

SAMPLE_ROWS = 20_000
ROUNDS, RATE, RIDGE, LEAST_Z = 400, 0.3, 3e-4, 6.0


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit(rows: list[tuple]) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """``(grades, chosen features, weights, thresholds)`` by gradient ascent on the likelihood."""
    grades = sorted({label for _, label, _ in rows})
    level = np.array([grades.index(label) for _, label, _ in rows], np.int64)
    cuts = len(grades) - 1
    if cuts < 1:
        return grades, np.empty(0, np.int64), np.empty(0), np.empty(0)
    chosen = np.unique(
        np.concatenate(
            [
                hashed.chosen_features([(f, float(y > k)) for (f, _, _), y in zip(rows, level, strict=True)], LEAST_Z)
                for k in range(cuts)
            ]
        )
    )
    row, column = hashed.design([f for f, _, _ in rows], chosen)
    below = np.array([(level <= k).mean() for k in range(cuts)]).clip(1e-3, 1 - 1e-3)
    start = np.log(below / (1 - below))
    # thresholds as a first one and the logarithms of the gaps keep their order
    shape = np.concatenate((start[:1], np.log(np.diff(start).clip(1e-3))))
    weights = np.zeros(len(chosen))
    steps = np.full(len(weights), 1e-8), np.full(cuts, 1e-8)
    for _ in range(ROUNDS):
        thresholds = np.cumsum(np.concatenate((shape[:1], np.exp(shape[1:]))))
        score = np.bincount(row, weights[column], len(level))
        edge = _sigmoid(np.concatenate(([-np.inf], thresholds, [np.inf]))[None, :] - score[:, None])
        high, low = edge[np.arange(len(level)), level + 1], edge[np.arange(len(level)), level]
        mass = (high - low).clip(1e-12)
        by_high, by_low = high * (1 - high) / mass, low * (1 - low) / mass
        up = (by_low - by_high) / len(level)  # the log likelihood's slope in the score
        slope = np.array(
            [by_high[level == k].sum() - by_low[level == k + 1].sum() for k in range(cuts)]
        ) / len(level)
        tail = np.cumsum(slope[::-1])[::-1]
        moves = (
            np.bincount(column, up[row], len(chosen)) - RIDGE * weights,
            tail * np.concatenate(([1.0], np.exp(shape[1:]))),
        )
        for value, move, square in zip((weights, shape), moves, steps, strict=True):
            square += move * move
            value += RATE * move / np.sqrt(square)
    return grades, chosen, weights, np.cumsum(np.concatenate((shape[:1], np.exp(shape[1:]))))


def fitted(docs: DataFrame, ratings: DataFrame, most_rows: int = SAMPLE_ROWS) -> tuple:
    """A model from ``docs`` (``doc_id``, ``text``) and ``ratings`` (``doc_id``, whole-number ``label``)."""
    return fit(hashed.sampled_features(hashed.labelled_sample(docs, ratings, most_rows), True))


def graded(docs: DataFrame, model: tuple, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, expected_grade, tails``: ``tails[i]`` is the probability of the ``i + 1``-th grade or better."""
    rows = spread(docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")), "doc_id")
    parts = docs.sparkSession.sparkContext.broadcast(model)  # hashed.MOST_FEATURES weights a threshold
    kind = rows.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, (grades, chosen, weights, thresholds) = hashed.Tokens(True), parts.value
        gaps = np.diff(np.array(grades, float))
        for batch in regrouped(batches, "text"):
            score = hashed.linear_scores(batch.column("text").to_pylist(), chosen, weights, tokens)
            tails = _sigmoid(score[:, None] - thresholds[None, :])
            expected = (grades[0] + tails @ gaps).tolist() if grades else [None] * len(score)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(expected, pa.float64()), pa.array(tails.tolist(), pa.list_(pa.float64()))],
                names=["doc_id", "expected_grade", "tails"],
            )

    return rows.mapInArrow(of, f"doc_id {kind}, expected_grade double, tails array<double>")
