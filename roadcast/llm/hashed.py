"""Hashed binary text features, chosen by significance on a bounded labelled sample.

A text's features are its distinct words and, by steps, how large a share of its tokens has
a certain shape, repeats the token before, or stands in capitals. All are 64-bit hashes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadcast.llm.common import drawn, regrouped

WORD = re.compile(r"[^\W\d_]+")
STEPS = (1 / 64, 1 / 16, 1 / 4)
MEMO_TOKENS = 200_000
#: Feature choice: occurrences at least, features at most.
LEAST_COUNT, MOST_FEATURES = 5, 1024


def hash_of(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) >> 1  # fits a signed long


def shape(token: str) -> str:
    """Letters to ``a`` or ``A``, digits to ``9``, repeats of a character once."""
    out = ""
    for c in token[:64]:
        c = "A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c
        if not out.endswith(c):
            out += c
    return out


class Tokens:
    """Numbers for distinct tokens, with the word hashes and the shape hash of each."""

    def __init__(self, shapes: bool):
        self.shapes = shapes
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.features: list[tuple[int, ...]] = []
        self.shape: list[int] = []

    def of(self, tokens: list[str]) -> np.ndarray:
        number = self.number
        for token in dict.fromkeys(tokens):
            if token not in number:
                number[token] = len(number)
                words = WORD.findall(token.lower())
                self.features.append(tuple(hash_of(w) for w in words))
                self.shape.append(hash_of("shape " + shape(token)) if self.shapes else 0)
        return np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))


def features(text: str | None, tokens: Tokens) -> np.ndarray:
    """Distinct feature hashes of a whole text, ascending."""
    if len(tokens.number) > MEMO_TOKENS:
        tokens.forget()
    numbers = tokens.of(text.split() if text else [])
    distinct, counts = (x.tolist() for x in np.unique(numbers, return_counts=True))
    found = {f for n in distinct for f in tokens.features[n]}
    if tokens.shapes and len(numbers):
        kinds = Counter({hash_of("repeated"): int((numbers[1:] == numbers[:-1]).sum())})
        for n, count in zip(distinct, counts, strict=True):
            kinds[tokens.shape[n]] += count
        for kind, count in kinds.items():
            found.update((kind + i + 1) & (2**63 - 1) for i, step in enumerate(STEPS) if count >= step * len(numbers))
    return np.array(sorted(found), np.int64)


def chosen_features(rows: list[tuple[np.ndarray, float]], least_z: float, always: tuple[int, ...] = ()) -> np.ndarray:
    """Features whose mean label differs from the rest's by ``least_z`` standard errors; the strongest ones.

    ``rows`` has features and a label (0 or 1, or a grade).
    """
    labels = np.array([label for _, label in rows], float)
    if not len(labels) or labels.min() == labels.max():
        return np.array(sorted(set(always)), np.int64)
    flat = np.concatenate([f for f, _ in rows])
    order = np.argsort(flat)
    own = np.repeat(labels.astype(np.float32), [len(f) for f, _ in rows])[order]
    flat = flat[order]
    del order
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(flat)), bool), flat[1:] != flat[:-1])))
    values, counts = flat[starts], np.diff(np.append(starts, len(flat)))
    sums = np.add.reduceat(own, starts, dtype=np.float64) if len(starts) else np.empty(0)
    rest = len(labels) - counts
    fits = (counts >= LEAST_COUNT) & (rest > 0)
    gap = sums / counts - (labels.sum() - sums) / np.maximum(rest, 1)
    z = np.abs(gap) / (labels.std() * np.sqrt(1 / counts + 1 / np.maximum(rest, 1)))
    z[~fits] = 0
    order = np.argsort(-z, kind="stable")[:MOST_FEATURES]
    kept = values[order[z[order] >= least_z]]
    return np.unique(np.concatenate([kept, np.array(always, np.int64)]))


def design(rows: list[np.ndarray], chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, column)`` of every chosen feature that a row has."""
    row = np.repeat(np.arange(len(rows)), [len(f) for f in rows])
    flat = np.concatenate([np.empty(0, np.int64), *rows])
    at = np.searchsorted(chosen, flat)
    hit = at < len(chosen)
    hit[hit] = chosen[at[hit]] == flat[hit]
    return row[hit], at[hit]


def labelled_sample(docs: DataFrame, labels: DataFrame, most_rows: int) -> DataFrame:
    """``doc_id, text, label`` of about ``most_rows`` labelled documents, by the hash of their ids.

    ``labels`` has ``doc_id`` and ``label``; of several labels of a document the greatest counts.
    """
    one = labels.filter("label IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    few = drawn(one, "doc_id", most_rows)
    return docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")  # twice most_rows bounds what is broadcast


def sampled_features(sample: DataFrame, shapes: bool, twin=None) -> list[tuple]:
    """``(features, label, twin's features or None)`` of a bounded ``doc_id, text, label`` sample, in a fixed order.

    ``twin`` maps a text to its counterfactual, or to None.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(shapes)
        for batch in regrouped(batches, "text"):
            texts = batch.column("text").to_pylist()
            twins = [twin(t) if twin and t else None for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("label"),
                    pa.array([features(t, tokens).tobytes() for t in texts], pa.binary()),
                    pa.array([None if t is None else features(t, tokens).tobytes() for t in twins], pa.binary()),
                ],
                names=["doc_id", "label", "own", "twin"],
            )

    kind = sample.schema["doc_id"].dataType.simpleString()
    label = sample.schema["label"].dataType.simpleString()
    rows = sample.mapInArrow(of, f"doc_id {kind}, label {label}, own binary, twin binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["own"]))
    return [
        (np.frombuffer(r["own"], np.int64), r["label"], None if r["twin"] is None else np.frombuffer(r["twin"], np.int64))
        for r in rows
    ]


def linear_scores(texts: list[str | None], chosen: np.ndarray, weights: np.ndarray, tokens: Tokens) -> np.ndarray:
    """The sum of a text's weights, for every text."""
    rows = [features(t, tokens) for t in texts]
    row, column = design(rows, chosen)
    return np.bincount(row, weights[column], len(texts)) if len(texts) else np.empty(0)
