"""Language of texts by a linear-chain conditional random field over words.

Every word has hashed features: letter n-grams of one to four, affixes of one to three
letters, and its membership in each language's lexicon of telling words. A word's score
for a language is the sum of its features' weights, and learned transitions say how
readily one language follows another, so code-switched text is labelled word by word. Exact
marginals come from forward-backward; a text's language is the one with the greatest mean
marginal, which is the score.

Training takes a bounded sample of labelled texts, ``PER_LANGUAGE`` a language at most
and none over ``TRAIN_CHARS``, and mixes stretches of them into sequences that switch language.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, and so is every
text if no row is labelled; repeated rows are rows of their own; an empty table gives an
empty result; ``lang`` and columns other than the id and the text never reach a prediction.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadcast.llm.common import kept, regrouped, spread

WORD = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 16
PER_LANGUAGE, TRAIN_CHARS = 300, 20_000
LEXICON_WORDS, LEXICON_COUNT, LEXICON_SHARE = 2_000, 5, 0.9
SEQUENCE, BATCH, STEPS, RATE, DECAY, SWITCH = 64, 64, 160, 0.15, 1e-5, 0.06
CHUNK = 128
MEMO_WORDS, BATCH_BYTES = 200_000, 1 << 20
UNKNOWN = "und"
RESULT = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("lang_score", T.DoubleType()),
        T.StructField("lang_confidence", T.DoubleType()),
        T.StructField("lang_words", T.LongType()),
        T.StructField("lang_shares", T.MapType(T.StringType(), T.DoubleType())),
    ]
)


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters; runs of letter-like numerals alone are no words."""
    found = WORD.findall(text.lower()) if text else []
    return found if not text or text.isascii() else [w for w in found if w.isalpha() or any(map(str.isalpha, w))]


# --- features --------------------------------------------------------------------------


def feature_ids(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(buckets, bounds)``: word ``i`` has ``buckets[bounds[i]:bounds[i + 1]]``."""
    marked = "".join(f"\x02{w}\x03" for w in words)
    code = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    begin, end = np.repeat(ends - sizes, sizes), np.repeat(ends, sizes)
    place = np.arange(len(code))
    buckets, owners = [], []

    def hashed(value: np.ndarray, kind: int) -> np.ndarray:
        value = (value + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        return (value >> np.uint64(48)).astype(np.int64) % BUCKETS

    value = np.zeros(len(code), np.uint64)
    for n in range(1, 5):
        value = value[: len(code) - n + 1] * np.uint64(1_000_003) + code[n - 1 :]
        at = place[: len(value)]
        fits = at + n <= end[: len(value)]
        buckets.append(hashed(value[fits], n))
        owners.append(owner[at[fits]])
        if n > 1:  # the marker and up to three letters: affixes have weights of their own
            for kind, edge in ((10 + n, at == begin[: len(value)]), (20 + n, at + n == end[: len(value)])):
                chosen = fits & edge
                buckets.append(hashed(value[chosen], kind))
                owners.append(owner[at[chosen]])
    buckets, owners = np.concatenate(buckets), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return buckets[order], np.concatenate(([0], np.cumsum(np.bincount(owners, minlength=len(words)))))


def lexicons(words: list[list[str]], labels: list[int], languages: int) -> list[dict[str, int]]:
    """Per language its commonest words that the other languages hardly have."""
    counts = [Counter() for _ in range(languages)]
    for own, label in zip(words, labels, strict=True):
        counts[label].update(own)
    rates = [max(1, sum(c.values())) for c in counts]
    found = []
    for k, count in enumerate(counts):
        telling = [
            w for w, n in count.items()
            if n >= LEXICON_COUNT
            and n / rates[k] >= LEXICON_SHARE * sum(c[w] / r for c, r in zip(counts, rates, strict=True))
        ]
        telling.sort(key=lambda w: (-count[w], w))
        found.append({w: k for w in telling[:LEXICON_WORDS]})
    return found


# --- the chain -------------------------------------------------------------------------


def marginals(
    scores: np.ndarray, starts: np.ndarray, transition: np.ndarray, initial: np.ndarray, moves: np.ndarray | None = None
) -> np.ndarray:
    """Exact label marginals ``(words, labels)`` of all sequences at once.

    ``moves`` (labels, labels) gets the expected number of steps from label to label added.

    Sequences stand one after the other, ``starts`` marking each first word. The whole is
    cut into ``CHUNK`` words: transfer matrices of all chunks are built in step, a pass over
    the chunks joins them, and a second run in step gives every word its messages.
    """
    total, labels = scores.shape
    count = -(-total // CHUNK)
    padded = np.zeros((count * CHUNK, labels))
    padded[:total] = np.maximum(scores - scores.max(axis=1, keepdims=True), -30)
    emit = np.exp(padded).reshape(count, CHUNK, labels)
    new = np.ones(count * CHUNK, bool)
    new[:total] = starts
    new = new.reshape(count, CHUNK)
    step, first = np.exp(transition), np.exp(initial)

    transfer = np.broadcast_to(np.eye(labels), (count, labels, labels)).copy()
    for t in range(CHUNK):
        moved = (transfer.reshape(-1, labels) @ step).reshape(transfer.shape)
        begins = new[:, t]
        if begins.any():
            moved[begins] = transfer[begins].sum(axis=2, keepdims=True) * first
        transfer = moved * emit[:, t, None, :]
        if t % 8 == 7:
            transfer /= transfer.max(axis=(1, 2), keepdims=True)
    into, out = np.empty((count, labels)), np.empty((count, labels))
    vector = np.full(labels, 1 / labels)
    for k in range(count):
        into[k] = vector
        vector = vector @ transfer[k]
        vector /= vector.sum()
    vector = np.ones(labels)
    for k in reversed(range(count)):
        out[k] = vector
        vector = transfer[k] @ vector
        vector /= vector.sum()
    forward = np.empty((CHUNK, count, labels))
    message = into
    for t in range(CHUNK):
        moved = message @ step
        begins = new[:, t]
        moved[begins] = message[begins].sum(axis=1, keepdims=True) * first
        message = moved * emit[:, t]
        message /= message.sum(axis=1, keepdims=True)
        forward[t] = message
    message = out
    for t in reversed(range(CHUNK)):
        forward[t] *= message
        ahead = emit[:, t] * message
        begins = new[:, t]
        if moves is not None:
            behind = (forward[t - 1] if t else into)[~begins]
            joint = behind[:, :, None] * step * ahead[~begins][:, None, :]
            moves += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        message = ahead @ step.T
        message[begins] = (ahead[begins] @ first)[:, None]
        message /= message.sum(axis=1, keepdims=True)
    found = forward.transpose(1, 0, 2).reshape(-1, labels)[:total]
    return found / found.sum(axis=1, keepdims=True)


class Model:
    """``weights`` (buckets, labels), ``lexicon`` (word to label), ``bonus`` (labels, labels), chain scores."""

    def __init__(self, languages, weights, lexicon, bonus, transition, initial):
        self.languages, self.weights, self.lexicon = languages, weights, lexicon
        self.bonus, self.transition, self.initial = bonus, transition, initial

    def parts(self) -> tuple:
        return self.languages, self.weights, self.lexicon, self.bonus, self.transition, self.initial

    def scores(self, words: list[str]) -> np.ndarray:
        """``(words, labels)``."""
        labels = len(self.languages)
        if not words:
            return np.zeros((0, labels))
        buckets, bounds = feature_ids(words)
        scores = np.add.reduceat(self.weights[buckets], bounds[:-1], axis=0).astype(np.float64)
        row = np.fromiter((self.lexicon.get(w, -1) for w in words), np.int64, len(words))
        scores[row >= 0] += self.bonus[row[row >= 0]]
        return scores


def train(texts: list[str], labels: list[str]) -> Model | None:
    """Gradient ascent on the likelihood of label sequences that switch language."""
    languages = sorted(set(labels))
    pairs = [(words_of(t), languages.index(k)) for t, k in zip(texts, labels, strict=True)]
    pairs = [(w, k) for w, k in pairs if w]
    if not pairs:
        return None
    kinds = len(languages)
    lexicon = {w: k for part in lexicons([w for w, _ in pairs], [k for _, k in pairs], kinds) for w, k in part.items()}
    numbers: dict[str, int] = {}
    streams = [[] for _ in languages]
    for own, k in pairs:
        streams[k] += [numbers.setdefault(w, len(numbers)) for w in own]
    streams = [np.array(s, np.int64) for s in streams]
    buckets, bounds = feature_ids(list(numbers))
    sizes = np.diff(bounds)
    lexical = np.fromiter((lexicon.get(w, -1) for w in numbers), np.int64, len(numbers))
    present = np.array([k for k, s in enumerate(streams) if len(s)])

    rng = np.random.default_rng(3)
    model = Model(
        languages, np.zeros((BUCKETS, kinds), np.float32), lexicon, np.zeros((kinds, kinds)), np.zeros((kinds, kinds)), np.zeros(kinds)
    )
    squares = [np.full_like(p, 1e-6) for p in (model.weights, model.bonus, model.transition, model.initial)]
    starts = np.tile(np.arange(SEQUENCE) == 0, BATCH)
    for _ in range(STEPS):
        turns = rng.random((BATCH, SEQUENCE)) < SWITCH
        truth = np.empty((BATCH, SEQUENCE), np.int64)
        word = np.empty((BATCH, SEQUENCE), np.int64)
        for row in range(BATCH):
            edges = [0, *np.flatnonzero(turns[row]).tolist(), SEQUENCE]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                k = rng.choice(present)
                at = rng.integers(len(streams[k]))
                truth[row, a:b] = k
                word[row, a:b] = streams[k][(at + np.arange(b - a)) % len(streams[k])]
        truth, word = truth.ravel(), word.ravel()
        lengths = sizes[word]
        flat = np.repeat(bounds[word] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        active = buckets[flat]
        scores = np.add.reduceat(model.weights[active], np.cumsum(lengths) - lengths, axis=0).astype(np.float64)
        known = lexical[word] >= 0
        scores[known] += model.bonus[lexical[word[known]]]
        expected = np.zeros((kinds, kinds))
        belief = marginals(scores, starts, model.transition, model.initial, expected)
        error = -belief
        error[np.arange(len(truth)), truth] += 1
        gradient = np.stack(
            [np.bincount(active, np.repeat(error[:, k], lengths), BUCKETS) for k in range(kinds)], axis=1
        )
        bonus = np.zeros_like(model.bonus)
        np.add.at(bonus, lexical[word[known]], error[known])
        inner = ~starts[1:]
        pair = np.zeros((kinds, kinds))
        np.add.at(pair, (truth[:-1][inner], truth[1:][inner]), 1)
        for value, grad, square in zip(
            (model.weights, model.bonus, model.transition, model.initial),
            (gradient, bonus, pair - expected, error[starts].sum(axis=0)),
            squares,
            strict=True,
        ):
            grad = grad / len(truth) - DECAY * value
            square += grad * grad
            value += (RATE * grad / np.sqrt(square)).astype(value.dtype)
        model.transition -= model.transition.max()
    return model


# --- jobs ------------------------------------------------------------------------------


def training_sample(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``text, lang``: of each language about ``per_language`` texts with the least id hashes.

    Of a text of over ``TRAIN_CHARS`` characters two stretches are taken, so that every language is learned.
    """
    fitting = labelled.filter(F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = {r["lang"]: r["count"] for r in fitting.groupBy("lang").count().collect()}
    if not counts:
        return fitting.select("text", "lang").limit(0)
    share = F.create_map([F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_language / n))])
    half = TRAIN_CHARS // 2
    middle = F.substr("text", (F.length("text") / 2).cast("int"), F.lit(half))
    stretch = F.when(F.length("text") <= TRAIN_CHARS, F.col("text")).otherwise(F.concat_ws(" ", F.substring("text", 1, half), middle))
    draw = (F.xxhash64("doc_id", "text") / F.lit(2.0**64)) + 0.5
    return fitting.filter(draw <= share[F.col("lang")]).select(stretch.alias("text"), "lang")


def fitted(labelled: DataFrame) -> Model | None:
    """A model from ``doc_id, text, lang`` rows."""
    rows = sorted(map(tuple, training_sample(labelled).collect()))
    return train([t for t, _ in rows], [k for _, k in rows])


class WordScores:
    """The score rows of about ``MEMO_WORDS`` words."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.rows = np.empty((0, len(self.model.languages)), np.float32)

    def of(self, lists: list[list[str]]) -> np.ndarray:
        """``(words, labels)`` of all words in a row."""
        if len(self.numbers) > MEMO_WORDS:
            self._forget()
        fresh = [w for w in dict.fromkeys(w for own in lists for w in own) if w not in self.numbers]
        self.numbers.update(zip(fresh, range(len(self.numbers), len(self.numbers) + len(fresh)), strict=True))
        self.rows = np.concatenate([self.rows, self.model.scores(fresh).astype(np.float32)])
        total = sum(map(len, lists))
        return self.rows[np.fromiter((self.numbers[w] for own in lists for w in own), np.int64, total)]


def predict_batch(texts: list[str | None], model: Model, table: WordScores) -> tuple[list, list, list, list, list]:
    """Language, score, confidence, number of words, and each language's share of every text.

    The confidence is the mean of every word's greatest marginal, so it is high for a text in several languages too.
    """
    lists = [words_of(t) for t in texts]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    filled = np.flatnonzero(sizes)
    labels = [UNKNOWN] * len(texts)
    scores, sure, shares = [0.0] * len(texts), [0.0] * len(texts), [{} for _ in texts]
    if len(filled):
        begins = np.cumsum(sizes[filled]) - sizes[filled]
        starts = np.zeros(int(sizes.sum()), bool)
        starts[begins] = True
        belief = marginals(table.of(lists), starts, model.transition, model.initial)
        means = np.add.reduceat(belief, begins, axis=0) / sizes[filled, None]
        greatest = np.add.reduceat(belief.max(axis=1), begins) / sizes[filled]
        for i, mean, confidence in zip(filled.tolist(), means.tolist(), greatest.tolist(), strict=True):
            best = max(range(len(mean)), key=mean.__getitem__)
            labels[i], scores[i], sure[i] = model.languages[best], min(1.0, mean[best]), min(1.0, confidence)
            shares[i] = dict(zip(model.languages, mean, strict=True))
    return labels, scores, sure, sizes.tolist(), shares


def languages(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with ``RESULT``; ``lang_shares`` says for each language which share of the words it has."""
    rows = spread(docs.select(*[c for c in docs.columns if c not in RESULT.names]), id_column)
    parts = docs.sparkSession.sparkContext.broadcast(model.parts() if model else None)  # buckets x languages numbers
    fit = uuid.uuid4().hex
    schema = T.StructType([*rows.schema.fields, *RESULT.fields])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a table belongs to its model: another fit in the same worker gets another one
        table = kept(("language", fit), lambda: WordScores(Model(*parts.value)) if parts.value else None)
        for batch in regrouped(batches, text_column, BATCH_BYTES):
            texts = batch.column(text_column).to_pylist()
            if table:
                found = predict_batch(texts, table.model, table)
            else:
                zeros = [0.0] * len(texts)
                found = [UNKNOWN] * len(texts), zeros, zeros, [len(words_of(t)) for t in texts], [{}] * len(texts)
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.map_(pa.string(), pa.float64()))
            columns = [pa.array(v if k != kinds[4] else [list(d.items()) for d in v], k) for v, k in zip(found, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.names)

    return rows.mapInArrow(of, schema)
