"""Language identification by averaged subword embeddings and a linear softmax.

The model is fitted in numpy on a bounded sample of the labelled documents; predictions cover every
whole text, one batch at a time. A text's features are the hashed letter n-grams of its words, its
vector their averaged embeddings. Rejection is calibrated on documents that were not trained on: a text
goes if its confidence lies below what nearly all right ones of those reach, or if more of its n-grams
are new than in nearly all of those. The second rule tells languages that the model has never seen,
of which a softmax over known ones is as sure as of any.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

UNKNOWN = "und"
# The bound of the sample: documents of each language that the model may be fitted on.
SAMPLE_PER_LANGUAGE = 1_500
BUCKETS, WIDTH, GRAMS = 1 << 15, 16, (1, 2, 3)
# Bits of an n-gram's hash; its bucket is the hash without the last ones.
HASH_BITS, REST_BITS = 20, 5
# Share of the right predictions on the calibration documents that may be rejected.
REJECTED = 0.001
# How much more of a text may be new than in nearly all calibration documents: a factor and a share.
NEW_FACTOR, NEW_SHARE = 2.0, 0.1
EPOCHS, BATCH, RATE, BUCKET_RATE = 20, 64, 2.0, 200.0

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
# Characters read at a time from a very long text.
PIECE = 1 << 20


def _letters(points: np.ndarray) -> np.ndarray:
    """Which code points are letters; those beyond the table's plane are looked up one by one."""
    known = points < len(_TABLE)
    out = _TABLE[np.where(known, points, 0)]
    if not known.all():
        out[~known] = [chr(p).isalpha() for p in points[~known].tolist()]
    return out


_TABLE = np.array([chr(p).isalpha() for p in range(0x3000)])


def grams(text: str) -> np.ndarray:
    """Hashes of the letter n-grams of a text; a word's ends count as a letter of their own."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    points = np.concatenate([[0], np.where(_letters(points), points, 0), [0]])
    points = points[np.concatenate([[True], (points[1:] != 0) | (points[:-1] != 0)])].astype(np.uint64)
    out = []
    for n in GRAMS:
        if len(points) < n:
            continue
        size = len(points) - n + 1
        code, inside = np.full(size, n, np.uint64), np.zeros(size, np.int64)
        for at in range(n):
            code = (code ^ points[at:at + size]) * _MULTIPLIER
            code ^= code >> np.uint64(29)
            inside += points[at:at + size] != 0
        # A gram holds a letter, and the end of a word only at its own end.
        middle = np.zeros(size, bool)
        for at in range(1, n - 1):
            middle |= points[at:at + size] == 0
        out.append((code >> np.uint64(64 - HASH_BITS))[(inside > 0) & ~middle])
    return np.concatenate(out).astype(np.int64) if out else np.empty(0, np.int64)


@dataclass(frozen=True)
class Model:
    """Languages, the weight of each bucket for each language, the calibration, and the n-grams that are known."""

    languages: tuple[str, ...]
    weights: np.ndarray
    bias: np.ndarray
    sharpness: float
    least: float
    known: np.ndarray
    most_new: float

    def logits(self, text: str) -> np.ndarray | None:
        """Scores of the languages; None without letters. A long text is read in pieces cut at white space."""
        return self._read(text)[0]

    def _read(self, text: str) -> tuple[np.ndarray | None, float]:
        """The scores, and the share of n-grams that are new."""
        total, count, new, start = np.zeros(len(self.languages)), 0, 0, 0
        while start < len(text):
            stop = start + PIECE
            while stop < len(text) and text[stop].isalpha():
                stop += 1
            found = grams(text[start:stop])
            total += self.weights[found >> REST_BITS].sum(axis=0, dtype=np.float64)
            new += len(found) - int(np.count_nonzero(self.known[found]))
            count, start = count + len(found), stop
        return (total / count + self.bias, new / count) if count else (None, 0.0)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and calibrated probability; ``und`` and 0 if there is no letter or no language was learned."""
        return self.judge(text)[:2]

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """``predict``, and whether the text is rejected."""
        scores, new = self._read(text) if text and self.languages else (None, 0.0)
        if scores is None:
            return UNKNOWN, 0.0, True
        p = _softmax(scores * self.sharpness)
        return self.languages[int(p.argmax())], float(p.max()), bool(p.max() < self.least or new > self.most_new)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _shares(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A text's distinct buckets and n-grams, each with its share."""
    gram, times = np.unique(grams(text), return_counts=True)
    bucket, at = np.unique(gram >> REST_BITS, return_inverse=True)
    share = times / max(1, times.sum())
    return bucket.astype(np.int32), np.bincount(at, share).astype(np.float32)[:, None], gram.astype(np.int32), share


def train(texts: list[str], labels: list[str], seed: int = 8) -> Model:
    """A model from texts and their languages, four fifths for training and the rest for calibration.

    Texts without letters are not used. No text at all gives a model that answers ``und``.
    """
    # A text enters as its distinct buckets and their shares.
    found = [(_shares(text), label) for text, label in zip(texts, labels)]
    found = [(row, label) for row, label in found if len(row[0])]
    languages = tuple(sorted({label for _, label in found}))
    if not languages:
        return Model((), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0, np.zeros(1 << HASH_BITS, bool), 1.0)
    target = np.array([languages.index(label) for _, label in found])
    rows = [row for row, _ in found]
    held = np.arange(len(rows)) % 5 == 4
    random = np.random.default_rng(seed)
    embedding = random.normal(0, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    linear, bias = np.zeros((WIDTH, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    linear += random.normal(0, 1 / WIDTH, linear.shape)
    training = np.flatnonzero(~held)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for batch in np.array_split(random.permutation(training), max(1, len(training) // BATCH)):
            mean = np.stack([(embedding[rows[i][0]] * rows[i][1]).sum(axis=0) for i in batch])
            error = _softmax(mean @ linear + bias)
            error[np.arange(len(batch)), target[batch]] -= 1
            error /= len(batch)
            back = error @ linear.T
            linear -= rate * (mean.T @ error)
            bias -= rate * error.sum(axis=0)
            # A bucket has a small share of a text, so its step is longer.
            for i, step in zip(batch, back):
                embedding[rows[i][0]] -= BUCKET_RATE * rate * rows[i][1] * step
    weights = embedding @ linear
    scores = np.stack([(weights[row[0]] * row[1]).sum(axis=0) for row in rows]) + bias
    known = np.zeros(1 << HASH_BITS, bool)
    for i in training:
        known[rows[i][2]] = True
    new = np.array([share[~known[gram]].sum() for _, _, gram, share in rows])
    check = held if held.any() else ~held
    sharpness = _sharpness(scores[check], target[check])
    p = _softmax(scores[check] * sharpness)
    right = p.max(axis=1)[p.argmax(axis=1) == target[check]]
    # Below every right one there is a margin, so that clean texts like them stay.
    least = float(np.quantile(right, REJECTED)) / 2 if len(right) else 0.0
    most_new = NEW_FACTOR * float(np.quantile(new[check], 1 - REJECTED)) + NEW_SHARE
    return Model(languages, weights, bias.astype(np.float64), sharpness, max(least, 1 / len(languages)) if len(languages) > 1 else least,
                 known, most_new)


def _sharpness(scores: np.ndarray, target: np.ndarray) -> float:
    """The factor on the scores that makes the held-out documents likeliest."""
    factors = np.geomspace(0.05, 20, 200)
    loss = [-np.log(np.maximum(_softmax(scores * f)[np.arange(len(target)), target], 1e-12)).mean() for f in factors]
    return float(factors[int(np.argmin(loss))])


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """A model from at most ``per_language`` documents of each language, the first by a hash of key and text.

    Rows without text or language are not used. Every map task keeps its first rows only, so no
    language's rows meet in one place.
    """
    order = F.xxhash64(F.lit(8), F.col(key), F.col(text)).alias("order")
    labelled = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), order)
    # Hashes are uniform: the rows below this share of their range hold the sample with a margin.
    low, span = -(2**63), 2**64 - 1
    chosen = None
    for row in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect():
        share = (1.3 * per_language + 200) / row["n"]
        rule = F.col("lang") == row["lang"]
        if share < 1:
            rule &= F.col("order") <= int(low + share * span)
        chosen = rule if chosen is None else chosen | rule
    if chosen is None:
        return train([], [])
    # Repeated rows are one document here.
    rows = labelled.where(chosen).groupBy("lang", "order").agg(F.min("text").alias("text")).collect()
    picked: dict[str, list] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["order"])):
        picked.setdefault(row["lang"], []).append(row["text"])
    pairs = [(t, name) for name, found in picked.items() for t in found[:per_language]]
    return train([t for t, _ in pairs], [name for _, name in pairs])


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, label: str = "lang_pred",
            score: str = "score", rejected: str = "rejected") -> DataFrame:
    """The columns ``keep`` (all by default) with the language of every text, its probability, and whether it is rejected.

    A null text, or one without letters, is ``und`` with score 0 and rejected; others are rejected
    below the model's limit of confidence or above that of new n-grams. Columns of these names are replaced. Every row gives one row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    given = [c for c in (docs.columns if keep is None else keep) if c not in (label, score, rejected)]

    def rows(batches):
        for batch in batches:
            found = [shared.value.judge(t.as_py()) for t in batch.column(len(given))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(given))), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()),
                 pa.array([f[2] for f in found], pa.bool_())], names)

    schema = docs.select(*given).schema.add(label, "string").add(score, "double").add(rejected, "boolean")
    names = schema.names
    return docs.select(*given, F.col(text).alias("text of the row")).mapInArrow(rows, schema)
