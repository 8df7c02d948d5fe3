"""Quality classifier: a linear-chain conditional random field over lines (operator 1).

Every line of a document is labelled good or bad. A line's features are ratios of its words
and characters and those of the line before and after it; the chain's transitions let
neighbours agree. Forward-backward gives each line its marginal probability of being good, and
the mean of these, weighted by the lines' lengths, is the document's score.

The field is fitted by maximum likelihood on a bounded sample: of each label, at most
``PER_LABEL`` labelled documents, those smallest in a hash of their key, chosen by Spark over
all labelled documents. A key that many rows repeat counts as one document, the row smallest in
a hash of its text. Lines take their document's label. A sampled document of more than ``LINES``
lines teaches by a run of that many neighbouring lines, which starts at a place drawn from its
hash; so the sample has at most ``2 * PER_LABEL * LINES`` lines. Scoring adds one column in the
scan of the documents, over whole texts of any length, and looks at the text alone.

Defined cases: null and empty texts are one empty line; documents whose label is null or whose
key is null teach nothing, as do labels without a document; a key labelled twice counts once
per label; if one of the two labels was never seen, every score is 0.5; empty tables give
empty results; extra columns pass through.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, StructField, StructType

from pixelweave.llm.rules import SYMBOLS, repeated_words
from pixelweave.llm.text import first_of_each, texts

PER_LABEL = 600
LINES = 500
ROUNDS = 120

_OWN = 12
N_FEATURES = 3 * _OWN + 3


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of every line (own, previous, next, ends of the chain) and the lines' lengths."""
    lines = text.split("\n")
    own = np.zeros((len(lines), _OWN), np.float32)
    seen: set[str] = set()
    for row, line in zip(own, lines):
        words = line.split()
        n = len(words)
        if not n:
            row[0] = 1
            continue
        counts = Counter(words)
        chars = sum(map(len, words))
        row[1] = n < 4
        row[2] = min(n, 40) / 40
        row[3] = min(chars / n, 16) / 16
        row[4] = min(1.0, sum(map(line.count, SYMBOLS)) / n)
        row[5] = min(2.0, sum(map(line.count, ".,;:!?")) / n)
        row[6] = sum(map(str.isupper, words)) / n
        row[7] = max(counts.values()) / n if n >= 4 else 0
        row[8] = 1 - len(counts) / n
        row[9] = repeated_words(words) / n
        row[10] = line in seen
        row[11] = line.rstrip()[-1:] in ".?!"
        seen.add(line)
    features = np.zeros((len(lines), N_FEATURES), np.float32)
    features[:, :_OWN] = own
    features[1:, _OWN : 2 * _OWN] = own[:-1]
    features[:-1, 2 * _OWN : 3 * _OWN] = own[1:]
    features[:, -3] = 1
    features[0, -2] = features[-1, -1] = 1
    return features, np.array([len(line) + 1 for line in lines], np.float64)


def _log_sum(x: np.ndarray) -> np.ndarray:
    """log(sum(exp(x))) over the axis before the last."""
    top = x.max(axis=-2, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=-2)) + top[..., 0, :]


def forward_backward(emission: np.ndarray, lengths: np.ndarray, step: np.ndarray):
    """Marginals (n, t, 2) and summed pair marginals (2, 2) of chains padded to one length,
    longest first, with scores ``emission`` (n, t, 2) and transitions ``step`` (from, to)."""
    n, most, _ = emission.shape
    alpha, beta = emission.copy(), np.zeros_like(emission)
    active = [int((lengths > t).sum()) for t in range(most)]
    for t in range(1, most):
        m = active[t]
        alpha[:m, t] += _log_sum(alpha[:m, t - 1, :, None] + step)
    for t in range(most - 2, -1, -1):
        m = active[t + 1]
        ahead = emission[:m, t + 1] + beta[:m, t + 1]
        beta[:m, t] = _log_sum(ahead[:, :, None] + step.T)
    total = alpha + beta
    total -= total.max(axis=2, keepdims=True)
    marginal = np.exp(total)
    marginal /= marginal.sum(axis=2, keepdims=True)
    pairs = np.zeros((2, 2))
    for t in range(most - 1):
        m = active[t + 1]
        joint = alpha[:m, t, :, None] + step + (emission[:m, t + 1] + beta[:m, t + 1])[:, None, :]
        joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return marginal, pairs


@dataclass(frozen=True)
class Field:
    """Weights of a good line's features and transition scores (from, to); none if unfitted."""

    weights: np.ndarray | None
    step: np.ndarray | None

    def score(self, text: str) -> float:
        """Length-weighted mean of the lines' marginals."""
        if self.weights is None:
            return 0.5
        features, lengths = line_features(text)
        odds = (features @ self.weights).tolist()
        # Messages are log odds of the two labels, so a chain is a scalar recursion.
        forward = list(odds)
        for t in range(1, len(odds)):
            forward[t] += _message(forward[t - 1], self.step)
        back, turned, total = 0.0, self.step.T, 0.0
        for t in range(len(odds) - 1, -1, -1):
            total += lengths[t] / (1 + math.exp(-max(-500.0, min(500.0, forward[t] + back))))
            back = _message(odds[t] + back, turned)
        return float(min(1.0, max(0.0, total / lengths.sum())))


def _message(odds: float, step: np.ndarray) -> float:
    """Log odds that a chain passes on through its transitions."""
    (s00, s01), (s10, s11) = step.tolist()
    odds = max(-500.0, min(500.0, odds))
    return _log_add(s01, s11 + odds) - _log_add(s00, s10 + odds)


def _log_add(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def fit(documents: list[np.ndarray], labels: list[int], rounds: int = ROUNDS, penalty: float = 1e-3,
        rate: float = 0.1) -> Field:
    """Maximum likelihood by gradient ascent with adaptive steps; lines carry their document's
    label, and both labels and all documents weigh the same."""
    if len(set(labels)) < 2:
        return Field(None, None)
    order = sorted(range(len(documents)), key=lambda i: -len(documents[i]))
    lengths = np.array([len(documents[i]) for i in order])
    y = np.array([labels[i] for i in order])
    n, most = len(order), int(lengths.max())
    share = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum()) / lengths
    flat = np.concatenate([documents[i] for i in order]).astype(float)
    inside = np.arange(most)[None, :] < lengths[:, None]
    per_line = np.repeat(share, lengths)
    good = np.repeat(y, lengths)
    # Transitions are the same numbers for all chains, so their gradient is taken unweighted.
    observed = np.zeros((2, 2))
    for label in (0, 1):
        observed[label, label] = (lengths[y == label] - 1).sum()
    theta = np.zeros(flat.shape[1] + 4)
    mean = square = np.zeros_like(theta)
    for t in range(1, rounds + 1):
        weights, step = theta[:-4], theta[-4:].reshape(2, 2)
        emission = np.zeros((n, most, 2))
        emission[..., 1][inside] = flat @ weights
        marginal, pairs = forward_backward(emission, lengths, step)
        error = per_line * (good - marginal[..., 1][inside])
        steps = (observed - pairs) / max(1, lengths.sum() - n)
        gradient = np.r_[flat.T @ error, steps.ravel()] - penalty * theta
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        theta = theta + rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
    return Field(theta[:-4], theta[-4:].reshape(2, 2))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "quality", per_label: int = PER_LABEL, lines: int = LINES) -> Field:
    """Fit on at most ``per_label`` documents of each label and ``lines`` lines of each."""
    known = labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("label"))
    known = known.where("id is not null and label in (0, 1)").distinct()
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).where("id is not null")
    rows = rows.withColumn("mark", F.xxhash64("text"))
    # One row a key, found by partial minima in every task.
    one = rows.groupBy("id").agg(F.min("mark").alias("mark"))
    by_hash = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id")
    chosen = (
        known.join(one, "id")
        .withColumn("place", F.row_number().over(by_hash))
        .where(F.col("place") <= per_label)
        .select("id", "mark", "label")
        .collect()
    )
    if not chosen:
        return Field(None, None)
    # A bounded list of keys, so sending it to every executor is safe.
    row = ["id", "mark", "label"]
    key_schema = StructType([*rows.select("id", "mark").schema, StructField("label", IntegerType())])
    keys = docs.sparkSession.createDataFrame([tuple(r) for r in chosen], key_schema)
    schema = StructType([*key_schema, StructField("features", BinaryType())])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in batches:
            batch = first_of_each(batch, row, seen)
            found = []
            for text_, mark in zip(texts(batch.column("text")), batch.column("mark").to_pylist()):
                features = line_features(text_)[0]
                at = mark % max(1, len(features) - lines + 1)
                found.append(features[at : at + lines].tobytes())
            yield pa.RecordBatch.from_arrays([*map(batch.column, row), pa.array(found, pa.binary())], schema.names)

    sample = rows.join(F.broadcast(keys), ["id", "mark"]).select(*row, "text").mapInArrow(describe, schema)
    found = sorted((r["label"], bytes(r["features"])) for r in sample.dropDuplicates(row).collect())
    documents = [np.frombuffer(f, np.float32).reshape(-1, N_FEATURES) for _, f in found]
    return fit(documents, [label for label, _ in found])


def scored(field: Field, text: Column) -> Column:
    """Score of a text column."""

    @arrow_udf(DoubleType())
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([field.score(t) for t in texts(batch)], pa.float64())

    return of(text)
