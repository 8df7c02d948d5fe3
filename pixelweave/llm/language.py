"""Language identification by hierarchical discrimination (operator 8).

A first set of linear support vector machines tells language families apart, one against the
rest. Inside the winning family one machine for every two languages votes, so closely related
languages are separated by models that saw only them; equal votes are decided by the summed
margins.

The score is a confidence from 0 to 1. Its factors are how far the family's margin is above
the next one's, how far the winner's margins are above its rivals' (both 0 where the two are
equal), and how close the text is to the language: the cosine between the text's features and
the mean of the language's fitted documents, over the median of that cosine for documents that
are left out of the mean. It rises from 0 at ``FAR`` to 1 at ``NEAR``, so that a text unlike all
of them scores low even where there are few rivals. Fewer than ``LEAST_ROWS`` documents of a
language cannot tell how close its texts lie; that factor is then 1.

Features are counts of hashed byte pairs and triples of the whole lower-cased text, with
everything but letters reduced to blanks, scaled to unit length. The machines are fitted on a
bounded sample: at most ``per_language`` labelled documents of each language, those smallest
in a hash of their key, chosen by Spark over all labelled documents. A key that many rows repeat
counts as one document, the row smallest in a hash of its text. Scoring adds one column in the
scan of the documents.

Defined cases: a null text or one without a letter is ``und`` with score 0, as is every text
if nothing was learned; labels that are null teach nothing; a language that belongs to no
listed family is a family of its own; ties between languages go to the first by name; empty
tables give empty results; extra columns pass through.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, StringType, StructField, StructType,
)

from pixelweave.llm.text import few_texts, first_of_each

# Families of the ISO 639-1 codes most often met.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"),
}
UNKNOWN = "und"

# Hashed features; documents of each language that the machines are fitted on.
DIMENSIONS = 4096
PER_LANGUAGE = 300

# Closeness to the language at which a text is surely not, and surely, like its documents.
FAR, NEAR, LEAST_ROWS = 0.4, 0.5, 10

# Letters, and numbers that are no decimal digits.
_LETTER = re.compile(r"[^\W\d_]")
_BLANKED = bytes(
    c if c >= 128 or chr(c).isalpha() else 32 for c in range(256)
)
_PREDICTED = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])


def gram_counts(text: str) -> np.ndarray:
    """Counts of hashed byte pairs and triples."""
    data = text.lower().encode("utf-8", "surrogatepass").translate(_BLANKED)
    b = np.frombuffer(b" " + data + b" ", np.uint8).astype(np.uint32)
    pairs = b[:-1] << np.uint32(8) | b[1:]
    triples = pairs[:-1] << np.uint32(8) | b[2:] | np.uint32(1 << 24)
    grams = np.concatenate([pairs, triples])
    # Multiplicative hash onto 12 bits.
    places = grams * np.uint32(2654435769) >> np.uint32(20)
    return np.bincount(places, minlength=DIMENSIONS)


def has_letter(text: str) -> bool:
    """Whether a character is a letter, of the Unicode categories L."""
    return any(found.group().isalpha() for found in _LETTER.finditer(text))


def _unit(counts: np.ndarray) -> np.ndarray:
    x = counts.astype(np.float32)
    return x / max(float(np.sqrt(x @ x)), 1e-9)


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 150) -> np.ndarray:
    """Weights and intercept (last) of a linear machine with squared hinge loss, by
    accelerated gradient descent; ``y`` is +1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    weight = np.where(y > 0, 1 / max((y > 0).sum(), 1), 1 / max((y < 0).sum(), 1)) * cost
    # Rows have length at most sqrt(2), which bounds the curvature.
    step = 1 / (1 + 4 * weight.sum())
    w = ahead = np.zeros(x.shape[1], np.float32)
    for t in range(rounds):
        lack = np.maximum(0, 1 - y * (x @ ahead))
        gradient = ahead - 2 * x.T @ (weight * lack * y).astype(np.float32)
        new = ahead - np.float32(step) * gradient
        ahead = new + np.float32(t / (t + 3)) * (new - w)
        w = new
    return w


@dataclass(frozen=True)
class Model:
    """Stacked machines: one per family, then one per pair of languages of a family; the mean
    direction of every language that has enough documents, over its documents' median cosine."""

    families: tuple[tuple[str, ...], ...]
    pairs: tuple[tuple[str, str], ...]
    weights: np.ndarray
    centres: Mapping[str, np.ndarray]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.families or not has_letter(text):
            return UNKNOWN, 0.0
        x = _unit(gram_counts(text))
        margins = self.weights[:, :-1] @ x + self.weights[:, -1]
        heads = margins[: len(self.families)]
        chosen = int(np.argmax(heads))
        score = 1.0
        if len(heads) > 1:
            rest = np.delete(heads, chosen).max()
            score = _sure(heads[chosen] - rest)
        members = self.families[chosen]
        votes = dict.fromkeys(members, 0)
        sums = dict.fromkeys(members, 0.0)
        least = {m: 1.0 for m in members}
        for (a, b), margin in zip(self.pairs, margins[len(self.families) :].tolist()):
            if a in votes:
                votes[a if margin >= 0 else b] += 1
                sums[a] += margin
                sums[b] -= margin
                least[a] = min(least[a], _sure(2 * margin))
                least[b] = min(least[b], _sure(-2 * margin))
        best = min(members, key=lambda m: (-votes[m], -sums[m], m))
        if best in self.centres:
            score *= min(1.0, max(0.0, (float(self.centres[best] @ x) - FAR) / (NEAR - FAR)))
        return best, score * least[best]


def _sure(difference: float) -> float:
    """0 for equal margins, towards 1 the further the first is above the second."""
    return float(np.tanh(max(0.0, difference)))


def _centre(x: np.ndarray) -> np.ndarray | None:
    """Mean direction of rows of unit length over the median cosine of a row with the mean of
    the others; None if there are too few rows to tell."""
    if len(x) < LEAST_ROWS:
        return None
    total = x.sum(axis=0)
    others = total - x
    cosines = (others * x).sum(axis=1) / np.maximum(np.linalg.norm(others, axis=1), 1e-9)
    return total / max(float(np.linalg.norm(total) * np.median(cosines)), 1e-9)


def fit(counts: np.ndarray, langs: list[str], families: Mapping[str, tuple[str, ...]] = FAMILIES) -> Model:
    """Machines from feature counts (a row per document) and their languages."""
    family_of = {lang: name for name, members in families.items() for lang in members}
    known = sorted(set(langs))
    names = sorted({family_of.get(lang, lang) for lang in known})
    members = tuple(
        tuple(lang for lang in known if family_of.get(lang, lang) == name) for name in names
    )
    x = np.stack([_unit(c) for c in counts]) if len(counts) else np.zeros((0, DIMENSIONS), np.float32)
    of = np.array(langs, dtype=object)
    rows = []
    for group in members:
        rows.append(fit_svm(x, np.where(np.isin(of, group), 1, -1)) if len(members) > 1 else np.zeros(DIMENSIONS + 1))
    pairs = tuple(p for group in members for p in itertools.combinations(group, 2))
    for a, b in pairs:
        own = (of == a) | (of == b)
        rows.append(fit_svm(x[own], np.where(of[own] == a, 1, -1)))
    weights = np.array(rows, np.float32).reshape(len(rows), DIMENSIONS + 1)
    centres = {lang: centre for lang in known if (centre := _centre(x[of == lang])) is not None}
    return Model(members, pairs, weights, centres)


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          per_language: int = PER_LANGUAGE) -> Model:
    """Fit on at most ``per_language`` labelled documents of each language."""
    labelled = docs.select(
        F.col(key).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")
    ).where("lang is not null and id is not null").withColumn("mark", F.xxhash64("text"))
    # One row a key, found by partial minima in every task.
    one = labelled.groupBy("id").agg(F.min(F.struct("mark", "lang")).alias("row"))
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = (
        one.select("id", "row.mark", "row.lang")
        .withColumn("place", F.row_number().over(by_hash))
        .where(F.col("place") <= per_language)
        .select("id", "mark", "lang")
        .collect()
    )
    if not chosen:
        return fit(np.zeros((0, DIMENSIONS)), [])
    # A bounded list of keys, so sending it to every executor is safe.
    row = ["id", "mark", "lang"]
    keys = docs.sparkSession.createDataFrame([tuple(r) for r in chosen], labelled.select(*row).schema)
    sample = labelled.join(F.broadcast(keys), row)
    schema = StructType([
        *labelled.select(*row).schema,
        StructField("places", ArrayType(IntegerType())),
        StructField("counts", ArrayType(IntegerType())),
    ])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in batches:
            batch = first_of_each(batch, row, seen)
            dense = [gram_counts(t) for part in few_texts(batch.column("text")) for t in part]
            places = [np.flatnonzero(d) for d in dense]
            yield pa.RecordBatch.from_arrays([
                *map(batch.column, row),
                pa.array(places, pa.list_(pa.int32())),
                pa.array([d[p] for d, p in zip(dense, places)], pa.list_(pa.int32())),
            ], schema.names)

    found = sample.select(*row, "text").mapInArrow(count, schema).dropDuplicates(row)
    rows = sorted(found.select("lang", "places", "counts").collect())
    counts = np.zeros((len(rows), DIMENSIONS), np.float32)
    for i, row in enumerate(rows):
        counts[i, row["places"]] = row["counts"]
    return fit(counts, [row["lang"] for row in rows])


def predicted(model: Model, text: Column) -> Column:
    """Struct of ``lang_pred`` and ``score`` of a text column."""

    @arrow_udf(_PREDICTED)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [model.predict(t) for part in few_texts(batch) for t in part]
            yield pa.StructArray.from_arrays([
                pa.array([lang for lang, _ in found], pa.string()),
                pa.array([score for _, score in found], pa.float64()),
            ], _PREDICTED.names)

    return of(text)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with columns ``lang_pred`` and ``score``, which replace such columns."""
    found = docs.withColumn("lang_pred", predicted(model, F.col(text)))
    return found.withColumn("score", F.col("lang_pred")["score"]).withColumn(
        "lang_pred", F.col("lang_pred")["lang_pred"]
    )
