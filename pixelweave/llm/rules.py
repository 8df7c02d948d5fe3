"""Quality rules by weak supervision (operator 10).

Rules vote good or bad on every document or abstain. How often each rule is right is not
set by hand: expectation-maximisation over the votes of the whole corpus estimates the
rules' accuracies on good and on bad documents and the share of good ones, and a
document's posterior probability of being good replaces a filter that all rules must pass.

The corpus is read once for the votes. What EM needs of it is the number of documents per
combination of votes, which Spark counts with partial aggregation; the number of
combinations is bounded by 3 to the number of rules and not by the corpus. The fitted model
is a few numbers per rule, applied in the scan of the documents.

Defined cases: a null text has no words; an empty text has counts of zero and fails the
base check; a very long text is one string and its words in one task; repeated rows vote once
each; a posterior of exactly the least one is kept; an empty table gives an empty result; a
null id is kept as null; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from pixelweave.llm.text import SPACES, few_texts, words_of

# Fixed values of the base check.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

_FEATURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "n_closed_lines", "top_word", "longest_run", "n_marks", "n_upper",
)
_MARKS = ".,;:!?-()\"'"
# ASCII and Latin-1 capitals.
_UPPER = re.compile("[A-Z\u00c0-\u00d6\u00d8-\u00de]")


def repeated_words(words: list) -> int:
    """Words covered by windows of three words that occur at least twice in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, end = 0, 0
    for start, window in enumerate(windows):
        if counts[window] > 1:
            covered += start + 3 - max(start, end)
            end = start + 3
    return covered


def _longest_run(words: list) -> int:
    best = run = 1 if words else 0
    for before, word in zip(words, words[1:]):
        run = run + 1 if word == before else 1
        if run > best:
            best = run
    return best


def describe(text: str) -> tuple[int, ...]:
    """Counts of one text, in the order of the feature columns."""
    words = words_of(text)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    n = len(words)
    return (
        n,
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        sum(x.rstrip(SPACES).endswith((".", "?", "!", '"', ":")) for x in lines),
        max(Counter(words).values(), default=0),
        _longest_run(words),
        sum(map(text.count, _MARKS)),
        len(_UPPER.findall(text)),
    )


def _counts(batch: pa.Array) -> dict[str, np.ndarray]:
    rows = [describe(t) for part in few_texts(batch) for t in part]
    table = np.array(rows, np.int64).reshape(len(rows), len(_FEATURES))
    return dict(zip(_FEATURES, table.T))


@dataclass(frozen=True)
class Rule:
    """A ratio of two counts: bad beyond ``bad``, good within ``good``, else no vote.

    With ``low`` the small values are the bad ones. Without a denominator the rule abstains.
    ``kind`` names the sort of bad document that the rule is meant to find.
    """

    name: str
    kind: str
    over: str
    per: str
    good: float
    bad: float
    low: bool = False

    def vote(self, counts: dict[str, np.ndarray]) -> np.ndarray:
        """2 good, 1 bad, 0 abstains."""
        x = counts[self.over].astype(float)
        if self.per != "1":
            per = counts[self.per]
            x = np.divide(x, per, out=np.full(len(x), np.nan), where=per > 0)
        is_bad = x < self.bad if self.low else x > self.bad
        is_good = x >= self.good if self.low else x <= self.good
        return np.where(is_bad, 1, np.where(is_good, 2, 0))


# The thresholds are those of common web-text filters, with a neutral band between them.
RULES = (
    Rule("enough words", "form", "n_words", "1", 80, LEAST_WORDS, low=True),
    Rule("words not too long", "form", "word_chars", "n_words", 9, 12),
    Rule("words not too short", "form", "word_chars", "n_words", 3.5, 2.5, low=True),
    Rule("lines end as sentences", "form", "n_closed_lines", "n_lines", 0.6, 0.2, low=True),
    Rule("few symbols", "noise", "n_symbols", "n_words", 0.02, 0.1),
    Rule("few marks", "noise", "n_marks", "n_words", 0.35, 0.8),
    Rule("little shouting", "noise", "n_upper", "word_chars", 0.1, 0.3),
    Rule("few repeated lines", "repetition", "n_dup_lines", "n_lines", 0.1, 0.3),
    Rule("few repeated passages", "repetition", "n_repeat_words", "n_words", 0.3, 0.5),
    Rule("no word dominates", "repetition", "top_word", "n_words", 0.2, 0.3),
    Rule("no word in a row", "repetition", "longest_run", "1", 3, 8),
)

# Start of the estimation: share of good documents; how often a rule votes bad on a good
# document, on one of its own kind of bad ones and on one of another kind; and the weight
# of that start in documents.
_SHARE, _ON_GOOD, _ON_OWN, _ON_OTHER, _PSEUDO = 0.85, 0.001, 0.5, 0.02, 10.0
# Weight of the start for good documents, as a share of the corpus: a Beta prior of the rules'
# errors there. It grows with the corpus, as a document that breaks one rule only looks the same
# whether it is bad or the rule errs, however many documents there are.
PRIOR = 0.5


@dataclass(frozen=True)
class Model:
    """Share of every class of documents, the good ones first, and by class and rule the
    probability that a vote says bad: one less the accuracy on good documents, the accuracy
    on bad ones."""

    shares: np.ndarray
    says_bad: np.ndarray


def estimate(votes: np.ndarray, counts: np.ndarray, rules: tuple[Rule, ...] = RULES,
             prior: float = PRIOR, rounds: int = 500) -> Model:
    """Expectation-maximisation over distinct vote vectors and their document counts.

    The classes are the good documents and one class for each kind of bad ones, as a
    document that shouts and one that repeats itself have little in common. It starts from
    what a filter is written for: good documents hardly ever break it, and a bad document
    breaks some of the rules of its kind. Pseudo-counts of that start keep every
    probability inside (0, 1), so few or no rows give a defined model. On good documents they
    weigh ``prior`` of the corpus: the larger, the more it takes to learn that a rule misfires.
    """
    kinds = list(dict.fromkeys(rule.kind for rule in rules))
    start = np.array([[_ON_GOOD] * len(rules)] + [
        [_ON_OWN if rule.kind == kind else _ON_OTHER for rule in rules] for kind in kinds
    ])
    start_shares = np.array([_SHARE] + [(1 - _SHARE) / len(kinds)] * len(kinds))
    weights = np.full((len(start), 1), _PSEUDO)
    weights[0] += prior * counts.sum()
    model = Model(start_shares, start)
    is_good, is_bad = votes == 2, votes == 1
    voted = is_good | is_bad
    for _ in range(rounds):
        score = (
            np.log(model.shares)
            + is_bad @ np.log(model.says_bad).T
            + is_good @ np.log1p(-model.says_bad).T
        )
        score = np.exp(score - score.max(axis=1, keepdims=True, initial=-np.inf))
        weight = counts[:, None] * score / score.sum(axis=1, keepdims=True)
        shares = (weight.sum(axis=0) + _PSEUDO * start_shares) / (counts.sum() + _PSEUDO)
        says_bad = (weight.T @ is_bad + weights * start) / (weight.T @ voted + weights)
        moved = np.abs(says_bad - model.says_bad).max()
        model = Model(shares, says_bad)
        if moved < 1e-9:
            break
    return model


def _votes(counts: dict[str, np.ndarray], rules: tuple[Rule, ...]) -> np.ndarray:
    return np.stack([rule.vote(counts) for rule in rules], axis=1)


def posterior(model: Model, votes: np.ndarray) -> np.ndarray:
    """Probability that documents with these votes are good."""
    score = (
        np.log(model.shares)
        + (votes == 1) @ np.log(model.says_bad).T
        + (votes == 2) @ np.log1p(-model.says_bad).T
    )
    weight = np.exp(score - score.max(axis=1, keepdims=True, initial=-np.inf))
    return weight[:, 0] / weight.sum(axis=1)


def fit(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES,
        prior: float = PRIOR) -> Model:
    """Accuracies from the votes on every document."""

    @arrow_udf(LongType())
    def ballot(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        """All votes of a document as one number in base 3."""
        for batch in batches:
            yield pa.array(_votes(_counts(batch), rules) @ 3 ** np.arange(len(rules)), pa.int64())

    # At most 3 ** len(rules) rows, however large the corpus.
    table = docs.select(ballot(F.col(text)).alias("ballot")).groupBy("ballot").count()
    rows = np.array(sorted(map(tuple, table.collect())), np.int64).reshape(-1, 2)
    votes = rows[:, :1] // 3 ** np.arange(len(rules)) % 3
    return estimate(votes, rows[:, 1], rules, prior)


def judged(model: Model, text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct of a text's counts and its ``quality``, the posterior of being good."""
    schema = StructType([*(StructField(c, LongType()) for c in _FEATURES), StructField("quality", DoubleType())])

    @arrow_udf(schema)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            counts = _counts(batch)
            quality = posterior(model, _votes(counts, rules))
            arrays = [*(pa.array(counts[c], pa.int64()) for c in _FEATURES), pa.array(quality)]
            yield pa.StructArray.from_arrays(arrays, schema.names)

    return of(text)


def base_failed(f: Column) -> Column:
    return (f["n_words"] < LEAST_WORDS) | (
        100 * f["n_repeat_words"] > MOST_REPEATED_PERCENT * f["n_words"]
    )


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES,
          least: float = 0.5, prior: float = PRIOR) -> DataFrame:
    """``docs`` with columns ``f`` (counts), ``quality`` (posterior), ``base_failed`` and
    ``kept`` (posterior at least ``least`` and base check passed); columns of these names
    are replaced."""
    model = fit(docs, text, rules, prior)
    return (
        docs.withColumn("f", judged(model, F.col(text), rules))
        .withColumn("quality", F.col("f")["quality"])
        .withColumn("base_failed", base_failed(F.col("f")))
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
    )
