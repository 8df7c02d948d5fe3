"""Quality rules: counts against plain loops, estimation on planted accuracies, edge cases."""

import re
from collections import defaultdict

import numpy as np
import pytest
from conftest import MEDIUM

from pixelweave.llm import rules

TEXTS = [
    "", " \n\t", "a", "a b c a b c", "a a a a", "x y z\nx y z\n\n \nx y z", "one two three four one two three",
    "tab\there\x0bvt\x0cff\rcr\x1cfs\x85nel\xa0nbsp", "#*$%&|<> # ü€😀 word", "the end. " * 60, "Ä É Z! " * 40,
    " ".join(f"w{i}" for i in range(300)), "long " * 20_000,
]


def slow_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    places = defaultdict(list)
    for i, window in enumerate(windows):
        places[window].append(i)
    covered = {i + j for same in places.values() if len(same) > 1 for i in same for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


@pytest.mark.parametrize("text", TEXTS)
def test_counts(text):
    assert rules.describe(text)[:5] == slow_counts(text)


def test_counts_on_real_texts(spark):
    for row in spark.read.parquet(f"{MEDIUM}/documents.parquet").limit(150).collect():
        assert rules.describe(row["text"])[:5] == slow_counts(row["text"])


def test_estimation_finds_planted_accuracies():
    rng = np.random.default_rng(1)
    n, kinds = 40_000, ["form", "noise", "repetition"]
    bad_kind = rng.choice(["", *kinds], n, p=[0.8, 0.05, 0.07, 0.08])
    votes = np.zeros((n, len(rules.RULES)), int)
    for i, rule in enumerate(rules.RULES):
        says_bad = rng.random(n) < np.where(bad_kind == rule.kind, 0.7, 0.001)
        votes[:, i] = np.where(rng.random(n) < 0.1, 0, np.where(says_bad, 1, 2))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = rules.estimate(patterns, counts)
    assert abs(model.shares[0] - 0.8) < 0.03
    assert np.abs(model.says_bad[0] - 0.001).max() < 0.001
    good = rules.posterior(model, votes) >= 0.5
    assert (good == (bad_kind == "")).mean() > 0.96


@pytest.mark.parametrize("errs,prior", [(0.02, rules.PRIOR), (0.05, rules.PRIOR), (0.15, 0.0), (0.3, 0.0)])
def test_a_rule_that_misfires_on_good_documents_is_learned(errs, prior):
    rng = np.random.default_rng(3)
    n, kinds = 20_000, ["form", "noise", "repetition"]
    bad_kind = rng.choice(["", *kinds], n, p=[0.85, 0.05, 0.05, 0.05])
    says_bad = np.stack([
        rng.random(n) < np.where(bad_kind == "", 0.001, np.where(bad_kind == rule.kind, 0.5, 0.02))
        for rule in rules.RULES
    ], axis=1)
    good = bad_kind == ""
    wrong = [rule.name for rule in rules.RULES].index("lines end as sentences")
    says_bad[good, wrong] = rng.random(good.sum()) < errs
    votes = np.where(says_bad, 1, 2)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = rules.estimate(patterns, counts, prior=prior)
    others = np.delete(model.says_bad[0], wrong)
    # The prior draws an estimate towards its start by about a third.
    assert model.says_bad[0, wrong] > errs / 3 and others.max() < errs / 4
    kept = rules.posterior(model, votes) >= 0.5
    assert kept[good].mean() > 0.98 and kept[~good].mean() < 0.12


@pytest.mark.parametrize("n", [0, 1])
def test_few_rows_give_a_defined_model(n):
    model = rules.estimate(np.full((n, len(rules.RULES)), 2), np.full(n, 3))
    assert np.isfinite(model.says_bad).all() and ((0 < model.says_bad) & (model.says_bad < 1)).all()


def test_edge_rows(spark):
    rows = [(i, t, "f", 0.5) for i, t in enumerate([*TEXTS, None, TEXTS[-1]])] + [(None, "x", "f", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, f string, quality double")
    got = rules.judge(docs).collect()
    assert len(got) == len(rows)
    for row in got:
        counts = slow_counts(row["text"] or "")
        assert tuple(row["f"][:5]) == counts
        assert row["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert 0 <= row["quality"] <= 1 and (not row["kept"] or not row["base_failed"])
    empty = rules.judge(docs.limit(0))
    assert empty.collect() == []


def test_against_labels(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").selectExpr("doc_id", "quality as label")
    rows = rules.judge(docs).join(labels, "doc_id").collect()
    assert not [r for r in rows if r["label"] == 0 and r["kept"]]
    clean = [r for r in rows if r["label"] == 1 and not r["base_failed"]]
    assert sum(r["kept"] for r in clean) >= 0.98 * len(clean)
