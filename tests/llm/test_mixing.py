"""Hierarchical budgets against a plain recursion, and the prefixes that leaves take."""

import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from pixelweave.llm import mixing

LEVELS = "doc_id long, domain string, lang string, source string, tokens long, epoch string, taken int"


def fill(budget, children):
    """Exact shares {name: tokens} of children {name: (weight, holds)} by repeated saturation."""
    budget = min(budget, sum(h for _, h in children.values()))
    open_, given = dict(children), {}
    while open_:
        total = sum(w for w, _ in open_.values())
        full = {n: h for n, (w, h) in open_.items() if h * total <= w * budget}
        if not full:
            break
        for n, h in full.items():
            given[n] = Fraction(h)
            budget -= h
            del open_[n]
    total = sum(w for w, _ in open_.values())
    return given | {n: Fraction(w * budget, total) for n, (w, _) in open_.items()}


def run(spark, rows, targets, budget, epochs):
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], LEVELS)
    return mixing.mix(docs, targets, budget, max_epochs=epochs, seed=3).collect()


@pytest.mark.parametrize("seed", range(4))
def test_budgets_and_prefixes(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        source = 0 if rng.random() < 0.4 else rng.randrange(9)
        rows.append((i, f"d{source % 3}", rng.choice(["en", "en", "de", None]), f"s{source}", rng.choice([0, 1, 5, 90, None, 300])))
    targets = mixing.Targets(domain={"d0": 5, "d2": 2}, lang={"de": 4, "none": 2}, source={"s3": 7})
    held = sum(r[4] or 0 for r in rows)
    share, epochs = [(3, 1), (5, 2), (9, 1), (25, 2)][seed]
    taken = run(spark, rows, targets, F.sum("held") * share / 10, epochs)
    budget = held * share // 10

    tokens = defaultdict(int)
    for _, d, l, s, n in rows:
        tokens[d, l or "none", s] += n or 0
    got = defaultdict(int)
    for r in taken:
        got[r["domain"], r["lang"], r["source"]] += r["taken"]
    assert sum(got.values()) == min(budget, held * epochs)

    def subtree(prefix):
        return sum(epochs * n for leaf, n in tokens.items() if leaf[: len(prefix)] == prefix)

    def check(prefix, budget):
        level = len(prefix)
        if level == 3:
            assert abs(got[prefix] - budget) <= 3
            return
        names = {leaf[level] for leaf in tokens if leaf[:level] == prefix and subtree(leaf[: level + 1])}
        weights = (targets.domain, targets.lang, targets.source)[level]
        children = {n: (weights.get(n, 1), subtree((*prefix, n))) for n in names}
        for name, part in fill(budget, children).items():
            check((*prefix, name), part)

    check((), Fraction(budget))

    by_leaf = defaultdict(list)
    for r in taken:
        by_leaf[r["domain"], r["lang"], r["source"]].append(r)
    for leaf, chosen in by_leaf.items():
        members = {r[0]: r[4] or 0 for r in rows if (r[1], r[2] or "none", r[3]) == leaf}
        last = max(r["epoch"] for r in chosen)
        for epoch in range(last):
            assert {r["doc_id"]: r["taken"] for r in chosen if r["epoch"] == epoch} == members
        final = {r["doc_id"]: r["taken"] for r in chosen if r["epoch"] == last}
        cut = [i for i, n in final.items() if n < members[i]]
        assert len(cut) <= 1 and len({(r["doc_id"], r["epoch"]) for r in chosen}) == len(chosen)


def test_orders_differ_between_epochs_and_seeds(spark):
    rows = [(i, "d", "en", "s", 10) for i in range(200)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], LEVELS)

    def ids(seed, budget):
        found = mixing.mix(docs, mixing.Targets(), F.lit(budget) + 0 * F.sum("held"), 3, seed).collect()
        last = max(r["epoch"] for r in found)
        return {r["doc_id"] for r in found if r["epoch"] == last}

    first, again, other, second = ids(1, 500), ids(1, 500), ids(2, 500), ids(1, 2500)
    assert first == again and len(first) == 50
    assert first != other and first != second


def test_edges(spark):
    assert run(spark, [], mixing.Targets(), F.sum("held"), 1) == []
    rows = [(1, "d", "en", "s", 7), (1, "d", "en", "s", 7), (None, "d", "en", None, 5), (2, None, None, None, None)]
    got = run(spark, rows, mixing.Targets(), F.sum("held"), 1)
    assert sorted((r["doc_id"] or 0, r["taken"]) for r in got) == [(0, 5), (1, 7), (1, 7)]
    assert run(spark, rows, mixing.Targets(domain={"d": 0}), F.sum("held"), 1) == []
