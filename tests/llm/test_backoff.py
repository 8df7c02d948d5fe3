"""Backed-off scores against plain counting."""

import math
from collections import Counter

import numpy as np
import pytest

from pixelweave.llm import backoff

SPACES = " \t\n\r\x0b\x0c"


def words_of(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    for space in SPACES:
        low = low.replace(space, " ")
    return [w for w in low.split(" ") if w]


def expected(rows):
    docs = [(key, words_of(text)) for key, text in rows]
    one = Counter(w for _, ws in docs for w in ws)
    two = Counter(p for _, ws in docs for p in zip(ws, ws[1:]))
    total, out = sum(one.values()), []
    for key, ws in docs:
        own, own2, logs = Counter(ws), Counter(zip(ws, ws[1:])), []
        others = max(total - len(ws), 1)
        for v, w in zip([None, *ws], ws):
            share = max(one[w] - own[w], 0.5) / others
            pair = two[v, w] - own2[v, w] if v is not None else 0
            if v is None:
                logs.append(math.log(share))
            else:
                logs.append(math.log(pair / (one[v] - own[v]) if pair > 0 else 0.4 * share))
        out.append((key, len(ws), round(sum(logs) / len(logs), 9) if logs else None))
    return sorted(out, key=str)


CASES = {
    "empty": [],
    "one": [(1, "a b a b c")],
    "odd": [(1, "A b\tc"), (2, "a B c d"), (3, None), (4, ""), (5, " \n"), (None, "c d ü Ü"), (7, "b c c c"), (7, "b c c c")],
    "copies": [(i, "the same words in the same order the same") for i in range(40)],
    "long": [(1, "x y z " * 30_000), (2, "x y z q")],
}


@pytest.mark.parametrize("case", sorted(CASES))
@pytest.mark.parametrize("block", [1, 4000])
def test_scores(spark, monkeypatch, case, block):
    monkeypatch.setattr(backoff, "BLOCK", block)
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in CASES[case]], "doc_id long, text string, gram string, n double")
    got = [(r["doc_id"], r["n_words"], None if r["score"] is None else round(r["score"], 9))
           for r in backoff.score(docs).collect()]
    assert sorted(got, key=str) == expected(CASES[case])


def test_ngrams_cross_the_network_once(spark):
    """The count table and its totals need no exchange beside that of the packed rows."""
    docs = spark.range(100).selectExpr("id as doc_id", "concat('a b ', id) as text")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = backoff.score(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exchanges = [line for line in plan.splitlines() if " Exchange " in line]
    assert len([x for x in exchanges if "hashpartitioning(bucket" in x]) == 1
    assert not [x for x in exchanges if "gram" in x]


def test_documents_are_scored_together(monkeypatch):
    """A block's documents take a few array operations together, not some each."""
    documents = [b"a b c"] * 1_000
    block = backoff._Block(documents, 8)
    calls, unique = [], np.unique
    monkeypatch.setattr(np, "unique", lambda *a, **b: calls.append(1) or unique(*a, **b))
    found = backoff._scores(block, block.counts, 3_000)
    assert len(set(found)) == 1 and len(found) == 1_000
    assert len(calls) <= 20
