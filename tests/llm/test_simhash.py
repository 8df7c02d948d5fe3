"""SimHash near-duplicates against a comparison of all pairs."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pixelweave.llm import simhash


def slow_fingerprint(text, shingle=4):
    words = (text or "").encode().lower().split()
    spans = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in spans]
    return sum((2 * sum(h >> bit & 1 for h in hashes) > len(hashes)) << bit for bit in range(64))


def slow_components(ids, fps, budget):
    fps = np.array(fps, np.uint64)
    label = np.arange(len(ids))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= budget
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            break
        label = new
    smallest = {}
    for i, x in zip(ids, label):
        if i is not None:
            smallest[x] = min(i, smallest.get(x, i))
    return [smallest.get(x) for x in label]


TEXTS = [
    "", None, "  \t ", "a", "A", "one two three", "One two three", "ä Ä x y z", "ä ä x y z",
    "a b c d e f g " * 30, "a b c d e f g " * 29, "x y\x1cz w", "word " * 5000,
]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint(text or "") % 2**64 == slow_fingerprint(text)


def test_documents_against_all_pairs(spark):
    base = ["the quick brown fox jumps over the lazy dog again and again " * 8]
    texts = TEXTS + base * 5 + [base[0].replace("lazy", w, 1) for w in "abcdefgh"]
    rows = [(None if i == 3 else 100 - i, t, "clash", 1.0) for i, t in enumerate(texts)]
    rows += rows[:4]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id double")
    got = simhash.near_duplicates(docs).toPandas()
    ids, fps = [r[0] for r in rows], [slow_fingerprint(r[1]) for r in rows]
    want = sorted(zip(ids, fps, slow_components(ids, fps, 4)), key=str)
    have = sorted(
        (
            (None if i != i else int(i), int(f) % 2**64, None if c != c else int(c))
            for i, f, c in zip(got["doc_id"], got["fp"], got["component_id"])
        ),
        key=str,
    )
    assert have == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).collect() == []


@pytest.mark.parametrize("node, budget", [(8192, 4), (16, 4), (16, 3), (16, 0), (16, 1), (2, 6)])
def test_links_connect_as_all_pairs(spark, monkeypatch, node, budget):
    """Random fingerprints, chains, dense balls and a crowd under one prefix."""
    monkeypatch.setattr(simhash, "_NODE", node)
    rng = np.random.default_rng(node + budget)
    seeds = rng.integers(0, 2**64, 60, np.uint64)
    fps = list(seeds)
    for s in seeds[:20]:
        for _ in range(8):
            flips = rng.choice(64, rng.integers(1, 6), replace=False).astype(np.uint64)
            s = s ^ np.bitwise_or.reduce(np.uint64(1) << flips)
            fps.append(s)
    fps += [np.uint64(i) for i in range(64)]
    fps = sorted({int(x) for x in fps})
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    table = spark.createDataFrame([(x,) for x in signed], "fp long")
    edges = simhash.links(table, budget).collect()
    assert all((e["a"] ^ e["b"]) % 2**64 == 0 or bin((e["a"] ^ e["b"]) % 2**64).count("1") <= budget * len(fps) for e in edges)
    labels = {r["node"]: r["label"] for r in simhash.components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    want = slow_components(signed, fps, budget)
    assert [labels.get(x, x) for x in signed] == want


def test_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["label"] for r in simhash.components(edges).collect()} == {0}
