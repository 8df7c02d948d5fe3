"""Re-Pair shards: exact round trips, random access and the contract's columns."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import MEDIUM
from tokenizers import Tokenizer

from pixelweave.llm import grammar

PATH = public_tokenizers.path("word_bpe_49k.json")


def documents(kind, rng):
    if kind == "one id":
        return [[2]]
    if kind == "runs":
        return [[7] * n + [2] for n in range(1, 200)]
    if kind == "ends only":
        return [[2]] * 500
    words = rng.integers(3, 30, (50, 4)).tolist()
    return [sum((words[i] for i in rng.integers(0, 50, n)), []) + [2] for n in rng.integers(0, 400, 60)]


@pytest.mark.parametrize("kind", ["one id", "runs", "ends only", "phrases"])
def test_round_trip_and_slices(kind):
    rng = np.random.default_rng(3)
    docs = documents(kind, rng)
    shard = grammar.Shard.of(list(range(len(docs))), [np.array(d, "<u4").tobytes() for d in docs])
    back = grammar.Shard.from_bytes(shard.to_bytes())
    flat = np.concatenate(docs)
    assert (back.ids() == flat).all()
    assert (back.id_ends() == np.cumsum([len(d) for d in docs])).all()
    if kind == "phrases":
        assert len(back.rules) and len(back.symbols) < 0.6 * len(flat)
        assert back.lengths.max() > 2
    for _ in range(50):
        a, b = sorted(rng.integers(0, len(flat) + 1, 2))
        assert (back.slice(a, b) == flat[a:b]).all()


def test_passes_go_on_while_pairs_are_frequent():
    """A passage of 1,000 ids in many documents ends as a few symbols a document."""
    rng = np.random.default_rng(6)
    passage = rng.integers(3, 40_000, 1000).tolist()
    docs = [[int(rng.integers(3, 40_000)), *passage, 2] for _ in range(980)]
    shard = grammar.Shard.of([0] * len(docs), [np.array(d, "<u4").tobytes() for d in docs])
    assert len(shard.symbols) <= 3 * len(docs)
    codes = shard.symbols[:-1].astype(np.uint64) << np.uint64(32) | shard.symbols[1:]
    inside = np.ones(len(codes), bool)
    inside[shard.ends[:-1] - 1] = False
    assert np.unique(codes[inside], return_counts=True)[1].max() < grammar.LEAST
    assert (shard.ids() == np.concatenate(docs)).all()


def test_no_pair_is_left_on_real_texts(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").orderBy("doc_id").collect()]
    documents = [ids + b"\x02\0\0\0" for ids in grammar.Encoder(PATH).encode(texts)]
    shard = grammar.Shard.of(list(range(len(documents))), documents)
    at = np.flatnonzero(~np.isin(np.arange(1, len(shard.symbols)), shard.ends))
    pairs = np.stack([shard.symbols[at], shard.symbols[at + 1]], 1)
    pairs, counts = np.unique(pairs, axis=0, return_counts=True)
    # A pair of one symbol with itself is replaced every second time only.
    assert counts[pairs[:, 0] != pairs[:, 1]].max() < grammar.LEAST
    assert (shard.ids() == np.frombuffer(b"".join(documents), "<u4")).all()


def test_hot_keys_are_dealt_to_many_tasks(spark, tmp_path):
    rows = [(None if i % 2 else 7, f"text number {i} of many") for i in range(3000)] + [(9, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = grammar.write(docs, PATH, f"{tmp_path}/out").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(r["documents"] for r in index) < 1000
    read = grammar.read(spark.createDataFrame(index, grammar._INDEX)).collect()
    assert len(read) == 3001 and sum(r["doc_id"] is None for r in read) == 1500


def test_no_rule_spans_documents():
    docs = [[5, 6, 2], [5, 6, 2]] * 100
    shard = grammar.Shard.of([0] * len(docs), [np.array(d, "<u4").tobytes() for d in docs])
    for rule in range(len(shard.rules)):
        ids = grammar.expand(np.array([shard.first + rule]), shard.rules, shard.lengths, shard.first)
        assert 2 not in ids[:-1]


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    out, start = [], 0
    for key, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_against_the_library(spark, tmp_path):
    rows = [(5, "b b"), (None, "x"), (3, None), (9, ""), (4, "long text, " * 3000), (8, "A\tb\n c")]
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, start int")
    index = grammar.write(docs, PATH, f"file://{tmp_path}/out", shard_ids=50)
    got = sorted((tuple(r) for r in grammar.read(index).collect()), key=lambda r: r[1])
    assert got == expected(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)))


def test_corpus(spark, tmp_path):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    index = grammar.write(docs.repartition(5), PATH, f"{tmp_path}/out", shard_ids=100_000)
    assert index.count() > 3
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    assert sorted((tuple(r) for r in grammar.read(index).collect()), key=lambda r: r[1]) == expected(rows)


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert grammar.read(grammar.write(docs, PATH, f"{tmp_path}/out")).collect() == []
