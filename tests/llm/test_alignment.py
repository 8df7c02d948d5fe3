"""Alignment of two tokenizers against the libraries on whole texts and plain counting."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from conftest import SMALL
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from pixelweave.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    "Hello world", "", None, " ", "  two  blanks ", "line\nline", "\nfirst", "last\n", "a \n b\n\nc", "tab\tx \t y",
    "naïve Ünïcödé 😀 漢字かな", "▁x", "a ▁b", "<s> </s> <0x0A> <|endoftext|> <unk>", "\xa0x　y \x1cz",
    "word word word", "it's we'll they've 'tis", "x" * 500, "12345 67 8,90", "\r\nwin\r\n", "a\x00b", "the " * 50,
    "don't\nstop", "é" * 40, "﻿bom", "...!!! ??", "é é", "   ", "\n\n\n", "Hello world",
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    byte = alignment.byte_level()
    spelt_a = lambda i: bytes(byte[c] for c in a.id_to_token(i))
    spelt_b = lambda i: alignment.piece_bytes(b.id_to_piece(i), b.is_byte(i))
    return a, b, spelt_a, spelt_b


def slow_groups(text, libraries):
    """Groups by the sets of ends over the whole text, or None."""
    a, b, spelt_a, spelt_b = libraries
    if not text:
        return None
    ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    spelt = [[spelt_a(i) for i in ids[0]], [spelt_b(i) for i in ids[1]]]
    raw = (" " + text).encode()
    if b"".join(spelt[0]) != raw or b"".join(spelt[1]) != raw:
        return None
    ends = []
    for parts in spelt:
        at, found = 0, []
        for part in parts:
            at += len(part)
            found.append(at)
        ends.append(found)
    common = sorted(set(ends[0]) & set(ends[1]))
    out = [([], []) for _ in common]
    for side in (0, 1):
        g = 0
        for i, end in zip(ids[side], ends[side]):
            out[g][side].append(i)
            g += end == common[g]
    return out


def slow(texts, libraries):
    found = [slow_groups(t, libraries) for t in texts]
    count = Counter()
    links = []
    for groups in found:
        mine = Counter((x, y) for a, b in groups or [] for x in a for y in b)
        links.append(mine)
        count.update(mine.keys())
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    rows = []
    for groups, mine in zip(found, links):
        written = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups or [])
        rows.append((
            sum(len(a) for a, _ in groups or []), sum(len(b) for _, b in groups or []), len(groups or []),
            sum(mine.values()), sum(n for p, n in mine.items() if count[p] == most[p[0]]),
            sum(n * count[p] for p, n in mine.items()),
            hashlib.sha256(written.encode()).hexdigest() if groups else "",
        ))
    return rows


def aligned(spark, texts):
    rows = [(i, t, "x", 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string, n_a int")
    got = alignment.align(docs, A, B).collect()
    return [tuple(r)[1:] for r in sorted(got, key=lambda r: r["doc_id"])]


def test_edge_texts(spark, any_plan, libraries):
    assert aligned(spark, TEXTS) == slow(TEXTS, libraries)


def test_real_texts(spark, libraries):
    texts = [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()]
    assert aligned(spark, texts) == slow(texts, libraries)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab .'\n\t1\xe9漢▁\xa0\U0001f600", min_size=1, max_size=30), min_size=1, max_size=5))
def test_parts_align_as_the_whole(libraries, texts):
    aligner = alignment.Aligner(A, B)
    block = alignment.Block(5)
    block.add(aligner, list(range(len(texts))), texts)
    for row, digest, want in zip(block.sums[0], block.digests, slow(texts, libraries)):
        assert (*row[:4], digest) == (*want[:4], want[6])


def test_portions_and_blocks(spark, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "PORTION", 40)
    long = "one two three\nfour five  six seven " * 20
    for texts in ([long, "x", long], [long + " ▁", long]):
        block = alignment.Block(4)
        block.add(alignment.Aligner(A, B), list(range(len(texts))), texts)
        for row, digest, want in zip(block.sums[0], block.digests, slow(texts, libraries)):
            assert (*row[:4], digest) == (*want[:4], want[6])


def test_small_cache(libraries, monkeypatch):
    monkeypatch.setattr(alignment, "CACHED_CHARS", 20)
    aligner, texts = alignment.Aligner(A, B), [t for t in TEXTS if t]
    for _ in range(2):
        block = alignment.Block(4)
        for i, t in enumerate(texts):
            block.add(aligner, [i], [t])
        assert [(*r[0][:4], d) for r, d in zip(block.sums, block.digests)] == [
            (*w[:4], w[6]) for w in slow(texts, libraries)
        ]


def test_merge_counts_and_finds_the_highest():
    import numpy as np

    runs = [{(1, 2): 3, (1, 5): 1, (7, 0): 2}, {(1, 5): 4, (9, 1): 1}, {(1, 2): 1, (1, 9): 5, (7, 0): 1}]
    packed = []
    for run in runs:
        codes = np.array([a << 15 | b for a, b in sorted(run)])
        held = np.array([run[p] for p in sorted(run)])
        packed.append(alignment._packed(np.diff(codes, prepend=0).astype("<u4"), held.astype("<u4")))
    total = Counter()
    for run in runs:
        total.update(run)
    for run, data in zip(runs, alignment.merge(packed)):
        data = alignment._unpacked(data)
        n = len(data) // 9
        assert np.frombuffer(data, "<i8", n).tolist() == [total[p] for p in sorted(run)]
        most = [max(v for (a, _), v in total.items() if a == p[0]) for p in sorted(run)]
        assert np.frombuffer(data, "u1", n, 8 * n).tolist() == [total[p] == m for p, m in zip(sorted(run), most)]


def test_null_and_repeated_keys(spark):
    rows = [(None, "the cat", 1), (None, "the cat", 1), (3, "the cat", 1), (3, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int")
    got = sorted(alignment.align(docs, A, B).collect(), key=lambda r: (r["doc_id"] or 0, -r["n_a"]))
    assert [r["doc_id"] for r in got] == [None, None, 3, 3]
    assert [r["n_links"] for r in got] == [2, 2, 2, 0] and [r["count_sum"] for r in got] == [6, 6, 6, 0]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(docs, A, B).collect() == []
