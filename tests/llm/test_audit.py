"""Filter audit: the byte pass against plain Python, the report against a walk over every order."""

import itertools
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import MEDIUM
from hypothesis import given, settings, strategies as st

from pixelweave.llm import audit

TEXTS = [
    "", " ", "a", " a", "a ", "\t\n\x0b\x0c\r ", "Aa aA AA", "same same same", "#a $b%|", "naïve Ünïcödé 😀 \xa0x",
    "word " * 150 + "other " * 60, "ABC def " * 120, "x" * 300 + " " + "x" * 300 + " y", "\x1cnot\x85gaps",
    " ".join(f"w{i}" for i in range(400)), "12345678 123456789 12345678 123456789 1234567",
]


def slow(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))]


def check(texts):
    got = audit.measure(pa.array(texts, pa.string()))
    assert got.tolist() == [slow(t or "") for t in texts]


def test_measures():
    check([*TEXTS, None, *TEXTS])
    check([])
    check([None])
    # A slice of a column starts at an offset of its own.
    got = audit.measure(pa.array(TEXTS, pa.string())[3:9])
    assert got.tolist() == [slow(t) for t in TEXTS[3:9]]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ab A#\n\xe9\U0001f600", max_size=60)), max_size=12))
def test_measures_of_any_text(texts):
    check(texts)


def test_slices(monkeypatch):
    monkeypatch.setattr(audit, "SLICE", 64)
    check([*TEXTS, "z" * 1000, "ab " * 500 + "q" * 200 + " ab", "é" * 100 + " " + "é" * 100])


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(audit, "_hashes", lambda view, start, size, doc: np.zeros(len(start), np.uint64))
    check(TEXTS[:12])


def test_on_real_texts(spark):
    rows = spark.read.parquet(f"{MEDIUM}/documents.parquet").limit(300).collect()
    check([r["text"] for r in rows])


def slow_report(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    fails = []
    for doc_id, text, _ in docs:
        text = text or ""
        words, distinct, capitals, points, symbols = slow(text)
        copy = doc_id is not None and any(
            other is not None and other < doc_id and (t or "") == text for other, t, _ in docs
        )
        fails.append([words < 200, 100 * distinct < 50 * words, 100 * capitals > 2 * points, symbols > 0, copy])
    out = {}
    for part in {s or "" for _, _, s in docs}:
        mine = [(d, f) for (d, _, s), f in zip(docs, fails) if (s or "") == part]
        sums = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                i = "ABCDE".index(letter)
                cut = [x for x in left if x[1][i]]
                left = [x for x in left if not x[1][i]]
                failing = [x for x in mine if x[1][i]]
                sums[letter] += len(cut)
                out[part, order, step] = [
                    len(left), len(cut), len(failing) - len(cut), sum(sum(x[1]) == 1 for x in failing),
                    sum(x[0] in good for x in cut), sum(x[0] in toxic for x in cut), letter,
                ]
        for key, row in out.items():
            if key[0] == part:
                row[-1] = sums[row[-1]]
    return out


def report_of(spark, docs, labels):
    frame = spark.createDataFrame(
        [(*d, "x", 1) for d in docs], "doc_id long, text string, source string, digest string, n int"
    )
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    rows = audit.audit(frame, marks).collect()
    return {(r["part"], r["filter_order"], r["step"]): [r[n] for n in names] for r in rows}, len(rows)


DOCS = [
    (1, TEXTS[10], "a"), (2, TEXTS[14], "a"), (3, TEXTS[14], None), (3, TEXTS[14], "a"), (4, TEXTS[11], "b"),
    (5, None, "b"), (6, "", "a"), (None, "", "a"), (None, TEXTS[14], ""), (9, TEXTS[8], "b"), (2, TEXTS[14], "a"),
    (0, "unlike", "c"), (12, TEXTS[14] + " #", "c"), (12, TEXTS[14] + " #", "c"), (13, TEXTS[11], "a"),
]
LABELS = [(2, 1, 0), (2, 0, 1), (3, 1, 1), (4, 0, 1), (13, 1, None), (None, 1, 1), (99, 1, 1), (12, None, None)]


@pytest.mark.parametrize("labels", [LABELS, []])
def test_report(spark, any_plan, labels):
    got, n = report_of(spark, DOCS, labels)
    want = slow_report(DOCS, labels)
    assert n == len(want) and got == want


def test_empty_table(spark):
    assert report_of(spark, [], LABELS) == ({}, 0)
