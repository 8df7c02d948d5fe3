"""Best-fit packing: complete, gapless, within capacity, and close to its certified bound."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import MEDIUM
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pixelweave.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_layout(frame, capacity, length="length"):
    for _, rows in frame.groupby("sequence_id"):
        rows = rows[rows[length] > 0].sort_values("offset")
        ends = rows["offset"] + rows[length]
        assert list(rows["offset"]) == [0, *ends[:-1]][: len(rows)]
        assert rows[length].sum() <= capacity


@pytest.mark.parametrize("lengths", [
    [], [0], [0, 0, 5], [10], [10] * 7, [6, 4, 7, 3, 5, 5, 9, 1], [6] * 9, [4, 4, 4, 3, 3, 3, 3] * 30,
    [None, 3, 10, 10],
])
@pytest.mark.parametrize("group", [5, 1000])
def test_small_cases(spark, lengths, group):
    rows = [(i, n, "x", 7) for i, n in enumerate(lengths)]
    items = spark.createDataFrame(rows, "id long, length long, sequence_id string, offset int")
    packed, certificate = packing.pack(items, capacity=10, group=group)
    frame = packed.toPandas().fillna({"length": 0})
    assert sorted(frame["id"]) == list(range(len(lengths)))
    check_layout(frame, 10)
    assert frame["sequence_id"].nunique() == certificate.sequences >= certificate.bound


def test_too_long(spark):
    items = spark.createDataFrame([(11,)], "length long")
    with pytest.raises(ValueError):
        packing.pack(items, capacity=10)


def test_exchange_saves_sequences(spark):
    """Many groups, each with a nearly empty last sequence, end near the bound of all items."""
    items = spark.range(20_000).select("id", (F.pmod(F.xxhash64("id"), F.lit(900)) + 1).alias("length"))
    packed, certificate = packing.pack(items, capacity=2048, group=500)
    frame = packed.toPandas()
    check_layout(frame, 2048)
    assert len(frame) == 20_000
    assert frame["sequence_id"].nunique() == certificate.sequences
    assert certificate.sequences <= certificate.bound + 4


def test_exchange_goes_on_while_it_saves(spark):
    """Small groups need ten rounds; six end at 1,347 sequences over a bound of 1,315."""
    items = spark.range(0, 6000, 1, 8).select("id", (F.pmod(F.xxhash64("id"), F.lit(900)) + 1).alias("length"))
    packed, certificate = packing.pack(items, capacity=2048, group=20)
    frame = packed.toPandas()
    check_layout(frame, 2048)
    assert len(frame) == 6000 and frame["sequence_id"].nunique() == certificate.sequences
    assert certificate.sequences <= certificate.bound + 27


def slow_bound(lengths, capacity):
    """Fewest bins by trying all assignments of few items."""
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for j in range(len(rooms)):
            if rooms[j] >= lengths[i]:
                place(i + 1, rooms[:j] + [rooms[j] - lengths[i]] + rooms[j + 1 :])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best


def test_bound_is_never_above_the_optimum():
    rng = np.random.default_rng(5)
    for _ in range(150):
        lengths = rng.integers(1, 21, rng.integers(1, 8)).tolist()
        bound = packing.dual_bound(np.bincount(lengths, minlength=21), 20)
        assert np.ceil(bound - 1e-9) <= slow_bound(sorted(lengths, reverse=True), 20)
    assert packing.dual_bound(np.bincount([11] * 6, minlength=21), 20) == 6


def test_pieces_hold_the_library_ids(spark):
    tokenizer = Tokenizer.from_file(PATH)
    odd = [None, "", " ", "it's  a test\x1c x\n\n\ty 123 <|endoftext|> é\ń ÀÉ ß ΑΣ ΑΣ. ​", "word " * 5000]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(odd)], "doc_id long, text string, piece int")
    real = spark.read.parquet(f"{MEDIUM}/documents.parquet").select((F.col("doc_id") + 100).alias("doc_id"), "text")
    both = docs.select("doc_id", "text").union(real)
    got = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"])
           for r in packing.pieces(both, PATH).collect()}
    want = {}
    for row in both.collect():
        ids = np.array([*tokenizer.encode(row["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want[row["doc_id"], piece] = (at, len(part), zlib.crc32(part.tobytes()))
    assert got == want
