"""Filter interaction audit (operator 13).

Five filters A to E look at every text, and every order of applying them is reported: what each
step keeps and removes, what an earlier filter had removed already, what only this filter
finds, which labelled documents it costs, and its share over all orders.

One table-driven pass over the bytes of a text measures what filters A to D need. A byte's
class is looked up; the automaton's state is whether the byte before belongs to a word, so a
second table, indexed by state and class, gives what the byte emits: a word's start, a
capital, the first byte of a code point, a symbol. Word spans go into a hash table with
open addressing; a span counts as known only if its bytes equal those of the span that owns
the slot. Tables are NumPy arrays over a slice of some million bytes, whole texts and several
of them together.

Filter E compares texts by their SHA-256. Equal texts are counted per digest, part and labels
before they meet, so that a text with a third of all rows is one row per task, and the final
report needs the documents only as counts per part and set of failed filters.

Defined cases: a null text is empty (it fails A only, and E beside another one); a null source is the
part ''; a null key has no label, is no copy and makes none; repeated rows count each, and equal
keys are no smaller keys, so both stay; labels of a key that has several rows are its largest;
an empty table has no part and no row; texts of any length are read whole, in slices cut between words;
extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from pixelweave.workspace import materialize

# Fixed values of the filters.
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 2
SYMBOLS = b"#$%&*|"
SEPARATORS = b" \t\n\x0b\x0c\r"

LETTERS = "ABCDE"

# Bytes that one table holds the words of; a longer text is cut between words.
SLICE = 2 << 20
# Longer words are compared as Python bytes.
_LONG_WORD = 256

# Classes of bytes.
_GAP, _PLAIN, _CAPITAL, _SYMBOL, _INNER = range(5)
# What a byte emits.
_STARTS, _IS_CAPITAL, _IS_POINT, _IS_SYMBOL = 1, 2, 4, 8


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Class of every byte; output by state (0 between words, 1 in one) and class."""
    classes = np.full(256, _PLAIN, np.uint8)
    classes[list(SEPARATORS)] = _GAP
    classes[list(range(ord("A"), ord("Z") + 1))] = _CAPITAL
    classes[list(SYMBOLS)] = _SYMBOL
    classes[0x80:0xC0] = _INNER
    emits = np.zeros((2, 5), np.uint8)
    emits[0, 1:] |= _STARTS
    emits[:, :_INNER] |= _IS_POINT
    emits[:, _CAPITAL] |= _IS_CAPITAL
    emits[:, _SYMBOL] |= _IS_SYMBOL
    return classes, emits


_CLASSES, _EMITS = _tables()
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as one number; places near the end see zeros."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def _equal(view: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the spans at ``a`` and ``b`` hold the same ``size`` bytes."""
    same = (view[a] ^ view[b]) & _MASKS[np.minimum(size, 8)] == 0
    rest = np.flatnonzero(same & (size > 8))
    at = 8
    while len(rest):
        left = size[rest] - at
        agree = (view[a[rest] + at] ^ view[b[rest] + at]) & _MASKS[np.minimum(left, 8)] == 0
        same[rest[~agree]] = False
        rest = rest[agree & (left > 8)]
        at += 8
    return same


def _hashes(view: np.ndarray, start: np.ndarray, size: np.ndarray, doc: np.ndarray) -> np.ndarray:
    found = (doc.astype(np.uint64) + np.uint64(1)) * _MIX ^ size.astype(np.uint64)
    rest, at = np.arange(len(start)), 0
    while len(rest):
        left = size[rest] - at
        part = view[start[rest] + at] & _MASKS[np.minimum(left, 8)]
        mixed = (found[rest] ^ part) * _MIX
        found[rest] = mixed ^ (mixed >> np.uint64(29))
        rest = rest[left > 8]
        at += 8
    return found * _MIX


def _first_spans(view: np.ndarray, start: np.ndarray, size: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Insert the spans into a hash table; which span came to own a slot, one per distinct
    word of a document."""
    if not len(start):
        return np.empty(0, np.int64)
    bits = int(2 * len(start)).bit_length()
    owner = np.full(1 << bits, -1, np.int64)
    key = _hashes(view, start, size, doc)
    slot = (key >> np.uint64(64 - bits)).astype(np.int64)
    waiting = np.arange(len(start))
    while len(waiting):
        at = slot[waiting]
        free = owner[at] < 0
        owner[at[free]] = waiting[free]
        held = owner[at]
        known = (key[held] == key[waiting]) & (doc[held] == doc[waiting]) & (size[held] == size[waiting])
        close = np.flatnonzero(known)
        known[close] = _equal(view, start[held[close]], start[waiting[close]], size[waiting[close]])
        waiting = waiting[~known]
        slot[waiting] = (slot[waiting] + 1) & (len(owner) - 1)
    return owner[owner >= 0]


def _scan(data: np.ndarray, cuts: np.ndarray):
    """Words, capitals, code points and symbols of the texts between ``cuts`` (no text is
    empty), and the start, size and text of every distinct word."""
    heads, tails = cuts[:-1], cuts[1:] - 1
    classes = _CLASSES[data]
    in_word = classes != _GAP
    state = np.empty(len(data), bool)
    state[1:] = in_word[:-1]
    state[heads] = False
    emitted = _EMITS[state.view(np.uint8), classes]
    stops = np.empty(len(data), bool)
    stops[:-1] = ~in_word[1:]
    stops[tails] = True
    start = np.flatnonzero(emitted & _STARTS)
    size = np.flatnonzero(in_word & stops) + 1 - start
    doc = np.searchsorted(heads, start, "right") - 1
    counts = [np.bincount(doc, minlength=len(heads))]
    for bit in (_IS_CAPITAL, _IS_POINT, _IS_SYMBOL):
        counts.append(np.add.reduceat((emitted & bit) != 0, heads, dtype=np.int64))
    short = size <= _LONG_WORD
    first = _first_spans(_eights(data), start[short], size[short], doc[short])
    spans = [start[short][first], size[short][first], doc[short][first]]
    if not short.all():
        seen = {}
        for at, n, d in zip(start[~short].tolist(), size[~short].tolist(), doc[~short].tolist()):
            seen.setdefault((d, data[at : at + n].tobytes()), (at, n, d))
        spans = [np.r_[a, b] for a, b in zip(spans, np.array(list(seen.values()), np.int64).T)]
    return counts, spans


def _long_text(data: np.ndarray) -> list[int]:
    """The counts of one text of any length, slice by slice."""
    totals, known, at = [0, 0, 0, 0], set(), 0
    while at < len(data):
        end = min(at + SLICE, len(data))
        # On to the end of the word that the cut would part.
        while end < len(data) and not (gaps := np.flatnonzero(_CLASSES[data[end : end + SLICE]] == _GAP)).size:
            end = min(end + SLICE, len(data))
        if end < len(data):
            end += int(gaps[0]) + 1
        part = data[at:end]
        counts, (start, size, _) = _scan(part, np.array([0, len(part)]))
        totals = [n + int(c[0]) for n, c in zip(totals, counts)]
        raw = part.tobytes()
        known.update(raw[a : a + n] for a, n in zip(start.tolist(), size.tolist()))
        at = end
    return [totals[0], len(known), *totals[1:]]


def measure(column: pa.Array) -> np.ndarray:
    """Words, distinct words, capitals, code points and symbols of every text, a row each."""
    column = column.cast(pa.large_binary())
    n = len(column)
    found = np.zeros((n, 5), np.int64)
    _, offsets, values = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.empty(0, np.uint8)
    # A null slot may span bytes of its own.
    some = np.flatnonzero((np.diff(ends) > 0) & column.is_valid().to_numpy(zero_copy_only=False))
    sizes = (ends[1:] - ends[:-1])[some]
    long = sizes > SLICE
    for i in some[long]:
        found[i] = _long_text(data[ends[i] : ends[i + 1]])
    some, sizes = some[~long], sizes[~long]
    group = np.cumsum(sizes) // SLICE
    for rows in np.split(some, np.flatnonzero(np.diff(group)) + 1) if len(some) else []:
        texts = [data[ends[i] : ends[i + 1]] for i in rows]
        cuts = np.cumsum([0, *map(len, texts)])
        (words, *rest), (_, _, doc) = _scan(np.concatenate(texts), cuts)
        found[rows] = np.stack([words, np.bincount(doc, minlength=len(rows)), *rest], 1)
    return found


MEASURES = ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")
_MEASURED = StructType([StructField(name, LongType()) for name in MEASURES])


def measured(text: Column) -> Column:
    """Struct of the counts of a text."""

    @arrow_udf(_MEASURED)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.StructArray.from_arrays([pa.array(c) for c in measure(batch).T], _MEASURED.names)

    return of(text)


def failures(text: Column) -> Column:
    """Which of filters A to D a text fails, as the bits 0 to 3 of a number."""
    m = measured(text)
    fails = (
        m["n_words"] < LEAST_WORDS,
        100 * m["n_distinct"] < LEAST_DISTINCT_PERCENT * m["n_words"],
        100 * m["n_capitals"] > MOST_CAPITALS_PERCENT * m["n_points"],
        m["n_symbols"] > 0,
    )
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0)).cast("int")


def failed_sets(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                part: str = "source") -> DataFrame:
    """Documents per part, set of failed filters (bits 0 to 4) and labels: part, failed, good,
    toxic, n."""
    whole = F.coalesce(F.col(text), F.lit(""))
    seen = materialize(
        docs.select(
            F.col(key).cast("long").alias("id"),
            F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
            F.unhex(F.sha2(whole.cast("binary"), 256)).alias("digest"),
            failures(F.col(text)).alias("failed"),
        ),
        "audit",
    )
    marks = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("id")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"),
    )
    by = ["digest", "part", "failed", "good", "toxic"]
    named = seen.where("id is not null").join(marks, "id", "left").fillna(0, ["good", "toxic"])
    rows = named.groupBy("id", *by).agg(F.count("*").alias("n"))
    # One row per text, part and labels: rows, the smallest key and the rows that have it.
    texts = rows.groupBy(*by).agg(F.sum("n").alias("n"), F.min(F.struct("id", "n")).alias("low"))
    texts = materialize(texts, "audit-texts")
    lowest = texts.groupBy("digest").agg(F.min("low.id").alias("lowest"))
    first = F.when(F.col("low.id") == F.col("lowest"), F.col("low.n")).otherwise(F.lit(0))
    both = texts.join(lowest, "digest").select(
        *by[1:], F.explode(F.array(
            F.struct(F.col("failed").alias("bits"), first.alias("count")),
            F.struct((F.col("failed") + 16).alias("bits"), (F.col("n") - first).alias("count")),
        )).alias("x")
    ).select("part", F.col("x.bits").alias("failed"), "good", "toxic", F.col("x.count").alias("n"))
    nameless = seen.where("id is null").select(
        "part", "failed", F.lit(0).alias("good"), F.lit(0).alias("toxic"), F.lit(1).cast("long").alias("n")
    )
    counted = both.unionByName(nameless).groupBy("part", "failed", "good", "toxic")
    return counted.agg(F.sum("n").alias("n")).where("n > 0")


def _orders() -> Column:
    """All orders of the filters, generated."""
    return F.array(*[F.lit("".join(p)) for p in itertools.permutations(LETTERS)])


def report(sets: DataFrame) -> DataFrame:
    """A row per part, order and step from the counts of ``failed_sets``."""
    everyone = range(1 << len(LETTERS))
    weighs = {"n": F.col("n"), "good": F.col("n") * F.col("good"), "toxic": F.col("n") * F.col("toxic")}
    parts = sets.groupBy("part").agg(*[
        F.array(*[F.sum(F.when(F.col("failed") == m, value).otherwise(0)) for m in everyone]).alias(name)
        for name, value in weighs.items()
    ])
    steps = parts.withColumn("filter_order", F.explode(_orders())).withColumn(
        "step", F.explode(F.array(*[F.lit(i) for i in range(1, len(LETTERS) + 1)]))
    )
    bits = F.array(*[F.lit(1 << i) for i in range(len(LETTERS))])
    bit = lambda letter: F.get(bits, F.instr(F.lit(LETTERS), letter) - 1)
    letters = [F.substring("filter_order", i, 1) for i in range(1, len(LETTERS) + 1)]
    before = sum((F.when(F.col("step") > i, bit(x)).otherwise(0) for i, x in enumerate(letters, 1)), F.lit(0))
    steps = steps.withColumn("own", bit(F.expr("substring(filter_order, step, 1)"))).withColumn("before", before)

    def total(of: str, wanted) -> Column:
        """Documents whose set of failed filters is wanted."""
        add = lambda sum_, m: sum_ + F.when(wanted(m), F.get(F.col(of), m)).otherwise(F.lit(0).cast("long"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(len(everyone) - 1)), F.lit(0).cast("long"), add)

    fails = lambda m: m.bitwiseAND(F.col("own")) != 0
    gone = lambda m: m.bitwiseAND(F.col("before")) != 0
    lost = lambda m: fails(m) & ~gone(m)
    return steps.select(
        "part", "filter_order", "step",
        total("n", lambda m: ~fails(m) & ~gone(m)).alias("kept"),
        total("n", lost).alias("removed"),
        total("n", lambda m: fails(m) & gone(m)).alias("redundant"),
        total("n", lambda m: m == F.col("own")).alias("unique_fails"),
        total("good", lost).alias("good_lost"),
        total("toxic", lost).alias("toxic_lost"),
        _share(fails).alias("shapley"),
    )


def _share(fails) -> Column:
    """Documents that the own filter removes, summed over all orders: of a document that fails k
    filters, each removes it in one k-th of the orders."""
    orders = math.factorial(len(LETTERS))
    share = F.array(F.lit(0), *[F.lit(orders // k) for k in range(1, len(LETTERS) + 1)])
    add = lambda sum_, m: sum_ + F.when(
        fails(m), F.get(F.col("n"), m) * F.get(share, F.bit_count(m))
    ).otherwise(F.lit(0).cast("long"))
    return F.aggregate(F.sequence(F.lit(0), F.lit((1 << len(LETTERS)) - 1)), F.lit(0).cast("long"), add)


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          part: str = "source") -> DataFrame:
    """The report on all orders of the filters over ``docs``."""
    return report(failed_sets(docs, labels, key, text, part))
