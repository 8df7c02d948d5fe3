"""Token-id files under Re-Pair grammars (operator 5).

Documents are encoded and written in ascending order of their key. The key space is cut into
ranges by Spark, and every task cuts its range into shards of at most ``SHARD_IDS`` ids plus
one document. A shard's ids are compressed by Re-Pair: frequent pairs of neighbouring symbols
are replaced by new symbols, again and again, while a pair is frequent enough. One pass
replaces all pairs it found frequent, from left to right and never across the end of a
document, so that a pass is a few array operations. Symbols are 16 bits wide as long as they
fit, else 32.

A shard file holds, little-endian: ``MAGIC``; as 64-bit numbers the counts of documents,
rules, symbols and ids, the number of the first nonterminal and the bytes per symbol; keys
(64 bits) and whether they are null (8 bits); the end of each document among the symbols
(64 bits); the rules as pairs of symbols and the expansion length of each rule (32 bits); the
symbols. Expansion lengths give the place of every symbol among the ids, so ``Shard.slice``
decodes any stretch of ids from the symbols that cover it alone.

Files are written by the tasks under names that no other attempt uses, and only files whose
task succeeded are listed in the index table; both lie in the shared folder.

Defined cases: null and empty texts have the end id only; null keys come first; rows of equal
keys are neighbours in the order of a hash of their texts; a text of any length is one document of a
shard, which a task holds whole; an empty table gives no file; extra columns are
ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from pixelweave.functions.storage import locate
from pixelweave.llm.text import Encoder
from pixelweave.operators.numbering import running_total
from pixelweave.workspace import fresh_path, materialize

MAGIC = b"REPAIR01"
SHARD_IDS = 1_000_000

# A pair is replaced while it occurs at least LEAST times; rules of one pass, the most frequent
# pairs first.
LEAST = 32
RULES_PER_PASS = 2_500
_BUCKETS = 1 << 18


def _frequent(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """Codes of the most frequent pairs, sorted; which of ``codes`` may be among them; and whether
    frequent ones are left over."""
    if len(codes) < _BUCKETS:
        found, counts = np.unique(codes, return_counts=True)
        best = np.argsort(-counts, kind="stable")[: min(int((counts >= LEAST).sum()), RULES_PER_PASS)]
        return np.sort(found[best]), np.arange(len(codes)), bool((counts >= LEAST).sum() > RULES_PER_PASS)
    slot = ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.int32)
    # A pair cannot be more frequent than its slot, so only pairs of full slots are sorted.
    per_slot = np.bincount(slot, minlength=_BUCKETS)
    n_best = min(RULES_PER_PASS, _BUCKETS - 1)
    least = max(LEAST, int(np.partition(per_slot, -n_best)[-n_best]))
    near = np.flatnonzero((per_slot >= least)[slot])
    found, counts = np.unique(codes[near], return_counts=True)
    n_frequent = int((counts >= LEAST).sum())
    best = np.argsort(-counts, kind="stable")[: min(n_frequent, RULES_PER_PASS)]
    return np.sort(found[best]), near, least > LEAST or n_frequent > RULES_PER_PASS


def compress(ids: np.ndarray, ends: np.ndarray, first: int):
    """Symbols, document ends among them, and rules for ``ids`` (documents end at ``ends``).

    ``first`` is the number of the first nonterminal, above all ids. Passes go on until no pair
    occurs ``LEAST`` times. Only pairs with a symbol of the pass before can have become
    frequent, so the others are counted again only while frequent ones are left over.
    """
    symbols = ids.astype(np.uint32)
    last = np.zeros(len(symbols), bool)
    last[ends - 1] = True
    rules: list[np.ndarray] = []
    number, new_from, left_over = first, 0, True
    while len(symbols) > 1:
        usable = ~last[:-1]
        if not left_over:
            new = symbols >= new_from
            usable &= new[:-1] | new[1:]
        places = np.flatnonzero(usable)
        codes = symbols[places].astype(np.uint64) << np.uint64(32) | symbols[places + 1]
        chosen, near, left_over = _frequent(codes)
        if not len(chosen):
            if left_over:
                # Full slots of rare pairs hid the frequent ones: look at every pair.
                found, counts = np.unique(codes, return_counts=True)
                chosen, near = found[counts >= LEAST][:RULES_PER_PASS], np.arange(len(codes))
            if not len(chosen):
                break
        places, codes = places[near], codes[near]
        rank = np.minimum(np.searchsorted(chosen, codes), len(chosen) - 1)
        found = chosen[rank] == codes
        at, rank = places[found], rank[found]
        # Of a run of overlapping pairs every second one is replaced, from the left.
        starts = np.r_[True, np.diff(at) > 1]
        run = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
        taken = (np.arange(len(at)) - run) % 2 == 0
        at = at[taken]
        symbols[at] = number + rank[taken]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        last[at] |= last[at + 1]
        symbols, last = symbols[keep], last[keep]
        rules.append(np.stack([chosen >> np.uint64(32), chosen & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32))
        new_from, number = number, number + len(chosen)
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    return symbols, np.flatnonzero(last) + 1, table


def _open_once(symbols: np.ndarray, rules: np.ndarray, first: int) -> np.ndarray:
    """Symbols with every nonterminal replaced by its pair."""
    open_ = symbols >= first
    place = np.arange(len(symbols)) + np.r_[0, np.cumsum(open_)[:-1]]
    out = np.empty(len(symbols) + int(open_.sum()), np.uint32)
    out[place[~open_]] = symbols[~open_]
    pair = rules[symbols[open_] - first]
    out[place[open_]], out[place[open_] + 1] = pair[:, 0], pair[:, 1]
    return out


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, first: int) -> np.ndarray:
    """The ids that symbols stand for; ``lengths`` are the rules' expansion lengths."""
    # All rules' ids one after the other, opened pass by pass; then each symbol copies its own.
    flat = np.arange(first, first + len(rules), dtype=np.uint32)
    while (flat >= first).any():
        flat = _open_once(flat, rules, first)
    flat = np.r_[np.arange(first, dtype=np.uint32), flat]
    start = np.r_[np.arange(first), first + np.cumsum(lengths, dtype=np.int64) - lengths]
    size = np.ones(first + len(rules), np.int64)
    size[first:] = lengths
    symbols = symbols.astype(np.int64)
    sizes = size[symbols]
    ends = np.cumsum(sizes)
    if not len(ends):
        return np.empty(0, np.uint32)
    return flat[np.arange(ends[-1]) + np.repeat(start[symbols] - (ends - sizes), sizes)]


def _expansions(rules: np.ndarray, first: int) -> np.ndarray:
    """Ids that each rule stands for; a rule refers to earlier ones only."""
    lengths = np.ones(len(rules), np.uint32)
    for i, (a, b) in enumerate(rules.tolist()):
        lengths[i] = (lengths[a - first] if a >= first else 1) + (lengths[b - first] if b >= first else 1)
    return lengths


@dataclass(frozen=True)
class Shard:
    """One file's contents."""

    keys: np.ndarray
    null_keys: np.ndarray
    ends: np.ndarray
    first: int
    rules: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray

    @classmethod
    def of(cls, keys: list, documents: list[bytes]) -> Shard:
        ids = np.frombuffer(b"".join(documents), "<u4")
        ends = np.cumsum([len(d) // 4 for d in documents])
        first = int(ids.max()) + 1
        symbols, symbol_ends, rules = compress(ids, ends, first)
        nulls = np.array([k is None for k in keys])
        return cls(np.array([k or 0 for k in keys], "<i8"), nulls, symbol_ends, first, rules,
                   _expansions(rules, first), symbols)

    def to_bytes(self) -> bytes:
        width = 2 if self.first + len(self.rules) <= 1 << 16 else 4
        n_ids = int(self._sizes().sum())
        counts = [len(self.keys), len(self.rules), len(self.symbols), n_ids, self.first, width]
        return b"".join([
            MAGIC, np.array(counts, "<i8").tobytes(), self.keys.astype("<i8").tobytes(),
            self.null_keys.astype("u1").tobytes(), self.ends.astype("<i8").tobytes(),
            self.rules.astype("<u4").tobytes(), self.lengths.astype("<u4").tobytes(),
            self.symbols.astype(f"<u{width}").tobytes(),
        ])

    @classmethod
    def from_bytes(cls, data: bytes) -> Shard:
        if data[:8] != MAGIC:
            raise ValueError("not a shard of token ids")
        n_docs, n_rules, n_symbols, _, first, width = np.frombuffer(data, "<i8", 6, 8).tolist()
        at = 56

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, n, at)
            at += found.nbytes
            return found

        keys, nulls, ends = take("<i8", n_docs), take("u1", n_docs).astype(bool), take("<i8", n_docs)
        rules = take("<u4", 2 * n_rules).reshape(-1, 2)
        return cls(keys, nulls, ends, first, rules, take("<u4", n_rules), take(f"<u{width}", n_symbols))

    def _sizes(self) -> np.ndarray:
        """Ids that each symbol stands for."""
        sizes = np.ones(len(self.symbols), np.int64)
        open_ = self.symbols >= self.first
        sizes[open_] = self.lengths[self.symbols[open_].astype(np.int64) - self.first]
        return sizes

    def id_ends(self) -> np.ndarray:
        """End of each document among the ids."""
        return np.cumsum(self._sizes())[self.ends - 1] if len(self.ends) else self.ends

    def ids(self) -> np.ndarray:
        return expand(self.symbols, self.rules, self.lengths, self.first)

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` to ``stop``, decoded from the symbols that cover them."""
        ends = np.cumsum(self._sizes())
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        before = int(ends[a - 1]) if a else 0
        return expand(self.symbols[a:b], self.rules, self.lengths, self.first)[start - before : stop - before]


_INDEX = StructType([
    StructField("path", StringType()), StructField("part", IntegerType()), StructField("nth", IntegerType()),
    StructField("documents", LongType()), StructField("ids", LongType()), StructField("bytes", LongType()),
])


def write(docs: DataFrame, tokenizer: str, folder: str, key: str = "doc_id", text: str = "text",
          end_id: int = 2, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write ``docs`` under ``folder`` and return the index: a row per shard, ordered by
    (``part``, ``nth``)."""
    end = end_id.to_bytes(4, "little")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = Encoder(tokenizer), TaskContext.get().partitionId()
        filesystem, base = locate(folder)
        filesystem.create_dir(base, recursive=True)
        keys, held, size, nth = [], [], 0, 0

        def flush() -> pa.RecordBatch:
            data = Shard.of(keys, held).to_bytes()
            path = f"{folder}/{part:06d}-{nth:06d}-{uuid.uuid4().hex}.ids"
            with filesystem.open_output_stream(locate(path)[1]) as out:
                out.write(data)
            row = [path, part, nth, len(keys), size // 4, len(data)]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, (pa.string(), pa.int32(), pa.int32(), *[pa.int64()] * 3))],
                _INDEX.names,
            )

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode_column(batch.column(1))):
                keys.append(doc_id)
                held.append(ids + end)
                size += len(ids) + 4
                if size >= 4 * shard_ids:
                    yield flush()
                    keys, held, size, nth = [], [], 0, nth + 1
        if held:
            yield flush()

    ordered = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    # Rows of one key are as many as they like, so their texts part the ranges as well.
    spread = ordered.withColumn("mark", F.xxhash64("text")).repartitionByRange("key", "mark")
    ordered = spread.sortWithinPartitions("key", "mark").select("key", "text")
    return materialize(ordered.mapInArrow(save, _INDEX), "shards")


_READ = StructType([StructField(n, LongType()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])


def read(index: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, ``start`` (ids of all documents before it),
    ``n_tokens`` and the CRC-32 of its ids."""
    placed = running_total(index.select("path", "part", "nth", "ids"), ["part", "nth"], "ids", "upto")
    n_tasks = max(1, -(-index.count() // 4))
    shards = placed.select("path", (F.col("upto") - F.col("ids")).alias("start")).repartition(n_tasks)

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                filesystem, place = locate(path)
                with filesystem.open_input_stream(place) as file:
                    shard = Shard.from_bytes(file.read())
                ids, ends = shard.ids().astype("<u4").tobytes(), shard.id_ends()
                starts = np.r_[0, ends[:-1]]
                sums = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(shard.keys, mask=shard.null_keys), pa.array(start + starts),
                    pa.array(ends - starts), pa.array(sums, pa.int64()),
                ], _READ.names)

    return shards.mapInArrow(load, _READ)


def corpus_folder(docs: DataFrame) -> str:
    """A new folder for shards under the shared one."""
    return fresh_path(docs.sparkSession, "ids")
