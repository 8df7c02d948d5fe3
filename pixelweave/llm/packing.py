"""Best-fit packing with certified repacking (operator 4).

Items of whole lengths go into sequences of a fixed capacity, as few as possible. Items that
fill a sequence alone are done. The others are dealt into groups of bounded size by a hash,
and every group is packed by best-fit decreasing in one task.

Dual-feasible functions give a lower bound on the sequences of any packing: a function f from
lengths to [0, 1] such that lengths that fit together never sum to more than 1. A group's bound
certifies its count. Groups with a gap between their count and their fractional bound give up
their emptiest sequences, four times as many as the gap for choice; these meet those of
other groups, whole sequences at a time, and are packed again by best-fit decreasing. A
repacked group that needs more sequences than it got keeps what it got, so a round never makes
the result worse. The exchange ends when the count meets the bound of all lengths together,
when nothing is given up, or when a round saves nothing.

The bound of all lengths needs the number of items per length only, at most ``capacity`` rows.
State between rounds is a table in the shared folder; only what groups give up moves again.

Defined cases: null lengths count as zero; items of length zero take no room and share a
sequence; longer items than the capacity are an error (cut them before); an empty table gives
an empty result; all columns pass through, and columns named ``sequence_id`` or ``offset`` are
replaced.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from pixelweave.llm.text import CACHED_WORDS, Encoder
from pixelweave.workspace import materialize

# Items that one task packs at a time.
GROUP = 20_000

_STATE = [StructField("sequence_id", LongType()), StructField("offset", LongType()),
          StructField("_free", BooleanType()), StructField("_head", BooleanType())]


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every item by best-fit decreasing."""
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if some bin has room r
    n_bins = 0
    order = np.argsort(-lengths, kind="stable")
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, chosen, n_bins = capacity, n_bins, n_bins + 1
        bins[i], offsets[i] = chosen, capacity - room
        by_room[room - size].append(chosen)
        rooms |= 1 << (room - size)
    return bins, offsets


def dual_bound(counts: np.ndarray, capacity: int) -> float:
    """Largest fractional lower bound on the bins for ``counts[x]`` items of length x.

    Functions: x / capacity; the staircase floor((k + 1) x) / k between its own steps, for k up
    to 20; and for every threshold t the one that drops lengths below t and rounds those above
    capacity - t up to a whole bin.
    """
    x = np.arange(capacity + 1)
    best = counts @ x / capacity
    for k in range(1, 21):
        steps, part = np.divmod((k + 1) * x, capacity)
        f = np.where(part == 0, x / capacity, steps / k)
        best = max(best, counts @ f)
    # For all thresholds at once: items above capacity - t, and the volume of the middle ones.
    t = np.arange(1, capacity // 2 + 1)
    number = np.concatenate(([0], np.cumsum(counts)))
    volume = np.concatenate(([0], np.cumsum(counts * x)))
    large = number[-1] - number[capacity - t + 1]
    middle = volume[capacity - t + 1] - volume[t]
    return float(max(best, (large + middle / capacity).max(initial=0)))


def _assign(lengths: np.ndarray, old: np.ndarray | None, old_offsets: np.ndarray | None, capacity: int):
    """Bins, offsets and which bins to give up, of one group."""
    bins, offsets = best_fit(lengths, capacity)
    if old is not None:
        names, renamed = np.unique(old, return_inverse=True)
        if bins.max() + 1 > len(names):
            bins, offsets = renamed, old_offsets
    fill = np.bincount(bins, lengths)
    gap = len(fill) - dual_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
    give = 0 if gap < 1e-6 else max(8, 4 * int(np.ceil(gap)))
    free = np.zeros(len(fill), bool)
    free[np.argsort(fill, kind="stable")[:give]] = True
    free &= fill < capacity
    return bins, offsets, free[bins]


@dataclass(frozen=True)
class Certificate:
    """Sequences used and the lower bound on any packing of all items."""

    sequences: int
    bound: int


def pack(items: DataFrame, length: str = "length", capacity: int = 2048, group: int = GROUP) -> tuple[DataFrame, Certificate]:
    """``items`` with ``sequence_id`` and ``offset``, and the certificate of the packing."""
    kept = items.drop("sequence_id", "offset", "_free", "_head")
    schema = StructType([*kept.schema.fields, *_STATE])
    names = kept.columns
    size = F.coalesce(F.col(length), F.lit(0))
    checked = kept.withColumn("_row", F.monotonically_increasing_id())
    checked = materialize(checked, "pack-items")
    counts = checked.groupBy(size.alias("x")).count().toPandas()
    x = counts["x"].to_numpy(np.int64)
    if len(x) and (x.max() > capacity or x.min() < 0):
        raise ValueError(f"lengths must be 0 to {capacity}")
    number = np.zeros(capacity + 1, np.int64)
    number[x] = counts["count"].to_numpy(np.int64)
    bound = int(np.ceil(dual_bound(number, capacity) - 1e-9))

    alone = checked.where(size == capacity).select(
        *names, (-1 - F.col("_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    n_open = int(number[:capacity].sum())
    rest = checked.where(size < capacity).withColumn(
        "_group", F.pmod(F.xxhash64("_row"), F.lit(max(1, -(-n_open // group))))
    )

    def packer(round_: int):
        def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            lengths = np.nan_to_num(table.column(length).to_numpy()).astype(np.int64)
            old = table.column("sequence_id").to_numpy() if round_ else None
            old_offsets = table.column("offset").to_numpy() if round_ else None
            bins, offsets, free = _assign(lengths, old, old_offsets, capacity)
            # Round (15 bits), group and bin (24 each) make a number that no other bin has.
            ids = (np.int64(round_) << 48) | (np.int64(key[0].as_py()) << 24) | bins
            _, heads = np.unique(bins, return_index=True)
            head = np.zeros(len(bins), bool)
            head[heads] = True
            out = table.select(names)
            for name, column in (("sequence_id", ids), ("offset", offsets), ("_free", free), ("_head", head)):
                out = out.append_column(name, pa.array(column))
            return out

        return run

    packed = materialize(rest.groupBy("_group").applyInArrow(packer(0), schema), "packed")
    done, used = [alone], int(number[capacity]) + packed.where("_head").count()
    # Every round but the last saves a sequence at least, so this ends.
    for round_ in itertools.count(1):
        pool = packed.where("_free").drop("_free", "_head")
        n_pool = pool.count() if used > bound else 0
        if not n_pool:
            break
        done.append(packed.where("not _free").select(*names, "sequence_id", "offset"))
        before = packed.where("_free and _head").count()
        # Whole sequences are dealt, so a group can always keep what it got.
        dealt = F.pmod(F.xxhash64("sequence_id", F.lit(round_)), F.lit(-(-n_pool // group)))
        packed = materialize(
            pool.withColumn("_group", dealt).groupBy("_group").applyInArrow(packer(round_), schema), "packed"
        )
        saved = before - packed.where("_head").count()
        used -= saved
        if not saved:
            break
    done.append(packed.select(*names, "sequence_id", "offset"))
    result = done[0]
    for part in done[1:]:
        result = result.union(part)
    return result, Certificate(used, bound)


_PIECES = StructType([StructField(n, LongType()) for n in ("doc_id", "piece", "start", "length", "ids_crc32")])


def pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
           capacity: int = 2048, end_id: int = 0, cached: int = CACHED_WORDS) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document, ``end_id`` appended: doc_id,
    piece, start, length and the CRC-32 of its ids. A null text has the end id only. A worker
    keeps ``cached`` words encoded."""
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, cached)
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode_column(batch.column(1))):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], _PIECES.names)

    return docs.select(F.col(key).cast("long"), text).mapInArrow(cut, _PIECES)
