"""SimHash near-duplicates by a self-join of binary tries (operator 9).

A document's fingerprint has one bit per majority of its shingles' hash bits; documents link
when their fingerprints differ in few bits. All pairs within the budget are found by walking
a binary trie of the distinct fingerprints against itself: a pair of nodes carries the number
of bits in which their prefixes differ, and is dropped once that exceeds the budget.

Two tries share the work. If two halves of a fingerprint differ in at most ``b`` bits together,
the first differs in at most ``b // 2`` or the second in at most ``b - b // 2 - 1``. So one
trie starts with the first half under the one budget and the other with the second half
under the other, which prunes far more node pairs near the root, and no link is lost.

The top levels of the walk are a shuffle: every fingerprint goes to the node pairs it takes
part in. A group of that shuffle holds two subtrees, which one task walks in NumPy. A subtree
with more than ``_NODE`` fingerprints is dealt into chunks by a hash and every pair of chunks
is a group of its own, so that no group outgrows two chunks however many fingerprints share a
prefix. The depth of the split follows the number of fingerprints.

Copies never meet in the join, as it works on distinct fingerprints. A group returns no pairs
but a spanning forest of its links, at most one edge per fingerprint; connected components
are then found by passing on the smallest label along edges with pointer jumping, in tables
of the shared folder.

Defined cases: null and empty texts and texts of blanks only have fingerprint zero and link
like any other; repeated rows are copies; a null id takes part in linking but never names a
component; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from pixelweave.llm.text import few_texts
from pixelweave.workspace import materialize

# Fixed value: seed of XXH64.
SEED = 42

# Fingerprints of a subtree or chunk that one task holds.
_NODE = 8_192
# Least depth of the split, so that a corpus of any size makes groups for many tasks.
_LEAST_DEPTH = 6
# Bits of a group key: depth of the split and number of chunks are bounded by these.
_DEPTH, _CHUNK = 20, 11
# Node pairs that one step of the walk expands.
_FRONTIER = 1 << 15

_DEALT = StructType([
    StructField("pair", LongType()), StructField("fp", LongType()), StructField("high", BooleanType())
])
_EDGE = StructType([StructField("a", LongType()), StructField("b", LongType())])


def fingerprint(text: str, shingle: int = 4) -> int:
    """64-bit SimHash of one text, as a signed number."""
    import xxhash

    # bytes.lower() changes A-Z only.
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
    # Histogram of every byte of the hashes, then the bits of each byte value.
    place = hashes.view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)
    seen = np.bincount(place.ravel(), minlength=2048).reshape(8, 256)
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    ones = (seen @ bits).ravel()
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(shingle: int):
    """Column function from a text to its fingerprint."""

    @arrow_udf(LongType())
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([fingerprint(t, shingle) for part in few_texts(batch) for t in part], pa.int64())

    return of


def _rotated(fps: np.ndarray, view: int) -> np.ndarray:
    """Bits in the order of a trie's levels; the second trie begins with the other half."""
    return fps if view == 0 else (fps << np.uint64(32)) | (fps >> np.uint64(32))


def _half_budgets(budget: int) -> tuple[int, int]:
    return budget // 2, budget - budget // 2 - 1


def _masks(depth: int, budget: int) -> np.ndarray:
    """Differences of two node prefixes that the budget allows."""
    found = [0]
    level = [0]
    for _ in range(min(budget, depth)):
        level = sorted({m | 1 << i for m in level for i in range(depth) if not m >> i & 1})
        found += level
    return np.array(found, np.uint64)


def _chunk_of(fps: np.ndarray, chunks: np.ndarray) -> np.ndarray:
    mixed = (fps ^ (fps >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(32)) % chunks.astype(np.uint64)


def _deal(fps: np.ndarray, depth: int, budget: int, chunks_of: list[np.ndarray]):
    """Keys, fingerprints and sides of the groups that every fingerprint takes part in."""
    u = np.uint64
    width = u(_DEPTH + _CHUNK)
    for view, half in enumerate(_half_budgets(budget)):
        if half < 0:
            continue
        chunks = chunks_of[view]
        node = _rotated(fps, view) >> u(64 - depth) if depth else np.zeros(len(fps), u)
        own = (node << u(_CHUNK)) | _chunk_of(fps, chunks[node.astype(np.int64)])
        for mask in _masks(depth, half):
            other = node ^ mask
            n = chunks[other.astype(np.int64)]
            row = np.repeat(np.arange(len(fps)), n)
            nth = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)).astype(u)
            partner = (other[row] << u(_CHUNK)) | nth
            mine = own[row]
            low, high = np.minimum(mine, partner), np.maximum(mine, partner)
            yield (u(view) << (width + width)) | (low << width) | high, fps[row], mine > partner


def _one_component(roots: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether the places of each range [start, end) have one root."""
    changes = np.r_[0, np.cumsum(roots[1:] != roots[:-1])]
    return changes[start] == changes[end - 1]


def _walk(left: np.ndarray, right: np.ndarray, depth: int, start: int, half: int, budget: int,
          roots: Callable[[], tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of pairs of two sorted subtrees that differ in at most ``budget`` bits, and in
    at most ``half`` of the first 32. ``start`` bits differ above ``depth``.

    ``roots`` gives the components found so far: a pair of nodes that lie in one component
    can add no connection and is left out, so a crowd of near copies costs little more than
    its members.
    """
    u = np.uint64

    def limit(level: int) -> int:
        return half if level <= 32 else budget

    first = np.array([[0, len(left), 0, len(right), start]], np.int32)
    stack = [(depth, first)] if len(left) and len(right) and start <= limit(depth) else []
    while stack:
        level, nodes = stack.pop()
        if len(nodes) > _FRONTIER:
            middle = len(nodes) // 2
            stack += [(level, nodes[middle:]), (level, nodes[:middle])]
            continue
        a0, a1, b0, b1, _ = nodes.T
        of_left, of_right = roots()
        known = of_left[a0] == of_right[b0]
        known &= _one_component(of_left, a0, a1) & _one_component(of_right, b0, b1)
        nodes = nodes[~known]
        if not len(nodes):
            continue
        a0, a1, b0, b1, _ = nodes.T.astype(np.int64)
        few = (a1 - a0) * (b1 - b0) <= 4 if level < 64 else np.ones(len(nodes), bool)
        if few.any():
            # Small enough: compare whole fingerprints.
            a0, a1, b0, b1 = a0[few], a1[few], b0[few], b1[few]
            wide = b1 - b0
            n = (a1 - a0) * wide
            row = np.repeat(np.arange(len(n)), n)
            for cut in range(0, len(row), 4 * _FRONTIER):
                part = row[cut : cut + 4 * _FRONTIER]
                nth = np.arange(cut, cut + len(part)) - (np.cumsum(n) - n)[part]
                i, j = a0[part] + nth // wide[part], b0[part] + nth % wide[part]
                differ = left[i] ^ right[j]
                near = (np.bitwise_count(differ) <= budget) & (
                    np.bitwise_count(differ >> u(32)) <= half
                )
                yield i[near], j[near]
            nodes = nodes[~few]
            a0, a1, b0, b1, _ = nodes.T.astype(np.int64)
        if not len(nodes):
            continue
        # The children of a node are the two parts of its range.
        bit = u(63 - level)
        low = (left[a0] >> bit >> u(1) << u(1) | u(1)) << bit
        middle_a = _first_at(left, low, a0, a1)
        low = (right[b0] >> bit >> u(1) << u(1) | u(1)) << bit
        middle_b = _first_at(right, low, b0, b1)
        children = []
        for x in (0, 1):
            for y in (0, 1):
                child = np.stack([
                    middle_a if x else a0, a1 if x else middle_a,
                    middle_b if y else b0, b1 if y else middle_b,
                    nodes[:, 4] + (x != y),
                ], axis=1).astype(np.int32)
                alive = (child[:, 0] < child[:, 1]) & (child[:, 2] < child[:, 3])
                children.append(child[alive & (child[:, 4] <= limit(level + 1))])
        stack.append((level + 1, np.concatenate(children)))


def _first_at(values: np.ndarray, bound: np.ndarray, start: np.ndarray, end: np.ndarray):
    """First place in [start, end) of sorted ``values`` that reaches ``bound``, else end."""
    return np.clip(np.searchsorted(values, bound), start, end)


def _join_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the trees that links connect; ``root`` maps every place to its smallest one."""
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return root
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(up := root[root], root):
            root = up


def _forest(key: int, fps: np.ndarray, high: np.ndarray, depth: int, budget: int):
    """Edges of a spanning forest of the links inside one group."""
    width = _DEPTH + _CHUNK
    view, low_id, high_id = key >> 2 * width, key >> width & (1 << width) - 1, key & (1 << width) - 1
    half = _half_budgets(budget)[view]
    differ = (low_id >> _CHUNK ^ high_id >> _CHUNK).bit_count()
    order = np.argsort(_rotated(fps, view), kind="stable")
    values, high = _rotated(fps, view)[order], high[order]
    place = np.arange(len(values))
    left, right = (place, place) if low_id == high_id else (place[~high], place[high])
    root = place.copy()
    found = _walk(values[left], values[right], depth, differ, half, budget, lambda: (root[left], root[right]))
    for i, j in found:
        root = _join_roots(root, left[i], right[j])
    tied = root != place
    return _rotated(values[tied], view), _rotated(values[root[tied]], view)


def links(distinct: DataFrame, budget: int) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints of column ``fp`` exactly as all
    pairs within ``budget`` bits do."""
    n = distinct.count()
    depth = min(_DEPTH, max(_LEAST_DEPTH, int(np.ceil(np.log2(max(n, 1) / _NODE)))))
    # Fingerprints per node: at most 2 ** _DEPTH numbers for each trie.
    chunks_of = []
    for first_bits in (F.col("fp"), F.shiftleft("fp", 32)):
        node = F.shiftrightunsigned(first_bits, 64 - depth) if depth else F.lit(0).cast("long")
        sizes = distinct.groupBy(node.alias("node")).count().toPandas()
        chunks = np.ones(1 << depth, np.int64)
        chunks[sizes["node"].to_numpy(np.int64)] = -(-sizes["count"].to_numpy(np.int64) // _NODE)
        if chunks.max() >= 1 << _CHUNK:
            raise ValueError("more fingerprints under one node than group keys can number")
        chunks_of.append(chunks)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for first in range(0, len(fps), 4096):
                for key, fp, high in _deal(fps[first : first + 4096], depth, budget, chunks_of):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(high)],
                        ["pair", "fp", "high"],
                    )

    def walk(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        fps = group.column("fp").to_numpy().view(np.uint64)
        high = group.column("high").to_numpy()
        a, b = _forest(key[0].as_py(), fps, high, depth, budget)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = distinct.select("fp").mapInArrow(deal, _DEALT)
    return dealt.groupBy("pair").applyInArrow(walk, _EDGE).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) with the smallest node of each connected component as its label.

    Every round gives a node the smallest label among its neighbours and then its label's
    label, so distances halve; a round is a table in the shared folder.
    """
    both = materialize(edges.union(edges.select("b", "a")).toDF("a", "b"), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    labels = materialize(labels.withColumn("label", F.least("node", "label")), "labels")
    total = F.sum(F.col("label").cast("decimal(38,0)"))
    before, now = None, labels.agg(total).first()[0]
    while now != before:
        near = both.join(labels, F.col("b") == F.col("node")).select(F.col("a").alias("node"), "label")
        best = near.union(labels).groupBy("node").agg(F.min("label").alias("label"))
        best = materialize(best, "labels")
        above = labels.select(F.col("node").alias("up"), F.col("label").alias("up_label"))
        labels = best.join(above, F.col("label") == F.col("up")).select(
            "node", F.least("label", "up_label").alias("label")
        )
        labels = materialize(labels, "labels")
        before, now = now, labels.agg(total).first()[0]
    return labels


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4,
                    budget: int = 4, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``key``, ``fp`` (fingerprint), ``component_id``, the smallest key
    reachable over links of at most ``budget`` differing bits, itself included, and ``label``, a
    fingerprint that names the component. Where a key repeats, two components can have one
    smallest key, but not one label. Narrow columns named in ``carry`` pass through."""
    if not 0 <= budget <= 64 or shingle < 1:
        raise ValueError("budget must be 0 to 64 bits and a shingle at least one word")
    of = fingerprints(shingle)
    rows = materialize(docs.select(F.col(key).alias("id"), of(F.col(text)).alias("fp"), *carry), "fps")
    distinct = materialize(rows.groupBy("fp").agg(F.min("id").alias("id")), "distinct")
    labels = components(links(distinct, budget))
    labelled = distinct.join(labels, F.col("fp") == F.col("node"), "left").select(
        "fp", "id", F.coalesce("label", "fp").alias("label")
    )
    labelled = materialize(labelled, "labelled")
    smallest = labelled.groupBy("label").agg(F.min("id").alias("component_id"))
    smallest = materialize(smallest, "smallest")
    # Both sides are tables, so adaptive execution splits a large component or group of copies.
    named = materialize(labelled.join(smallest, "label").select("fp", "component_id", "label"), "named")
    return rows.join(named, "fp").select(F.col("id").alias(key), "fp", "component_id", "label", *carry)


def hex_digits(fp: str = "fp"):
    """A fingerprint as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")
