"""Exact top-k inner products over norm-sorted vectors (operator 6).

Components are scaled to whole numbers, so scores are exact. Vectors are processed by
descending length in blocks: a query with its k-th best score so far need not look at vectors
whose length times its own is smaller. For those left, the space is rotated by the singular
vectors of all vectors together, so that a few leading coordinates hold most of the product;
the rest is bounded by Cauchy-Schwarz, and only vectors whose bound reaches the k-th best
score are multiplied out in whole numbers.

Spark sorts all vectors by length over many tasks and keeps them as blocks of ``BLOCK``
vectors, one row each. The blocks of longest vectors give every query a first k-th best score.
Then every query block meets every vector block in a task that holds just these two; a pair
of blocks returns at most k rows per query, only those that reach the first score, and the
best k of them are taken by a window per query.

Defined cases: vectors that are null or hold null or non-finite components take no part; an
empty vector scores 0; shorter vectors count as continued by zeros; where a component is beyond
2 ** 24 / scale in size, scores are Python's whole numbers and rank as such, and those that leave 64
bits are returned as the least or greatest number of 64 bits; ties go to the smaller id;
null ids take no part; rows that repeat an id are separate candidates, and one of them asks
as a query; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import (
    BinaryType, DoubleType, LongType, StructField, StructType,
)

from pixelweave.workspace import materialize

BLOCK = 4_096
QUERY_BLOCK = 1_024
# Leading rotated coordinates that are multiplied before the bound is taken.
LEADING = 16
# Vectors of one block that are looked at together.
STEP = 512

_BLOCK = StructType([
    StructField("longest", DoubleType()), StructField("ids", BinaryType()), StructField("vectors", BinaryType()),
])
# ``exact`` orders scores that 64 bits cannot tell apart; null where they can.
_FOUND = StructType([*(StructField(n, LongType()) for n in ("query_id", "vec_id", "score")),
                     StructField("exact", BinaryType())])

# Largest component of whole-number products in 64 bits; bytes of an exact score.
_PLAIN, _EXACT_BYTES = 1 << 24, 300


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component as a double, which is exact where ``scale`` is a power of
    two; null if a component is null or not finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))

    def whole(x: Column) -> Column:
        y = x.cast("double") * scale
        # Doubles from 2 ** 52 on are whole, and too large for the function.
        return F.when(F.abs(y) < float(1 << 52), F.floor(y).cast("double")).otherwise(y)

    return F.when(good, F.transform(vector, whole))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    rows = column.to_pylist()
    matrix = np.zeros((len(rows), dims))
    for place, row in zip(matrix, rows):
        place[: len(row)] = row
    return matrix


def _exact_scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Products of whole numbers of any size."""
    own = [int(x) for x in query.tolist()]
    return np.array([sum(int(x) * y for x, y in zip(row, own)) for row in vectors.tolist()], object)


def _ordered(score: int) -> bytes:
    """Bytes that sort as the scores do."""
    return (score + (1 << 8 * _EXACT_BYTES - 1)).to_bytes(_EXACT_BYTES, "big")


def _blocks(dims: int, size: int, kind: str):
    """Pack sorted rows (id, vector) into blocks of numbers of a kind."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            matrix = _matrix(batch.column("vector"), dims)
            for first in range(0, len(ids), size):
                part = matrix[first : first + size]
                longest = float(np.sqrt((part.astype(float) ** 2).sum(axis=1)).max())
                yield pa.RecordBatch.from_arrays([
                    pa.array([longest]), pa.array([ids[first : first + size].astype("<i8").tobytes()]),
                    pa.array([part.astype(kind).tobytes()], pa.binary()),
                ], _BLOCK.names)

    return pack


def rotation(vectors: DataFrame, dims: int, largest: float = 1.0) -> np.ndarray:
    """Right singular vectors of all vectors, strongest first, from their Gram matrix, which
    tasks sum up: ``dims`` rows leave a task."""
    schema = StructType([StructField("row", LongType()), StructField("sums", BinaryType())])

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            matrix = _matrix(batch.column("vector"), dims) / largest
            total += matrix.T @ matrix
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dims), pa.int64()), pa.array([r.tobytes() for r in total], pa.binary())], schema.names
        )

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = [np.frombuffer(v.as_py()) for v in table.column("sums")]
        return pa.table({"row": [key[0].as_py()], "sums": [np.sum(rows, axis=0).tobytes()]})

    # dims rows of dims numbers, however many vectors.
    rows = vectors.mapInArrow(gram, schema).groupBy("row").applyInArrow(add, schema).collect()
    total = np.zeros((dims, dims))
    for row in rows:
        total[row["row"]] = np.frombuffer(row["sums"])
    _, directions = np.linalg.eigh(total)
    return directions[:, ::-1]


def search(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
           floor: np.ndarray, axes: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For every query position the ids and scores of its at most k best vectors that score at
    least ``floor``; exact, ties to the smaller id, a query's own id left out."""
    lengths = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
    order = np.argsort(-lengths, kind="stable")
    ids, vectors, lengths = ids[order], vectors[order], lengths[order]
    turned, asked = vectors @ axes, queries @ axes
    lead, tail = turned[:, :LEADING], np.sqrt((turned[:, LEADING:] ** 2).sum(axis=1))
    ask_lead, ask_tail = asked[:, :LEADING], np.sqrt((asked[:, LEADING:] ** 2).sum(axis=1))
    ask_length = np.sqrt((queries.astype(float) ** 2).sum(axis=1))
    for q in range(len(queries)):
        best_ids, best = np.empty(0, np.int64), np.empty(0, np.int64)
        least = float(floor[q])
        # Bounds are computed in floating point; this is far above their error.
        slack = 1e-6 * (1 + ask_length[q] * (lengths[0] if len(lengths) else 0))
        for first in range(0, len(ids), STEP):
            if ask_length[q] * lengths[first] + slack < least:
                break  # all later vectors are shorter
            part = slice(first, first + STEP)
            bound = lead[part] @ ask_lead[q] + tail[part] * ask_tail[q] + slack
            near = np.flatnonzero(~(bound < least) & (ids[part] != query_ids[q])) + first
            if not len(near):
                continue
            exact = vectors.dtype != np.int64
            score = _exact_scores(vectors[near], queries[q]) if exact else vectors[near] @ queries[q]
            best_ids, best = np.r_[best_ids, ids[near]], np.r_[best, score]
            if exact:
                keep = sorted(range(len(best)), key=lambda i: (-best[i], best_ids[i]))[:k]
            else:
                keep = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[keep], best[keep]
            if len(best) == k:
                # Doubles of exact scores are rounded by far less than the slack.
                least = max(least, float(best[-1]))
        keep = (best >= floor[q]).astype(bool)
        yield q, best_ids[keep], best[keep]


def _score_columns(scores: list[np.ndarray], plain: bool) -> tuple[pa.Array, pa.Array]:
    """Scores in 64 bits and, if these cannot hold them all, bytes in their order."""
    whole = np.concatenate(scores)
    if plain:
        return pa.array(whole, pa.int64()), pa.nulls(len(whole), pa.binary())
    ends = np.iinfo(np.int64)
    return (pa.array([min(max(s, ends.min), ends.max) for s in whole.tolist()], pa.int64()),
            pa.array([_ordered(s) for s in whole.tolist()], pa.binary()))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, key: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best other vectors of each query.

    ``is_query`` is a condition on the columns of ``vectors``.
    """
    good = vectors.select(
        F.col(key).cast("long").alias("id"), whole_numbers(F.col(vector), scale).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where("id is not null and vector is not null")
    good = materialize(good, "ip-vectors")
    sizes = good.agg(
        F.max(F.size("vector")).alias("dims"),
        F.max(F.array_max(F.transform("vector", F.abs))).alias("largest"),
        F.count_if("asks").alias("queries"),
    ).first()
    largest = sizes["largest"] or 0.0
    plain = largest <= _PLAIN
    kind = "<i8" if plain else "<f8"
    dims = max(1, sizes["dims"] or 0)
    axes = rotation(good, dims, 1.0 if plain else largest)
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    sorted_ = good.select("id", "vector", squares.alias("square")).repartitionByRange(F.desc("square"), "id")
    sorted_ = sorted_.sortWithinPartitions(F.desc("square"), "id").select("id", "vector")
    blocks = materialize(sorted_.mapInArrow(_blocks(dims, BLOCK, kind), _BLOCK), "ip-blocks")

    n_query_blocks = max(1, -(-sizes["queries"] // QUERY_BLOCK))
    asking = good.where("asks").dropDuplicates(["id"])
    dealt = asking.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(n_query_blocks)))

    def as_block(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        matrix = _matrix(table.column("vector").combine_chunks(), dims)
        return pa.table({
            "qb": [key[0].as_py()], "query_ids": [ids.astype("<i8").tobytes()],
            "queries": [matrix.astype(kind).tobytes()],
        })

    schema = StructType([
        StructField("qb", LongType()), StructField("query_ids", BinaryType()), StructField("queries", BinaryType()),
    ])
    query_blocks = materialize(dealt.groupBy("qb").applyInArrow(as_block, schema), "ip-queries")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asked_ids = np.frombuffer(row["query_ids"], "<i8")
                floors = row.get("floors")
                floor = np.full(len(asked_ids), -np.inf) if floors is None else np.frombuffer(floors)
                found = list(search(
                    np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["vectors"], kind).reshape(-1, dims),
                    asked_ids, np.frombuffer(row["queries"], kind).reshape(-1, dims), floor, axes, k,
                ))
                if found:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate([np.full(len(i), asked_ids[q]) for q, i, _ in found]), pa.int64()),
                        pa.array(np.concatenate([i for _, i, _ in found]), pa.int64()),
                        *_score_columns([s for _, _, s in found], plain),
                    ], _FOUND.names)

    def pairs(some_blocks: DataFrame, queries: DataFrame) -> DataFrame:
        """Every block of vectors beside every block of queries, by a generated key."""
        numbered = some_blocks.withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_query_blocks - 1).cast("long"))))
        return numbered.join(queries, "qb").repartition("qb", "ids")

    best = Window.partitionBy("query_id").orderBy(F.desc("exact"), F.desc("score"), "vec_id")

    def best_of(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    # The longest vectors first: one block, from which every query gets its first k-th score.
    longest = blocks.orderBy(F.desc("longest")).limit(1)
    first = best_of(pairs(longest, query_blocks).mapInArrow(compare, _FOUND))
    first = first.groupBy("query_id").agg(F.min("score").alias("floor"), F.count("*").alias("n"))
    # Without 64 bits there is no first score to go by.
    known = (F.col("n") == k) & F.lit(plain)
    first = materialize(first.where(known).select("query_id", "floor"), "ip-floors")
    floored = dealt.select("qb", F.col("id").alias("query_id")).join(first, "query_id")

    def with_floors(key: tuple[pa.Scalar, ...], blocks: pa.Table, floors: pa.Table) -> pa.Table:
        if not blocks.num_rows:
            return pa.table({"qb": [], "query_ids": [], "queries": [], "floors": []}, schema=out_schema)
        row = blocks.to_pylist()[0]
        known = dict(zip(floors.column("query_id").to_pylist(), floors.column("floor").to_pylist()))
        asked = np.frombuffer(row["query_ids"], "<i8").tolist()
        row["floors"] = np.array([known.get(i, -np.inf) for i in asked], float).tobytes()
        return pa.Table.from_pylist([row], schema=out_schema)

    out_schema = pa.schema([("qb", pa.int64()), ("query_ids", pa.binary()), ("queries", pa.binary()), ("floors", pa.binary())])
    with_floor = StructType([*schema.fields, StructField("floors", BinaryType())])
    ready = query_blocks.groupBy("qb").cogroup(floored.groupBy("qb")).applyInArrow(with_floors, with_floor)
    found = pairs(blocks, materialize(ready, "ip-ready")).mapInArrow(compare, _FOUND)
    return best_of(found).select("query_id", "rank", "vec_id", "score")
