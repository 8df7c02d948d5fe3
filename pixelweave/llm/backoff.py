"""Stupid-backoff scores from n-gram tables (operator 3).

A document's score is the mean, over its words, of the logarithm of the backed-off relative
frequency of a word after the one before it: count(pair) / count(first word) if the pair
occurs, else ``BACKOFF`` times the share of the word among all words. All counts are over
all *other* documents: what a document counts itself is taken off the corpus's counts, as
otherwise every pair would have been seen. A word that no other document has counts one half.

The tables are relational. Documents are dealt into blocks of about ``BLOCK`` by a hash of
their key and travel there compressed. A block's n-grams, counted once per block, are exploded into rows (gram, block,
count) that lie in buckets of the gram's hash; a bucket's rows are summed into its part of the
count table and get their gram's total in the partition where the bucket lies, by a window, so
that n-grams cross the network once. The counts that a block cannot know by itself, of
n-grams that other blocks have too, return to it, and its documents sum up their scores.

Counting per block first bounds what a frequent n-gram sends: one row per block, whatever its
frequency. An n-gram travels as the 64-bit hash of its words; rows of one block and bucket
are packed into arrays for the shuffle only.

Defined cases: words are runs of characters other than x20 and x09-x0D with A-Z lower-cased; a
text without words has score null and n_words 0; rows that repeat a key are documents of their
own; null keys form documents too; in a corpus of one document every word is unseen; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, DoubleType, IntegerType, LongType, StructField, StructType,
)

from pixelweave.llm.text import texts

BACKOFF = 0.4
UNSEEN = 0.5
# Documents of a block, and buckets per shuffle partition.
BLOCK = 3_000
BUCKETS_PER_PARTITION = 4
# Documents of a block that are scored at a time.
_TOGETHER = 250


class _Places(dict):
    """Number of every word met, in the order of first sight."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


def _pairs(words: np.ndarray) -> np.ndarray:
    """Hash of every pair of neighbouring words, an odd number."""
    u = np.uint64
    x = words[:-1] * u(0x9E3779B97F4A7C15) + (words[1:] ^ (words[1:] >> u(32))) * u(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> u(29)) | u(1)


class _Block:
    """Words and pairs of a block's documents, one after the other.

    ``at`` is the place of every word among the block's distinct ones, whose hashes are even
    numbers; document i's words are those from ``ends[i]`` to ``ends[i + 1]``. ``grams`` are the
    distinct words and then the distinct pairs with their ``counts``; in ``order`` they stand by
    bucket, and bucket ``used[i]`` begins at ``starts[i]`` there.
    """

    def __init__(self, documents: list[bytes], n_buckets: int):
        import xxhash

        known, found = _Places(), []
        for text in documents:
            words = text.lower().split()  # lowers A-Z only
            found.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
        self.ends = np.cumsum([0, *map(len, found)])
        hashes = np.fromiter((xxhash.xxh64_intdigest(w, 1) for w in known), np.uint64, len(known))
        del known
        words, rank = np.unique(hashes & ~np.uint64(1), return_inverse=True)
        self.at = rank[np.concatenate(found)] if found else np.empty(0, np.int64)
        del found
        self.n_words = len(words)
        pairs, n = np.unique(_pairs(words[self.at])[self.later(0, len(documents)) - 1], return_counts=True)
        self.grams = np.concatenate([words, pairs])
        self.counts = np.concatenate([np.bincount(self.at, minlength=len(words)), n])
        bucket = (self.grams >> np.uint64(20)) % np.uint64(n_buckets)
        self.order = np.argsort(bucket, kind="stable")
        self.used, self.starts = np.unique(bucket[self.order], return_index=True)

    def later(self, first: int, last: int) -> np.ndarray:
        """Places of the words of documents ``first`` to ``last`` that have one before them in
        their document, counted from where these documents begin."""
        begin = self.ends[first : last + 1] - self.ends[first]
        follows = np.ones(begin[-1], bool)
        follows[begin[:-1][begin[:-1] < begin[-1]]] = False
        return np.flatnonzero(follows)


def _own(documents: np.ndarray, grams: np.ndarray, n_grams: int) -> np.ndarray:
    """How often each entry's gram, a number below ``n_grams``, occurs in the entry's document."""
    _, place, n = np.unique(documents * n_grams + grams, return_inverse=True, return_counts=True)
    return n[place]


def _scores(block: _Block, totals: np.ndarray, n_corpus: int) -> list[float | None]:
    """Mean log score of every document, from the corpus's counts of the block's grams."""
    words, pairs = block.grams[: block.n_words], block.grams[block.n_words :]
    word_total, pair_total = totals[: block.n_words], totals[block.n_words :]
    found: list[float | None] = []
    for first in range(0, len(block.ends) - 1, _TOGETHER):
        last = min(first + _TOGETHER, len(block.ends) - 1)
        ends = block.ends[first : last + 1]
        sizes = np.diff(ends)
        at, document = block.at[ends[0] : ends[-1]], np.repeat(np.arange(last - first), sizes)
        c_word = word_total[at] - _own(document, at, block.n_words)
        share = np.maximum(c_word, UNSEEN) / np.maximum(n_corpus - sizes, 1)[document]
        score = np.log(share)
        later = block.later(first, last)
        distinct, own = np.unique(_pairs(words[at])[later - 1], return_inverse=True)
        c_pair = pair_total[np.searchsorted(pairs, distinct)][own] - _own(document[later], own, len(distinct))
        seen = np.log(np.maximum(c_pair, 1) / np.maximum(c_word[later - 1], 1))
        score[later] = np.where(c_pair > 0, seen, np.log(BACKOFF * share[later]))
        for a, b in itertools.pairwise((ends - ends[0]).tolist()):
            found.append(float(score[a:b].mean()) if b > a else None)
    return found


_CARRIED = StructType([
    StructField("block", LongType()), StructField("ids", ArrayType(LongType())),
    StructField("sizes", ArrayType(IntegerType())), StructField("data", BinaryType()),
])
_PACKED = StructType([
    StructField("bucket", LongType()), StructField("block", LongType()),
    StructField("grams", ArrayType(LongType())), StructField("counts", ArrayType(IntegerType())),
])
_SCORED = StructType([
    StructField("doc_id", LongType()), StructField("n_words", LongType()), StructField("score", DoubleType()),
])


def _carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, id, text) as one compressed row per block of a batch."""
    import zstandard

    compressor = zstandard.ZstdCompressor(3)
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        order = np.argsort(blocks, kind="stable")
        ids = batch.column("id").to_pylist()
        data = [t.encode("utf-8", "surrogatepass") for t in texts(batch.column("text"))]
        used, starts = np.unique(blocks[order], return_index=True)
        rows = []
        for block, members in zip(used.tolist(), np.split(order, starts[1:])):
            own = [data[i] for i in members]
            rows.append((block, [ids[i] for i in members], [len(d) for d in own], compressor.compress(b"".join(own))))
        if rows:
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], _CARRIED.names)


def _documents(table: pa.Table) -> tuple[list[int | None], list[bytes]]:
    """Keys and texts of a block."""
    import zstandard

    decompressor = zstandard.ZstdDecompressor()
    ids, documents = [], []
    for row in table.to_pylist():
        data = decompressor.decompress(row["data"])
        ends = np.cumsum(row["sizes"]).tolist()
        documents += [data[a:b] for a, b in zip([0, *ends], ends)]
        ids += row["ids"]
    return ids, documents


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words and score (mean natural logarithm) of every document."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    n_blocks = max(1, -(-docs.count() // BLOCK))
    n_buckets = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Repeated keys may gather in a block, so the text takes part in dealing.
    blocked = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)))
    carried = blocked.select("block", "id", "text").mapInArrow(_carry, _CARRIED)

    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        block = _Block(_documents(table)[1], n_buckets)
        ends = pa.array(np.r_[block.starts, len(block.order)], pa.int32())
        return pa.table({
            "bucket": pa.array(block.used.astype(np.int64)),
            "block": pa.array(np.full(len(block.used), key[0].as_py()), pa.int64()),
            "grams": pa.ListArray.from_arrays(ends, pa.array(block.grams[block.order].view(np.int64))),
            "counts": pa.ListArray.from_arrays(ends, pa.array(block.counts[block.order], pa.int32())),
        })

    packed = carried.groupBy("block").applyInArrow(count, _PACKED).repartition(F.col("bucket"))
    exploded = packed.select("bucket", "block", F.posexplode(F.arrays_zip("grams", "counts")).alias("place", "x"))
    grams = exploded.select("bucket", "block", "place", F.col("x.grams").alias("gram"), F.col("x.counts").alias("n"))
    # The count table is summed where the bucket lies, and each row meets its gram's total there:
    # a window over the bucket's grams is that table joined back without a second exchange. The
    # gram comes first in the sort, as it tells rows apart; a frequent gram has a row per block.
    total = F.sum("n").over(Window.partitionBy("gram", "bucket"))
    # What only one block has, that block knows. A reply names a gram by its place in the block.
    elsewhere = grams.withColumn("total", total).where(F.col("total") > F.col("n"))
    replies = elsewhere.groupBy("bucket", "block").agg(
        F.collect_list("place").alias("places"), F.collect_list("total").alias("totals")
    )
    n_corpus = rows.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0] or 0

    def sum_up(key: tuple[pa.Scalar, ...], carried: pa.Table, replies: pa.Table) -> pa.Table:
        ids, documents = _documents(carried)
        block = _Block(documents, n_buckets)
        totals = block.counts.astype(np.int64)
        start_of = dict(zip(block.used.tolist(), block.starts.tolist()))
        columns = [replies.column(c) for c in ("bucket", "places", "totals")]
        for bucket, places, found in zip(*columns):
            at = block.order[start_of[bucket.as_py()] + places.values.to_numpy()]
            totals[at] = found.values.to_numpy()
        return pa.table({
            "doc_id": pa.array(ids, pa.int64()),
            "n_words": pa.array(np.diff(block.ends), pa.int64()),
            "score": pa.array(_scores(block, totals, n_corpus), pa.float64()),
        })

    return carried.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(sum_up, _SCORED)
