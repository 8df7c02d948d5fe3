"""Pairing, lookup and range assignment.

No join carries a hint: Catalyst broadcasts a side by its measured size and otherwise
shuffles, with skewed partitions split at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pixelweave.functions import labels as L
from pixelweave.operators.numbering import Order, with_position
from pixelweave.workspace import one_row

# Positions per bin of the range assignment.
_BIN = 65_536
# Modulus of the checksums: sums of 2^32 of them fit 64 bits.
_PRIME = 2**31 - 1


def class_list(spark: SparkSession, classes: Sequence, label: str = "label") -> DataFrame:
    """Class list as a table ``(class_idx, label)``."""
    literal = F.array(*[F.lit(c) for c in classes])
    return one_row(spark).select(F.posexplode(literal).alias("class_idx", label))


def zip_by_position(
    left: DataFrame, right: DataFrame, order_l: Order, order_r: Order
) -> DataFrame:
    """Pair the n-th row of each side and stop at the shorter one."""
    return with_position(left, order_l).join(with_position(right, order_r), "pos", "inner")


def lookup_join(df: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` with the columns of ``small`` that share the key."""
    return df.join(small, key, "inner")


def exists_in(df: DataFrame, listing: DataFrame, on: str, anti: bool = False) -> DataFrame:
    """Rows whose key is, or with ``anti`` is not, in the listing."""
    return df.join(listing.select(on), on, "left_anti" if anti else "left_semi")


def semi_join_classes(df: DataFrame, classes: DataFrame, label: str = "label") -> DataFrame:
    """Rows whose label is in the class list."""
    return df.join(classes.select(label), label, "left_semi")


def encode_label(
    df: DataFrame, classes: Sequence, mode: str = "fixed", label: str = "label"
) -> DataFrame:
    """Add ``class_idx``. An unknown label is an error.

    ``fixed`` keeps the index an absent class leaves unused; ``present`` numbers only the
    classes that occur.
    """
    if mode == "present":
        kept = present_classes(df, classes, label)
        # One row per class that occurs, at most the length of the caller's list.
        classes = [row[label] for row in kept.orderBy("class_idx").collect()]
    elif mode != "fixed":
        raise ValueError(f"unknown mode {mode!r}")
    return df.withColumn("class_idx", L.label_index(label, classes))


def unknown_labels(df: DataFrame, classes: DataFrame, label: str = "label") -> DataFrame:
    """Labels missing from the class list, with their row counts; empty when all match."""
    unmatched = df.join(classes.select(label), label, "left_anti")
    return unmatched.groupBy(label).agg(F.count("*").alias("n"))


def present_classes(df: DataFrame, classes: Sequence, label: str = "label") -> DataFrame:
    """Classes that occur, in list order, with their compacted index and row count."""
    counts = (
        df.where(F.col(label).isin(list(classes)))
        .groupBy(label)
        .agg(F.count("*").alias("n"))
    )
    listed = class_list(df.sparkSession, classes, label)
    # At most one row per listed class reaches this window.
    compact = F.row_number().over(Window.orderBy("class_idx")) - 1
    return listed.join(counts, label, "inner").select(
        compact.cast("int").alias("class_idx"), label, "n"
    )


def zero_fill(counts: DataFrame, classes: DataFrame, label: str = "label") -> DataFrame:
    """Every class with its count, 0 where there is none."""
    filled = F.coalesce(F.col("n"), F.lit(0).cast("bigint")).alias("n")
    return classes.join(counts, label, "left").select("class_idx", label, filled)


def realign(images: DataFrame, labels: DataFrame) -> DataFrame:
    """Image rows with the label at the same chunk and position."""
    return images.join(labels, ["chunk_id", "pos"], "inner")


def realign_report(images: DataFrame, labels: DataFrame) -> DataFrame:
    """Images, labels and matches per chunk; the three agree in a sound data set."""
    sides = images.select("chunk_id", "pos", F.lit(1).alias("i"), F.lit(0).alias("l")).unionByName(
        labels.select("chunk_id", "pos", F.lit(0).alias("i"), F.lit(1).alias("l"))
    )
    cells = sides.groupBy("chunk_id", "pos").agg(F.sum("i").alias("i"), F.sum("l").alias("l"))
    return cells.groupBy("chunk_id").agg(
        F.sum("i").alias("n_images"),
        F.sum("l").alias("n_labels"),
        F.sum(F.least("i", "l")).alias("n_matched"),
    )


def chunk_checksums(df: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """Rows, first and last position and two checksums ``(chunk_id, n, first, last, a, b)``.

    A checksum is the sum, over a chunk's rows, of a hash of position and key taken modulo a prime
    below 2^31, so parts of a chunk add up in any order, every task sends one row per chunk, and
    rows that swap places, are lost or are repeated change it.
    """
    def checksum(seed: int) -> Column:
        mixed = F.xxhash64(F.lit(seed), F.col(pos).cast("bigint"), F.col(key))
        return F.sum(F.pmod(mixed, F.lit(_PRIME)))

    return df.groupBy("chunk_id").agg(
        F.count("*").alias("n"), F.min(pos).alias("first"), F.max(pos).alias("last"),
        checksum(1).alias("a"), checksum(2).alias("b"),
    )


def alignment_report(images: DataFrame, labels: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """Rows of both sides per chunk and whether they hold the same keys at the same positions.

    Only checksums of chunks meet, not rows; ``realign_report`` counts the rows of those chunks
    that differ. Two different chunks pass as equal with a chance of about 2^-62.
    """
    ours, theirs = chunk_checksums(images, key, pos), chunk_checksums(labels, key, pos)
    both = ours.alias("i").join(theirs.alias("l"), F.col("i.chunk_id").eqNullSafe(F.col("l.chunk_id")), "full")
    same = F.lit(True)
    for c in ("n", "first", "last", "a", "b"):
        same = same & F.col(f"i.{c}").eqNullSafe(F.col(f"l.{c}"))
    return both.select(
        F.coalesce("i.chunk_id", "l.chunk_id").alias("chunk_id"),
        F.coalesce("i.n", F.lit(0).cast("bigint")).alias("n_images"),
        F.coalesce("l.n", F.lit(0).cast("bigint")).alias("n_labels"),
        same.alias("aligned"),
    )


def assign_batch_range(df: DataFrame, ranges: DataFrame, pos: str = "pos") -> DataFrame:
    """Add the ``batch_id`` whose ``[start, end)`` holds the row's position.

    Ranges must not overlap and positions must be unique, as batch ranges and dense
    positions are. Both sides are cut into bins of positions; inside a bin the last range
    start at or before a row wins. No candidate pairs are formed, a bin holds at most as
    many rows as it has positions, and a long range simply spans many bins.
    """
    def bin_of(c: Column) -> Column:
        return F.floor(c / F.lit(_BIN)).cast("bigint")

    pieces = (
        ranges.where(F.col("start") < F.col("end"))
        .withColumn("__bin", F.explode(F.sequence(bin_of(F.col("start")), bin_of(F.col("end") - 1))))
        .select(
            "__bin",
            F.greatest(F.col("start"), F.col("__bin") * _BIN).alias("__at"),
            F.struct("batch_id", "end").alias("__range"),
        )
    )
    row = F.struct(*[F.col(c) for c in df.columns])
    rows = df.select(
        bin_of(F.col(pos)).alias("__bin"), F.col(pos).cast("bigint").alias("__at"), row.alias("__row")
    )
    both = rows.unionByName(pieces, allowMissingColumns=True)
    # At one position the range (which has no row) sorts before the row it covers.
    order = Window.partitionBy("__bin").orderBy(F.col("__at"), F.col("__row").isNotNull())
    covering = F.last("__range", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        both.withColumn("__range", covering)
        .where(F.col("__row").isNotNull() & (F.col("__at") < F.col("__range.end")))
        .select("__row.*", F.col("__range.batch_id").alias("batch_id"))
    )
