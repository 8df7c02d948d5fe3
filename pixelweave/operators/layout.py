"""Chunks, batches, minibatches, limits, caps and epochs, all derived from positions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from pixelweave import fixed
from pixelweave.operators.numbering import (
    TOP,
    Order,
    _columns,
    first_rows,
    running_total,
    upto_bounds,
    with_position,
)
from pixelweave.workspace import one_row

# Images one task reads or decodes. As full-size tensors they take about 150 MB.
IMAGES_PER_TASK = 256
# Tasks that rows are dealt to; beyond it tasks grow, whose memory is bounded by their batches.
MOST_TASKS = 10_000


def _div(c: str, size: int) -> Column:
    return F.expr(f"`{c}` div {int(size)}")


def spread(df: DataFrame, order_by: Order, rows_per_task: int = IMAGES_PER_TASK) -> DataFrame:
    """Deal narrow rows that each stand for heavy work, such as a file to decode, to tasks.

    Spark sizes tasks by bytes, which would leave thousands of file names to one task. The
    rows of a task are neighbours in the given order.
    """
    keys = _columns(order_by)
    tasks = min(MOST_TASKS, max(1, -(-df.count() // rows_per_task)))
    return df.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)


def order_by_path(df: DataFrame, path: str = "path") -> DataFrame:
    """All image kinds merged and sorted together."""
    return df.orderBy(path)


def order_batches(df: DataFrame) -> DataFrame:
    """Batches in numeric order, so that batch 2 comes before batch 10."""
    return df.orderBy("batch_id")


def stable_order(df: DataFrame) -> DataFrame:
    """Rows in chunk order, then in position order."""
    return df.orderBy("chunk_id", "pos")


def assign_chunk(df: DataFrame, size: int = fixed.CHUNK_SIZE, pos: str = "pos") -> DataFrame:
    """Chunk of every row. Assign before rows are dropped, so that gaps stay visible."""
    return df.withColumn("chunk_id", _div(pos, size))


def pack_batches(
    df: DataFrame,
    per_batch: int = fixed.CHUNKS_PER_BATCH,
    num_batches: int | None = None,
) -> DataFrame:
    """Batch of every row; optionally only the chunks of the first ``num_batches``."""
    if num_batches is not None:
        df = df.where(F.col("chunk_id") < num_batches * per_batch)
    return df.withColumn("batch_id", _div("chunk_id", per_batch))


def minibatch(df: DataFrame, size: int = fixed.MINIBATCH_SIZE, pos: str = "pos") -> DataFrame:
    """Training step of every row; the last step may be short."""
    return df.withColumn("step", _div(pos, size))


def batch_ranges(sizes: DataFrame) -> DataFrame:
    """Row range ``[start, end)`` of every batch from ``(batch_id, n)``."""
    totals = running_total(sizes, "batch_id", "n", "end")
    return totals.withColumn("start", F.col("end") - F.col("n"))


def first_gap(ids: DataFrame, column: str = "chunk_id") -> DataFrame:
    """One row: the smallest id, counted from 0, that does not occur.

    The gap follows an id that occurs (or is 0), so an anti join finds it without
    ordering the ids.
    """
    present = ids.select(F.col(column).alias("id")).distinct()
    zero = one_row(ids.sparkSession).select(F.col("id").cast("bigint"))
    following = present.select((F.col("id") + 1).alias("id")).unionByName(zero)
    return following.join(present, "id", "left_anti").agg(F.min("id").alias("first_gap"))


def filter_limit(df: DataFrame, predicate: Column, n: int, order_by: Order) -> DataFrame:
    """First ``n`` rows that satisfy the predicate; none when ``n`` is not positive."""
    return head(df.where(predicate), n, order_by)


def limit_filter(df: DataFrame, n: int, predicate: Column, order_by: Order) -> DataFrame:
    """Those of the first ``n`` rows that satisfy the predicate."""
    return head(df, n, order_by).where(predicate)


def head(df: DataFrame, n: int, order_by: Order) -> DataFrame:
    """First ``n`` rows."""
    return first_rows(df, order_by, n) if n > 0 else df.limit(0)


def cap_per_split(
    df: DataFrame,
    caps: Mapping[str, int] | None = None,
    order_by: Order = "path",
    split: str = "split",
) -> DataFrame:
    """At most ``caps[split]`` rows per split; a split without a cap keeps all its rows.

    The position within the split stays in column ``pos``. With small caps every task sends the
    first rows of each split. Beyond it one scan bounds all caps, and only rows that may lie
    within a cap are sorted and written.
    """
    caps = {s: max(n, 0) for s, n in (caps or {}).items()}
    if not caps:
        return with_position(df, order_by, by=split)
    wanted = {s: n for s, n in caps.items() if n}
    uncapped = F.col(split).isNull() | ~F.col(split).isin(list(caps))
    limit = F.coalesce(*[F.when(F.col(split) == s, F.lit(n)) for s, n in caps.items()])
    if max(caps.values()) > TOP:
        rows = df.where(uncapped | F.col(split).isin(list(wanted)))
        numbered = with_position(upto_bounds(rows, order_by, wanted, split), order_by, by=split)
        return numbered.where(limit.isNull() | (F.col("pos") < limit))
    rank = F.row_number().over(Window.partitionBy(split).orderBy(*_columns(order_by)))
    first = df.where(F.col(split).isin(list(wanted))).withColumn("pos", rank)
    # Each task cuts its rows of a split to the largest cap before any row is moved.
    first = first.where(F.col("pos") <= max(caps.values())).withColumn("pos", F.col("pos").cast("bigint") - 1)
    capped = first.where(F.col("pos") < limit)
    others = df.where(uncapped)
    if others.isEmpty():
        return capped
    return capped.unionByName(with_position(others, order_by, by=split))


def repeat_epochs(df: DataFrame, n: int) -> DataFrame:
    """Every row once per epoch, none without epochs. Rows are copied in place by a generator."""
    if n < 0:
        raise ValueError("the number of epochs must not be negative")
    if n == 0:
        return df.withColumn("epoch", F.lit(0)).limit(0)
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def shuffle_key(seed: int, epoch: Column | str, key: Column | str) -> Column:
    """Pseudo-random sort key of a row in an epoch."""
    epoch = F.col(epoch) if isinstance(epoch, str) else epoch
    key = F.col(key) if isinstance(key, str) else key
    text = F.concat_ws("-", F.lit(str(seed)), epoch.cast("string"), key.cast("string"))
    return F.md5(text.cast("binary"))


def shuffle_seeded(df: DataFrame, seed: int, key: str, epoch: str | None = None) -> DataFrame:
    """Reproducible global permutation: position of every row, within its epoch if given."""
    mixed = df.withColumn("__mix", shuffle_key(seed, epoch or F.lit(0), key))
    groups = (epoch,) if epoch else ()
    return with_position(mixed, ["__mix", key], by=groups).drop("__mix")


def shuffle_buffered(
    df: DataFrame, seed: int, key: str, size: int, rows: int,
    pos: str = "pos", epoch: str | None = None, epochs: int = 1,
) -> DataFrame:
    """Permutation that moves no row by ``size`` places or more: new place in ``shuffled``.

    ``pos`` are dense positions ``0 .. rows - 1``, within each of ``epochs`` if ``epoch`` names
    their column; epochs follow
    one another without a border, so rows near it mix as in a buffer that is filled on. A row's
    sort key is its place plus a draw below ``size`` from seed, epoch and row key. Rows of one
    block of sort keys come from the block of places of the same number and the one before it, so
    a block's rows know their places by themselves: all earlier places are taken but those of rows
    that moved in. One exchange by block, at most twice ``size`` rows in a window, no sort of the
    table, no join.
    """
    if size < 1:
        raise ValueError("the buffer must hold at least one row")
    at = F.col(pos).cast("bigint")
    if epoch is not None:
        at = at + F.col(epoch).cast("bigint") * F.lit(rows)
    drawn = F.conv(F.substring(shuffle_key(seed, epoch or F.lit(0), key), 1, 12), 16, 10)
    placed = df.withColumn("__at", at).withColumn("__to", at + F.pmod(drawn.cast("bigint"), F.lit(size)))
    blocks = placed.withColumn("__block", _div("__to", size))
    window = Window.partitionBy("__block")
    moved_in = F.sum(F.when(_div("__at", size) < F.col("__block"), 1).otherwise(0)).over(window)
    before = F.least(F.col("__block") * size, F.lit(rows * (epochs if epoch else 1)).cast("bigint")) - moved_in
    rank = F.row_number().over(window.orderBy("__to", "__at")) - 1
    return blocks.withColumn("shuffled", before + rank).drop("__at", "__to", "__block")


def preshuffle(
    df: DataFrame, seed: int, key: str, size: int = fixed.CHUNK_SIZE
) -> DataFrame:
    """Chunks of a permuted table, so that neighbours in a chunk are unrelated."""
    return assign_chunk(shuffle_seeded(df, seed, key), size)
