"""Dense global positions and running totals without a single-task window.

A window over the whole table would sort every row in one task. Here the table is sorted
by range over all tasks and written once; a row then knows its sort partition and its
place inside it. The only thing gathered is one count (or sum) per sort partition, whose
number is bounded by ``spark.sql.shuffle.partitions`` and not by the data.
"""

from __future__ import annotations

import bisect
import contextlib
import math
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pixelweave.workspace import materialize

Order = str | Column | Sequence["str | Column"]

# Layout of monotonically_increasing_id: partition above, row number within it below.
_ROW_BITS = 33
_SLOT = "__slot"

# Growth of the ranks that a sketch of keys keeps, and task sketches merged at a time.
_GROWTH = 1.1
_MERGED = 256
# First rows, of a group at most, that each task may send to one task.
TOP = 1_000
# Rows behind a bound that one task may sort; beyond it they are sorted by all tasks.
_ONE_TASK = 100_000


def _columns(spec: Order) -> list:
    return [spec] if isinstance(spec, (str, Column)) else list(spec)


def _sort_partition() -> Column:
    return F.shiftright(F.col(_SLOT), _ROW_BITS).cast("int")


def _sorted_table(df: DataFrame, keys: list) -> DataFrame:
    ranked = df.orderBy(*keys).withColumn(_SLOT, F.monotonically_increasing_id())
    return materialize(ranked, "sorted")


def with_place(df: DataFrame, name: str = "place") -> DataFrame:
    """Add the 0-based place of every row in the order the table is in, as a bigint.

    The table is written as it is; after a sort the places show the order that a reader of all
    partitions in turn would meet.
    """
    table = materialize(df.withColumn(_SLOT, F.monotonically_increasing_id()), "placed")
    within = F.col(_SLOT).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return table.withColumn(name, _start_of_partition(table, F.count("*")) + within).drop(_SLOT)


def _partition_starts(table: DataFrame, amount: Column) -> list[int]:
    """Total of ``amount`` over all earlier sort partitions, for every sort partition."""
    per_partition = table.groupBy(_sort_partition().alias("p")).agg(amount.alias("n"))
    sums = {row["p"]: row["n"] or 0 for row in per_partition.collect()}
    starts, running = [], 0
    for p in range(max(sums, default=0) + 1):
        starts.append(running)
        running += sums.get(p, 0)
    return starts


def _start_of_partition(table: DataFrame, amount: Column) -> Column:
    return _folded(_partition_starts(table, amount))


def _folded(numbers: list[int]) -> Column:
    """The row's sort partition's entry; one folded literal, however many partitions."""
    text = ",".join(map(str, numbers))
    return F.get(F.split(F.lit(text), ",").cast("array<bigint>"), _sort_partition())


def _carried(table: DataFrame, groups: list) -> list[int]:
    """For every sort partition, the rows of its first group in the partitions before it.

    A group is contiguous in the sort, so only the last group of a partition can go on in the
    next one. What is gathered is one row per sort partition.
    """
    key = F.struct(*[F.col(g) if isinstance(g, str) else g for g in groups]).alias("g")
    sizes = table.groupBy(_sort_partition().alias("p"), key).agg(
        F.count("*").alias("n"), F.min(_SLOT).alias("at")
    )
    ends = sizes.groupBy("p").agg(
        F.min_by("g", "at").alias("first"),
        F.max_by("g", "at").alias("last"),
        F.max_by("n", "at").alias("n"),
        F.count("*").alias("groups"),
    )
    found = {row["p"]: row for row in ends.collect()}
    carried, running, last = [], 0, None
    for p in range(max(found, default=0) + 1):
        row = found.get(p)
        if row is None:
            carried.append(0)
            continue
        start = running if last is not None and repr(row["first"]) == last else 0
        carried.append(start)
        running = row["n"] + (start if row["groups"] == 1 else 0)
        last = repr(row["last"])
    return carried


def with_position(
    df: DataFrame, order_by: Order, by: Order = (), name: str = "pos"
) -> DataFrame:
    """Add the 0-based position of every row in ``order_by`` order, as a bigint.

    ``order_by`` must be a total order (add a unique column last), otherwise equal rows
    may swap places between runs. With ``by``, positions restart in every group; groups
    may be of any size, as one group spreads over many sort partitions.

    Pass narrow rows (key, path, label) and join wide payloads back by key.
    """
    groups = _columns(by)
    table = _sorted_table(df, groups + _columns(order_by))
    within = F.col(_SLOT).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    if not groups:
        start = _start_of_partition(table, F.count("*"))
        return table.withColumn(name, start + within).drop(_SLOT)
    # A group's rows in one sort partition are numbered there; no window holds more.
    first = F.min(within).over(Window.partitionBy(_sort_partition(), *groups))
    carried = _folded(_carried(table, groups))
    start = F.when(F.col("__first") == 0, carried).otherwise(F.lit(0).cast("bigint")) - F.col("__first")
    numbered = table.withColumn("__first", first).withColumn(name, start + within)
    return numbered.drop("__first", _SLOT)


def first_rows(df: DataFrame, order_by: Order, n: int) -> DataFrame:
    """First ``n`` rows, however many.

    For small ``n`` every task sends its first ``n`` rows and one task streams through them,
    keeping ``n``. Beyond it only rows up to a bound go on, which one scan makes a little more
    than ``n`` (``bounds``), so the work behind the scans follows ``n`` and not the table. With
    keys that are no plain columns (such as descending ones) every row is sorted.
    """
    keys = _columns(order_by)
    if n <= TOP:
        return df.orderBy(*keys).limit(n)
    near = upto_bounds(df, keys, {None: n})
    if n <= _ONE_TASK and near is not df:
        return near.orderBy(*keys).limit(n)
    table = _sorted_table(near, keys)
    starts = _partition_starts(table, F.count("*"))
    last = max(bisect.bisect_left(starts, n) - 1, 0)
    end = (last << _ROW_BITS) + n - starts[last]
    return table.where(F.col(_SLOT) < end).drop(_SLOT)


def _thinned(rows: DataFrame, by: list, keys: list) -> DataFrame:
    """Those of the rows with a growing ``__rank`` before which it passes a power of the growth,
    and each group's last one; ``__w`` is the number of rows since the one kept before."""
    order = Window.partitionBy(*by).orderBy("__rank")
    step = F.floor(F.log("__rank") / math.log(_GROWTH))
    following = F.floor(F.log(F.lead("__rank").over(order)) / math.log(_GROWTH))
    kept = rows.withColumn("__kept", ~step.eqNullSafe(following)).where("__kept")
    since = F.col("__rank") - F.coalesce(F.lag("__rank").over(order), F.lit(0))
    return kept.withColumn("__w", since).select(*by, *keys, "__w")


def bounds(df: DataFrame, keys: Sequence[str], wanted: Mapping, group: str | None = None) -> dict:
    """For every group in ``wanted`` a key that at least its first ``wanted[group]`` rows do not
    exceed, or ``None`` where the group has no more rows; one scan for all groups.

    Every task ranks the first rows of each group it reads and keeps the keys at ranks that grow
    by a tenth, with the number of rows each stands for. Such lists merge: those of 256 tasks
    are put in order, summed up and thinned again, so the last step meets a few hundred keys of
    a group for every 256 tasks. A kept key vouches for rows at or below it, hence the smallest
    key whose sum reaches ``wanted`` is a true bound; rows beyond those wanted are about a fifth.
    """
    most = max(wanted.values())
    name = F.lit(None).cast("string") if group is None else F.col(group)
    rows = df.select(F.spark_partition_id().alias("__part"), name.alias("__group"), *keys)
    if group is not None:
        rows = rows.where(F.col("__group").isin(list(wanted)))
    by = ["__part", "__group"]
    order = Window.partitionBy(*by).orderBy(*keys)
    # Spark cuts each task's rows of a group to the first ones before it moves any.
    first = rows.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= most)
    sketch = _thinned(first, by, keys)

    def summed(*groups: str) -> Column:
        upto = Window.partitionBy(*groups).orderBy(*keys, "__w")
        return F.sum("__w").over(upto.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    merged = sketch.withColumn("__part", F.expr(f"__part div {_MERGED}"))
    sketch = _thinned(merged.withColumn("__rank", summed(*by)), by, keys)
    need = F.coalesce(*[
        F.when(F.col("__group").eqNullSafe(F.lit(g)), F.lit(n)) for g, n in wanted.items()
    ])
    reached = sketch.withColumn("__rank", summed("__group")).where(F.col("__rank") >= need)
    found = reached.groupBy("__group").agg(F.min(F.struct(*keys)).alias("bound"))
    with _limits_ahead_of_windows(df.sparkSession, most):
        # One row per group in ``wanted``.
        held = {row["__group"]: row["bound"] for row in found.collect()}
    return {g: held.get(g) for g in wanted}


@contextlib.contextmanager
def _limits_ahead_of_windows(spark: SparkSession, n: int) -> Iterator[None]:
    """Let Spark cut groups to ``n`` ranks inside each task, as it does for small ``n``."""
    setting = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(setting)
    if int(before) >= 0:
        spark.conf.set(setting, str(max(int(before), n + 1)))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def upto_bounds(df: DataFrame, order_by: Order, wanted: Mapping, group: str | None = None) -> DataFrame:
    """Rows that may be among the first ``wanted[group]`` of their group, by one scan's bounds;
    rows of groups that are not in ``wanted`` stay. Ascending keys only: any other order gives
    the table back."""
    keys = _columns(order_by)
    if not wanted or not all(isinstance(k, str) for k in keys):
        return df
    held = {g: b for g, b in bounds(df, keys, wanted, group).items() if b is not None}
    if not held:
        return df
    types = [df.schema[k].dataType for k in keys]
    condition = F.lit(False)
    for name, bound in held.items():
        limit = F.struct(*[F.lit(v).cast(t).alias(k) for k, v, t in zip(keys, bound, types)])
        within = F.struct(*keys) <= limit
        if bound[0] is not None:
            # Alone in a form that reaches the scan, where it skips row groups.
            ahead = F.col(keys[0]) <= F.lit(bound[0]).cast(types[0])
            within = (F.col(keys[0]).isNull() | ahead) & within
        own = F.lit(True) if group is None else F.col(group) == name
        condition = condition | (own & within)
    if group is not None:
        condition = condition | F.col(group).isNull() | ~F.col(group).isin(list(held))
    return df.where(condition)


def running_total(df: DataFrame, order_by: Order, value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over all rows up to and including the current one."""
    table = _sorted_table(df, _columns(order_by))
    start = _start_of_partition(table, F.sum(value))
    upto = (
        Window.partitionBy(_sort_partition())
        .orderBy(_SLOT)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return table.withColumn(name, start + F.sum(value).over(upto)).drop(_SLOT)
