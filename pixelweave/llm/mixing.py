"""Mixing sources to target weights by hierarchical budgeting (operator 7).

Documents are leaves of a tree domain > language > source. A token budget flows down: every
node shares its budget among its children by weight, and no child gets more than its subtree
holds over ``max_epochs`` passes. What a child cannot take goes to its siblings by weight, and
reaches the ancestors' other children only when the whole family is full, because a node's
budget never exceeds what its subtree holds. Shares are whole tokens and add up exactly.

A leaf then takes whole epochs of its documents and a prefix of one more, in an order drawn
from a hash of seed, epoch and key. The prefix ends on a token: ``taken`` of its last document
is smaller than the document.

Only DataFrame functions are used. The tree is a table of one row per leaf. A leaf's prefix
needs running sums over a leaf that may hold a third of all documents: the order is cut into
4,096 ranges of the hash, ranges are summed with partial aggregation, running sums go over the
ranges, and only the documents of one range are sorted together.

Defined cases: null names in the tree are nodes called ``none``; null or negative token
counts are zero; documents without tokens come with the epochs that reach them; repeated rows
are documents of their own, in order of their token counts; null keys are ordered as the text
``none``; a weight that is not listed is 1; weights of zero or less and an empty table give
no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from pixelweave.workspace import materialize

LEVELS = ("domain", "lang", "source")
_HEX = 3


@dataclass(frozen=True)
class Targets:
    """Weights of the names at each level; unlisted names weigh 1."""

    domain: Mapping[str, int] = field(default_factory=dict)
    lang: Mapping[str, int] = field(default_factory=dict)
    source: Mapping[str, int] = field(default_factory=dict)

    def weight(self, level: str) -> Column:
        found = F.lit(1)
        for name, weight in getattr(self, level).items():
            found = F.when(F.col(level) == name, int(weight)).otherwise(found)
        return _big(found)


def _big(x: Column) -> Column:
    return x.cast("decimal(18,0)")


def _shares(nodes: DataFrame, parents: list, name: str) -> DataFrame:
    """Add ``share`` to children with ``weight``, ``holds`` (what the subtree can give) and
    ``budget`` (of the parent).

    Children are full from the smallest ratio of ``holds`` to ``weight`` on, while the rest
    by weight is more than they hold; the others divide what is left, cut at whole tokens of
    the running weight so that nothing is lost.
    """
    family = Window.partitionBy(*parents)
    by_ratio = family.orderBy(F.col("holds").cast("double") / F.col("weight").cast("double"), name)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    zero = F.lit(0).cast("decimal(18,0)")
    ranked = nodes.select(
        "*",
        _big(F.coalesce(F.sum("holds").over(before), zero)).alias("_given"),
        _big(F.sum("weight").over(onward)).alias("_heavy"),
    )
    ranked = ranked.withColumn(
        "_full",
        F.col("holds") * F.col("_heavy") <= F.col("weight") * (F.col("budget") - F.col("_given")),
    )
    left = _big(F.col("budget") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("holds"))).over(family), zero))
    open_weight = F.when(~F.col("_full"), F.col("weight"))
    by_name = family.orderBy(name)
    upto = _big(F.coalesce(F.sum(open_weight).over(by_name.rowsBetween(Window.unboundedPreceding, Window.currentRow)), zero))
    total = _big(F.sum(open_weight).over(family))
    cut = ranked.select("*", left.alias("_left"), upto.alias("_upto"), total.alias("_total"))
    end = F.expr("_left * _upto div _total")
    start = F.expr("_left * (_upto - weight) div _total")
    share = F.when(F.col("_full"), F.col("holds")).otherwise(end - start)
    return cut.withColumn("share", _big(share)).drop("_given", "_heavy", "_full", "_left", "_upto", "_total")


def plan(leaves: DataFrame, targets: Targets, budget: Column, max_epochs: int) -> DataFrame:
    """Per leaf its ``share`` of the budget in tokens, from ``leaves`` (the levels, ``held``).

    ``budget`` is a column over the whole table's ``held``, such as ``F.sum("held") / 2``.
    """
    weighed = leaves.select(*LEVELS, _big(F.col("held")).alias("held"))
    for level in LEVELS:
        weighed = weighed.withColumn(f"w_{level}", targets.weight(level))
    weighed = weighed.where(" and ".join(f"w_{level} > 0" for level in LEVELS) + " and held > 0")
    weighed = weighed.withColumn("holds", _big(F.col("held") * max_epochs))
    whole = leaves.agg(_big(F.floor(budget))).first()[0] or 0
    above, parents = None, []
    for i, level in enumerate(LEVELS):
        nodes = weighed.groupBy(*LEVELS[: i + 1]).agg(
            F.first(f"w_{level}").alias("weight"), _big(F.sum("holds")).alias("holds")
        )
        # All nodes of the first level are one family.
        family = parents or [F.lit(0)]
        given = nodes.join(above, parents) if parents else nodes.withColumn("budget", _big(F.lit(whole)))
        children = given.withColumn(
            "budget", F.least("budget", _big(F.sum("holds").over(Window.partitionBy(*family))))
        )
        parents = list(LEVELS[: i + 1])
        above = _shares(children, family, level).select(*parents, F.col("share").alias("budget"))
    return above.withColumnRenamed("budget", "share").join(
        weighed.select(*LEVELS, F.col("held")), list(LEVELS)
    )


def draw(epoch: Column, seed: int, key: Column) -> Column:
    """Place of a document in an epoch's order: 32 hex digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit("none"))))


def mix(docs: DataFrame, targets: Targets, budget: Column, max_epochs: int = 1, seed: int = 0,
        key: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """One row per document and epoch that the mix takes: key, levels, ``epoch``,
    ``tokens`` of the document and ``taken`` of them.

    ``docs`` has the columns of ``LEVELS``, a key and a token count.
    """
    narrow = docs.select(
        F.col(key).alias("key"),
        *(F.coalesce(F.col(level).cast("string"), F.lit("none")).alias(level) for level in LEVELS),
        F.greatest(F.coalesce(F.col(tokens), F.lit(0)), F.lit(0)).cast("long").alias("tokens"),
    )
    narrow = materialize(narrow, "mix-docs")
    leaves = narrow.groupBy(*LEVELS).agg(F.sum("tokens").alias("held"))
    shared = plan(leaves, targets, budget, max_epochs)
    epochs = F.floor(F.col("share") / F.col("held")).cast("long")
    shared = shared.select(
        *LEVELS,
        epochs.alias("whole"),
        (F.col("share").cast("long") - epochs * F.col("held").cast("long")).alias("rest"),
    )
    shared = materialize(shared, "mix-plan")
    # The plan is a table of one row per leaf; a large leaf is split by adaptive execution.
    placed = narrow.join(shared, list(LEVELS))
    placed = placed.withColumn("place", draw(F.col("whole"), seed, F.col("key")))
    placed = placed.withColumn("range", F.substring("place", 1, _HEX))
    spot = [*LEVELS, "range"]
    ranges = placed.where("rest > 0").groupBy(*spot, "rest").agg(F.sum("tokens").alias("sum"))
    upto = Window.partitionBy(*LEVELS).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("sum").over(upto), F.lit(0)))
    ranges = materialize(ranges.where("before < rest").select(*spot, "before"), "mix-ranges")
    inside = Window.partitionBy(*spot).orderBy("place", "key", "tokens")
    start = F.col("before") + F.sum("tokens").over(
        inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ) - F.col("tokens")
    prefix = (
        placed.where("rest > 0")
        .join(ranges, spot)
        .withColumn("start", start)
        .where("start < rest")
        .select("key", *LEVELS, F.col("whole").alias("epoch"), "tokens",
                F.least("tokens", F.col("rest") - F.col("start")).alias("taken"))
    )
    passes = (
        placed.where("whole > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)))
        .select("key", *LEVELS, "epoch", "tokens", F.col("tokens").alias("taken"))
    )
    return passes.union(prefix).withColumnRenamed("key", key)
