"""Numbering, chunks, batches, limits and range assignment against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from pixelweave.operators import aggregates as A, joins, layout, sets
from pixelweave.operators.numbering import (
    _sort_partition,
    _sorted_table,
    bounds,
    first_rows,
    running_total,
    upto_bounds,
    with_position,
)
from pixelweave.sources import chunks as scans


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_positions_do_not_depend_on_partitions(any_plan, spark, partitions):
    names = [f"coco_{random.Random(5).random()}_{i:04d}" for i in range(700)]
    df = table(spark, [(n,) for n in names], "path string").repartition(partitions)
    got = {r["path"]: r["pos"] for r in with_position(df, "path").collect()}
    assert got == {n: i for i, n in enumerate(sorted(names))}


def test_small_tables_can_be_numbered_over_many_partitions(any_plan, spark):
    table = _sorted_table(spark.range(4000).repartition(6), ["id"])
    used = table.select(_sort_partition().alias("p")).distinct().count()
    assert used == 1 if any_plan == "adaptive" else used > 1


def test_positions_of_an_empty_table(spark):
    assert with_position(spark.range(0), "id").count() == 0


def test_positions_in_groups_of_very_different_size(any_plan, spark):
    # One group holds a third of the rows, another is null.
    rows = [("hot" if i % 3 == 0 else None if i % 3 == 1 else f"g{i}", i) for i in range(3000)]
    got = with_position(table(spark, rows, "g string, i int"), "i", by="g").collect()
    seen = {}
    for r in sorted(got, key=lambda r: r["i"]):
        assert r["pos"] == seen.get(r["g"], 0)
        seen[r["g"]] = r["pos"] + 1
    assert len(got) == 3000


def test_positions_with_equal_leading_keys(any_plan, spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), "id")
    got = with_position(df, ["k", "id"]).collect()
    want = sorted((r["k"], r["id"]) for r in got)
    assert [(r["k"], r["id"]) for r in sorted(got, key=lambda r: r["pos"])] == want
    assert sorted(r["pos"] for r in got) == list(range(5000))


def test_running_total(any_plan, spark):
    rng = random.Random(3)
    rows = [(i, rng.randrange(0, 9)) for i in range(2000)]
    rng.shuffle(rows)
    got = running_total(table(spark, rows, "k int, n bigint").repartition(7), "k", "n", "total").collect()
    total = 0
    for r in sorted(got, key=lambda r: r["k"]):
        total += r["n"]
        assert r["total"] == total


@pytest.mark.parametrize("n,want", [(0, 0), (1, 1), (50, 1), (51, 2), (1662, 34), (20946, 419)])
def test_chunk_count(spark, n, want):
    assert A.chunk_count(spark.range(n)).first()["chunks"] == want


@pytest.mark.parametrize("n,want", [(500, 16), (1000, 32), (1999, 63), (4999, 157)])
def test_steps_per_epoch(spark, n, want):
    assert A.steps_per_epoch(spark.range(n)).first()["steps"] == want


def test_chunks_are_full_but_the_last(any_plan, spark):
    df = layout.assign_chunk(with_position(spark.range(1234), "id"))
    sizes = {r["chunk_id"]: r["n"] for r in A.block_size(df).collect()}
    assert sizes == {i: 50 if i < 24 else 34 for i in range(25)}


def test_tolerant_and_prefix_scan_differ_on_a_gap(spark):
    df = table(spark, [(0, "a"), (1, "b"), (3, "c"), (3, "d")], "chunk_id bigint, x string")
    tolerant = {r["chunk_id"] for r in scans.read_chunks(df, 0, 10).collect()}
    prefix = {r["chunk_id"] for r in scans.read_chunk_prefix(df).collect()}
    assert (tolerant, prefix) == ({0, 1, 3}, {0, 1})


@pytest.mark.parametrize("ids,want", [([], 0), ([1, 2], 0), ([0], 1), ([0, 1, 2], 3), ([0, 2, 5], 1)])
def test_first_gap(any_plan, spark, ids, want):
    df = table(spark, [(i,) for i in ids], "chunk_id bigint")
    assert layout.first_gap(df).first()["first_gap"] == want
    assert scans.read_chunk_prefix(df).count() == sum(i < want for i in ids)


def test_batches_sort_by_number(spark):
    df = table(spark, [(i,) for i in (10, 2, 0, 11, 1)], "batch_id bigint")
    assert [r["batch_id"] for r in layout.order_batches(df).collect()] == [0, 1, 2, 10, 11]


def test_only_requested_batches_are_packed(spark):
    df = spark.range(60).select(F.col("id").alias("chunk_id"))
    packed = layout.pack_batches(df, per_batch=10, num_batches=2)
    assert {r["batch_id"]: r["n"] for r in A.batch_sizes(packed).collect()} == {0: 10, 1: 10}


def test_a_batch_may_keep_no_row(spark):
    df = table(spark, [(0, "a"), (0, "x"), (1, "x")], "batch_id bigint, label string")
    rows = {r["batch_id"]: (r["n_loaded"], r["n_kept"]) for r in A.batch_kept_counts(df, ["a"]).collect()}
    assert rows == {0: (2, 1), 1: (1, 0)}
    ranges = layout.batch_ranges(A.batch_sizes(df, ["a"])).collect()
    assert sorted((r["batch_id"], r["start"], r["end"]) for r in ranges) == [(0, 0, 1), (1, 1, 1)]


@pytest.mark.parametrize("n", [-1, 0, 1, 40, 1500, 5000])
def test_filter_then_limit_and_limit_then_filter(any_plan, spark, n):
    df = spark.range(3000).repartition(5)
    even = F.col("id") % 2 == 0
    ids = list(range(3000))
    after = sorted(r["id"] for r in layout.filter_limit(df, even, n, "id").collect())
    before = sorted(r["id"] for r in layout.limit_filter(df, n, even, "id").collect())
    assert after == [i for i in ids if i % 2 == 0][: max(n, 0)]
    assert before == [i for i in ids[: max(n, 0)] if i % 2 == 0]


def test_caps_per_split(any_plan, spark):
    rows = [(s, f"{s}{i:03d}") for s, n in (("train", 90), ("test", 9), ("other", 5)) for i in range(n)]
    df = table(spark, rows, "split string, path string")
    got = layout.cap_per_split(df, {"train": 20, "test": 10, "validation": 3}).collect()
    assert sorted(r["path"] for r in got) == sorted(
        [f"train{i:03d}" for i in range(20)] + [f"test{i:03d}" for i in range(9)] + [f"other{i:03d}" for i in range(5)]
    )
    assert layout.cap_per_split(df, {"train": 0}).count() == 14
    assert layout.cap_per_split(df).count() == 104


def test_no_cap_by_default(spark):
    rows = spark.range(70_000).select(F.lit("train").alias("split"), F.col("id").alias("path"))
    got = layout.cap_per_split(rows).agg(F.count("*").alias("n"), F.max("pos").alias("last")).first()
    assert tuple(got) == (70_000, 69_999)
    assert layout.cap_per_split(rows, {"train": 69_000}).count() == 69_000


def written_rows(spark, n, size, monkeypatch):
    """Rows that a limit writes."""
    from pixelweave.operators import numbering

    seen = []
    real = numbering.materialize

    def counting(df, purpose):
        done = real(df, purpose)
        seen.append(done.count())
        return done

    monkeypatch.setattr(numbering, "materialize", counting)
    df = spark.range(size).select(F.xxhash64("id").alias("k"), "id")
    got = [r["k"] for r in layout.head(df, n, "k").collect()]
    assert sorted(got) == sorted(r["k"] for r in df.orderBy("k").limit(n).collect())
    return sum(seen)


def test_a_limit_writes_little_more_than_its_rows(spark, monkeypatch):
    small, large = (written_rows(spark, 5000, size, monkeypatch) for size in (100_000, 600_000))
    assert small < 12_000 and large < 12_000


@pytest.mark.parametrize("sizes", [[1] * 50, [1000], [3, 900, 2, 1, 700, 5], [0, 1, 400, 400]])
def test_grouped_positions(any_plan, spark, sizes):
    rows = [(f"g{g}" if g else None, i) for g, n in enumerate(sizes) for i in range(n)]
    got = with_position(table(spark, rows, "g string, i int").repartition(6), "i", by="g").collect()
    assert sorted((str(r["g"]), r["i"], r["pos"]) for r in got) == sorted((str(g), i, i) for g, i in rows)


def test_grouped_positions_need_no_join(spark):
    df = with_position(spark.range(100).withColumn("g", F.col("id") % 3), "id", by="g")
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_no_epochs(spark):
    assert layout.repeat_epochs(spark.range(5), 0).collect() == []
    with pytest.raises(ValueError):
        layout.repeat_epochs(spark.range(5), -1)


@pytest.mark.parametrize("sizes", [[5, 0, 7, 1], [9000, 1, 0, 3, 4095, 2], [1] * 300])
def test_range_assignment(any_plan, spark, sizes):
    ends = [sum(sizes[: i + 1]) for i in range(len(sizes))]
    ranges = table(
        spark,
        [(i, e - n, e) for i, (n, e) in enumerate(zip(sizes, ends))],
        "batch_id bigint, start bigint, end bigint",
    )
    positions = spark.range(sum(sizes) + 10).select(F.col("id").alias("pos"), F.col("id").alias("x"))
    got = joins.assign_batch_range(positions, ranges).groupBy("batch_id").agg(
        F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")
    )
    found = {r["batch_id"]: (r["n"], r["lo"], r["hi"]) for r in got.collect()}
    assert found == {i: (n, e - n, e - 1) for i, (n, e) in enumerate(zip(sizes, ends)) if n}


def test_range_assignment_leaves_out_rows_between_ranges(spark):
    ranges = table(spark, [(0, 2, 4), (1, 6, 7)], "batch_id bigint, start bigint, end bigint")
    positions = spark.range(10).select(F.col("id").alias("pos"))
    got = {r["pos"]: r["batch_id"] for r in joins.assign_batch_range(positions, ranges).collect()}
    assert got == {2: 0, 3: 0, 6: 1}


@pytest.mark.parametrize("n", [0, 1, 999, 1000, 1001, 5000])
def test_first_rows_at_partition_borders(any_plan, spark, n):
    got = [r["id"] for r in first_rows(spark.range(1000).repartition(4), "id", n).collect()]
    assert sorted(got) == list(range(min(n, 1000)))


@pytest.mark.parametrize("n,tasks", [(0, 1), (1, 1), (256, 1), (257, 2), (2000, 8)])
def test_spread(spark, n, tasks):
    # Spark may leave range partitions empty, but never makes more of them.
    dealt = layout.spread(spark.range(n, numPartitions=1), "id")
    assert dealt.rdd.getNumPartitions() == tasks
    assert sorted(r["id"] for r in dealt.collect()) == list(range(n))


def test_orders(spark):
    rows = table(spark, [(1, 3, "b.png"), (0, 2, "a.jpg"), (0, 1, "c.jpg")], "chunk_id int, pos int, path string")
    assert [r["pos"] for r in layout.stable_order(rows).collect()] == [1, 2, 3]
    assert [r["path"] for r in layout.order_by_path(rows).collect()] == ["a.jpg", "b.png", "c.jpg"]


@pytest.mark.parametrize("left,right,want", [(3, 2, 2), (2, 3, 2), (0, 2, 0)])
def test_zip_stops_at_the_shorter_side(spark, left, right, want):
    a, b = spark.range(left), spark.range(right).withColumnRenamed("id", "other")
    assert joins.zip_by_position(a, b, "id", "other").count() == want


def test_realign_report_counts_missing_labels(any_plan, spark):
    images = table(spark, [(0, 0), (0, 1), (1, 2)], "chunk_id bigint, pos bigint")
    labels = table(spark, [(0, 0), (1, 2), (1, 3)], "chunk_id bigint, pos bigint")
    rows = joins.realign_report(images, labels).collect()
    got = {r["chunk_id"]: (r["n_images"], r["n_labels"], r["n_matched"]) for r in rows}
    assert got == {0: (2, 1, 1), 1: (1, 2, 1)}
    assert joins.realign(images, labels).count() == 2


def test_shuffle_is_a_reproducible_permutation(any_plan, spark):
    rows = layout.repeat_epochs(spark.range(300), 2)
    first = {(r["epoch"], r["id"]): r["pos"] for r in layout.shuffle_seeded(rows, 1, "id", "epoch").collect()}
    again = layout.shuffle_seeded(rows.repartition(5), 1, "id", "epoch").collect()
    assert first == {(r["epoch"], r["id"]): r["pos"] for r in again}
    for epoch in (0, 1):
        assert sorted(p for (e, _), p in first.items() if e == epoch) == list(range(300))
    assert any(first[0, i] != first[1, i] for i in range(300))


@pytest.mark.parametrize("n,epochs,size", [(300, 1, 1), (300, 2, 40), (299, 3, 100), (50, 2, 1000), (0, 2, 5)])
def test_a_buffered_shuffle_moves_no_row_further_than_the_buffer(any_plan, spark, n, epochs, size):
    rows = layout.repeat_epochs(spark.range(n).withColumn("pos", F.col("id")), epochs).repartition(4)
    mixed = layout.shuffle_buffered(rows, 3, "id", size, n, epoch="epoch", epochs=epochs)
    moved = [(r["epoch"] * n + r["pos"], r["shuffled"]) for r in mixed.collect()]
    assert sorted(to for _, to in moved) == list(range(n * epochs))
    assert all(abs(to - at) < size for at, to in moved)
    if size > 1 and epochs > 1 and n:
        assert any((at < n) != (to < n) for at, to in moved)
        assert sum(at != to for at, to in moved) > n / 2


def test_a_buffered_shuffle_needs_one_exchange_and_no_join(spark):
    rows = spark.range(1000).withColumn("pos", F.col("id"))
    plan = layout.shuffle_buffered(rows, 3, "id", 50, 1000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Join" not in plan and "rangepartitioning" not in plan


def test_checksums_find_swaps_losses_and_repeats(any_plan, spark):
    rows = [(p // 10, p, f"k{p}") for p in range(60)]
    other = [(c, p + 1 if p == 13 else p - 1 if p == 14 else p, k) for c, p, k in rows if p != 25]
    other = [(c, p, "k36" if p == 35 else k) for c, p, k in other] + [(4, 41, "k41"), (9, 90, "k90")]
    schema = "chunk_id int, pos int, key string"
    report = joins.alignment_report(table(spark, rows, schema), table(spark, other, schema), "key").collect()
    assert {r["chunk_id"]: (r["n_images"], r["n_labels"], r["aligned"]) for r in report} == {
        0: (10, 10, True), 1: (10, 10, False), 2: (10, 9, False), 3: (10, 10, False),
        4: (10, 11, False), 5: (10, 10, True), 9: (0, 1, False),
    }


def test_checksums_exchange_rows_of_chunks_only(spark):
    rows = spark.range(1000).select((F.col("id") / 50).cast("int").alias("chunk_id"), F.col("id").alias("pos"), "id")
    plan = joins.chunk_checksums(rows, "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "partial_count" in plan


@pytest.mark.parametrize("caps", [{"train": 1500, "test": 3}, {"train": 700, "test": 1}, {"train": 0, "test": 1400}])
def test_caps_equal_sorting_each_split(any_plan, spark, caps):
    draw = random.Random(2)
    rows = [(draw.choice(["train", "train", "test", "other", None]), draw.choice(["a", None, "b"]), i) for i in range(4000)]
    df = table(spark, rows, "split string, k string, i int").repartition(7)
    got = layout.cap_per_split(df, caps, ["k", "i"]).collect()
    want = []
    for split in ("train", "test", "other", None):
        own = sorted((k or "", i) for s, k, i in rows if s == split)
        want += [(str(split), k, i, p) for p, (k, i) in enumerate(own[: caps.get(split, 4000)])]
    assert sorted((str(r["split"]), r["k"] or "", r["i"], r["pos"]) for r in got) == sorted(want)


def test_one_scan_bounds_many_caps(any_plan, spark):
    df = spark.range(60_000, numPartitions=40).select((F.col("id") % 3).alias("split"), F.xxhash64("id").alias("k"))
    wanted = {0: 50, 1: 5000, 2: 30_000}
    held = bounds(df, ["k"], wanted, "split")
    within = {g: df.where((F.col("split") == g) & (F.col("k") <= b["k"])).count() for g, b in held.items() if b}
    assert 50 <= within[0] <= 75 and 5000 <= within[1] <= 6500 and held[2] is None


def test_the_bound_of_a_limit_reaches_the_scan(spark, tmp_path):
    spark.range(50_000).select(F.xxhash64("id").alias("k")).write.parquet(str(tmp_path / "t"))
    near = upto_bounds(spark.read.parquet(str(tmp_path / "t")), "k", {None: 5000})
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(k" in plan


def test_minibatch_keeps_the_short_last_step(spark):
    steps = layout.minibatch(with_position(spark.range(70), "id")).groupBy("step").count().collect()
    assert {r["step"]: r["count"] for r in steps} == {0: 32, 1: 32, 2: 6}


def test_union_matches_columns_by_name(spark):
    a, b = table(spark, [(1, "x")], "i int, s string"), table(spark, [("y", 2)], "s string, i int")
    assert {(r["i"], r["s"]) for r in sets.union_chunks(a, b).collect()} == {(1, "x"), (2, "y")}
    assert {r["split"] for r in sets.all_splits(train=a, test=b).collect()} == {"train", "test"}


def test_flags_and_metrics(spark):
    assert A.any_rows(spark.range(3)).first()[0] is True
    assert A.any_rows(spark.range(0)).first()[0] is False
    history = table(spark, [(0, 0.5), (2, 0.7), (1, 0.9)], "epoch int, acc double")
    assert A.last_epoch_metric(history, "acc").first()["acc"] == 0.7
    scores = table(spark, [("b", 0.9), ("a", 0.9), ("c", 0.1)], "m string, acc double")
    assert A.best_candidate(scores, "m", "acc").first().asDict() == {"m": "a", "acc": 0.9}


def test_class_weights_balance(spark):
    df = table(spark, [("a",)] * 30 + [("b",)] * 10, "label string")
    weights = {r["label"]: (r["weight"], r["n"]) for r in A.class_weights(df).collect()}
    assert weights["a"][0] * 30 == pytest.approx(weights["b"][0] * 10) == pytest.approx(20)


def test_working_tables_go_with_their_scope(spark, tmp_path):
    import os

    from pixelweave import workspace

    place = f"{workspace.shared_dir(spark).removeprefix('file:')}/pixelweave"

    def tables():
        return set(os.listdir(place)) if os.path.isdir(place) else set()

    before = tables()
    with workspace.scope():
        with_position(spark.range(50), "id").write.parquet(str(tmp_path / "out"))
        assert tables() - before
    assert tables() == before
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50
    with_position(spark.range(50), "id")
    assert tables() - before
