"""Replacement and extension of tables: failed writers, pinned readers, streams."""

import glob

import pytest
from pyspark.sql import functions as F

from pixelweave.sinks import snapshots, tables
from pixelweave.sources import chunks


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_replace_and_versions(spark, tmp_path):
    root = str(tmp_path / "t")
    assert snapshots.latest(spark, root) is None
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, root)
    first = snapshots.replace(spark.range(5), root, notes={"n": 1})
    pinned = snapshots.read(spark, root)
    second = snapshots.replace(spark.range(3), root)
    assert (first, second) == (1, 2)
    assert ids(snapshots.read(spark, root)) == [0, 1, 2] and ids(pinned) == [0, 1, 2, 3, 4]
    assert ids(snapshots.read(spark, root, first)) == [0, 1, 2, 3, 4]
    assert snapshots.latest(spark, root).notes == {}
    snapshots.drop_old(spark, root)
    assert len(glob.glob(f"{root}/_data/*")) == 1 and ids(snapshots.read(spark, root)) == [0, 1, 2]


def test_a_table_may_be_made_from_itself(spark, tmp_path):
    root = str(tmp_path / "t")
    snapshots.replace(spark.range(4), root)
    snapshots.replace(snapshots.read(spark, root).where("id > 1"), root)
    assert ids(snapshots.read(spark, root)) == [2, 3]


def test_a_failed_writer_leaves_the_table(spark, tmp_path):
    root = str(tmp_path / "t")
    snapshots.replace(spark.range(4), root)
    broken = spark.range(0, 100, 1, 4).selectExpr("if(id < 99, id, cast(raise_error('no') as bigint)) AS id")
    for write in (snapshots.replace, snapshots.append):
        with pytest.raises(Exception):
            write(broken, root)
    assert ids(snapshots.read(spark, root)) == [0, 1, 2, 3]
    assert snapshots.latest(spark, root).version == 1


def test_an_unfinished_manifest_is_passed_over(spark, tmp_path):
    root = str(tmp_path / "t")
    snapshots.replace(spark.range(4), root)
    (tmp_path / "t" / "_manifests" / "000000000002.json").write_text('{"folders": ["x')
    assert ids(snapshots.read(spark, root)) == [0, 1, 2, 3]
    assert snapshots.replace(spark.range(1), root) == 3
    assert ids(snapshots.read(spark, root)) == [0]


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    snapshots.replace(spark.range(2), root)
    monkeypatch.setattr(snapshots, "_numbers", lambda spark, root: [])
    with pytest.raises(Exception):
        snapshots.replace(spark.range(9), root)
    monkeypatch.undo()
    assert ids(snapshots.read(spark, root)) == [0, 1]


def test_append_empty_and_partitioned(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.range(6).select("id", (F.col("id") % 2).cast("string").alias("split"))
    snapshots.append(rows.limit(0), root, ["split"])
    assert ids(snapshots.read(spark, root)) == []
    snapshots.append(rows.where("id < 4"), root, ["split"], {"next": 4})
    snapshots.append(rows.where("id >= 4"), root, ["split"], {"next": 6})
    found = snapshots.read(spark, root)
    assert found.columns == ["id", "split"] and ids(found.where("split = '1'")) == [1, 3, 5]
    assert snapshots.latest(spark, root).notes == {"next": 6}


def test_a_plain_scan_sees_no_rows(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.write_training_set(spark.range(3), root)
    tables.write_training_set(spark.range(2), root)
    assert tables.read_table(spark, root).count() == 2
    with pytest.raises(Exception):
        spark.read.parquet(root).count()


def test_stream_layout_with_restarts_and_replays(spark, tmp_path):
    from pixelweave.operators import layout
    from pixelweave.operators.numbering import with_position
    from pixelweave.streaming import build

    source, root, state = (str(tmp_path / n) for n in ("in", "t", "state"))
    rows = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("split"))
    for lo, hi in ((0, 110), (110, 111), (111, 300)):
        rows.where(f"id >= {lo} and id < {hi}").coalesce(1).write.mode("append").parquet(source)
        arriving = build.read_stream(spark, source, rows.schema, files_per_trigger=1)
        build.stream_layout(arriving, root, state, "id", "split", 10, 2).awaitTermination()
    assert not build.land(rows.where("id = 110"), 1, root, "id", "split", 10, 2)
    assert snapshots.latest(spark, root).notes == {"batch": 2, "next": {"a": 100, "b": 100, "": 100}}
    want = layout.pack_batches(layout.assign_chunk(with_position(rows, "id", "split"), 10), 2)
    got = tables.read_table(spark, root)
    assert sorted(map(tuple, got.select("id", "pos", "chunk_id", "batch_id").collect())) == sorted(
        map(tuple, want.select("id", "pos", "chunk_id", "batch_id").collect()))


def test_an_interrupted_landing_is_repeated(spark, tmp_path, monkeypatch):
    from pixelweave.streaming import build

    root = str(tmp_path / "t")
    build.land(spark.range(5), 0, root, "id")
    commit = snapshots._commit
    monkeypatch.setattr(snapshots, "_commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        build.land(spark.range(5, 8), 1, root, "id")
    monkeypatch.setattr(snapshots, "_commit", commit)
    assert build.land(spark.range(5, 8), 1, root, "id")
    assert sorted((r["id"], r["pos"]) for r in snapshots.read(spark, root).collect()) == [(i, i) for i in range(8)]


def chunked(spark, tmp_path, files=12, missing=(7, 30)):
    rows = spark.range(2000).select(
        F.expr("CAST(id DIV 40 AS INT)").alias("chunk_id"), F.col("id").alias("pos"),
        F.when(F.col("id") % 4 == 0, "test").otherwise("train").alias("split"),
    ).where(~F.col("chunk_id").isin(list(missing)))
    path = str(tmp_path / "with blank")
    tables.write_chunks(rows.repartitionByRange(files, "chunk_id").sortWithinPartitions("chunk_id"), path)
    return path, rows


@pytest.mark.parametrize("start,end", [(0, 3), (5, 9), (7, 8), (20, 31), (49, 60), (80, 90), (0, 100)])
def test_a_scan_of_chunks_opens_only_their_files(spark, tmp_path, start, end):
    path, rows = chunked(spark, tmp_path)
    got = chunks.read_stored_chunks(spark, path, start, end, "train")
    want = rows.where((F.col("split") == "train") & F.col("chunk_id").between(start, end - 1))
    assert sorted(r["pos"] for r in got.collect()) == sorted(r["pos"] for r in want.collect())
    assert len(got.inputFiles()) <= min(12, (end - start) // 4 + 2)
    assert got.columns == rows.columns


def test_a_prefix_stops_at_the_first_gap_and_opens_no_later_file(spark, tmp_path):
    path, _ = chunked(spark, tmp_path)
    assert chunks.stored_first_gap(spark, path, "test") == 7
    prefix = chunks.read_stored_prefix(spark, path)
    assert {r["chunk_id"] for r in prefix.collect()} == set(range(7))
    assert len(prefix.inputFiles()) <= 6 < len(tables.read_table(spark, path).inputFiles())


def test_the_map_follows_the_version(spark, tmp_path):
    path, rows = chunked(spark, tmp_path)
    tables.write_chunks(rows.where("chunk_id >= 40"), path)
    assert chunks.stored_first_gap(spark, path) == 0
    assert chunks.read_stored_prefix(spark, path).count() == 0
    assert chunks.read_stored_chunks(spark, path, 40, 42, "train").count() == 60
    assert chunks.read_stored_chunks(spark, path, 1, 2, version=1).count() == 40


def test_tables_without_a_map_are_scanned(spark, tmp_path, monkeypatch):
    _, rows = chunked(spark, tmp_path)
    plain = str(tmp_path / "plain")
    snapshots.replace(rows, plain, ["split"])
    assert chunks.read_stored_prefix(spark, plain, "train").count() == 7 * 30
    path = str(tmp_path / "with blank")
    monkeypatch.setattr(chunks, "MOST_FILES", 1)
    assert chunks.read_stored_chunks(spark, path, 0, 30, "train").count() == 29 * 30


def test_a_repeated_chunk_in_many_files_and_an_empty_table(spark, tmp_path):
    rows = spark.range(900).select((F.col("id") % 3).alias("chunk_id"), "id", F.lit("train").alias("split"))
    path = str(tmp_path / "t")
    tables.write_chunks(rows.repartition(5), path)
    assert chunks.read_stored_chunks(spark, path, 1, 2).count() == 300
    tables.write_chunks(rows.limit(0), path)
    assert chunks.read_stored_prefix(spark, path).count() == 0
