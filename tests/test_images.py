"""Image files: listing, decoding, channel handling and the whole run."""

import json
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pixelweave import fixed, jobs, schemas
from pixelweave.functions import tensors as T
from pixelweave.functions.arrow import FLOAT
from pixelweave.learning import minibatch
from pixelweave.operators import images
from pixelweave.plans.images import png
from pixelweave.sinks import tables
from pixelweave.sinks.image_files import write_image_files
from pixelweave.sources import files
from pixelweave.streaming import build

# Executors do not see this file, so its decoder travels with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RNG = np.random.default_rng(8)


def pixels(h, w, c=3):
    return RNG.integers(0, 256, (h, w, c), dtype=np.uint8)


def expected(rgb, h, w):
    table = T.pixel_table(fixed.CHANNEL_MEAN, fixed.CHANNEL_STD)
    return T.look_up(images.resized_pixels(rgb[..., ::-1], h, w), table)


def test_tensor_of_known_pixels():
    rgb = pixels(3, 4)
    want = (rgb / 255 - np.array(fixed.CHANNEL_MEAN)) / np.array(fixed.CHANNEL_STD)
    assert np.allclose(expected(rgb, 3, 4), want, atol=1e-6)


@pytest.fixture()
def folder(tmp_path):
    kinds = {"a": pixels(2, 3), "b": pixels(2, 2, 1), "c": pixels(2, 2, 4)}
    (tmp_path / "train").mkdir()
    for name, image in kinds.items():
        (tmp_path / "train" / f"coco_{name}.png").write_bytes(png(image))
    (tmp_path / "train" / "coco_broken.jpg").write_bytes(b"not an image")
    (tmp_path / "train" / "other.png").write_bytes(png(kinds["a"]))
    (tmp_path / "train" / "coco_d.JPG").write_bytes(b"wrong case")
    return str(tmp_path), kinds


def test_listing(spark, folder):
    root, _ = folder
    names = [r["name"] for r in files.list_images(spark, root, "train").orderBy("path").collect()]
    assert names == ["coco_a.png", "coco_b.png", "coco_broken.jpg", "coco_c.png"]
    assert files.list_images(spark, root, "absent").count() == 0
    assert files.decode_images(spark, root, "absent").count() == 0


def test_invalid_files_are_dropped_or_marked(spark, folder):
    root, _ = folder
    assert files.decode_images(spark, root, "train").count() == 3
    marked = files.decode_images(spark, root, "train", drop_invalid=False)
    assert marked.where("image.height = -1").select("name").first()["name"] == "coco_broken.jpg"
    assert images.image_to_tensor(marked, 4, 4).count() == 3


def test_every_channel_kind_becomes_rgb(spark, folder):
    root, kinds = folder
    decoded = files.decode_images(spark, root, "train")
    got = {r["name"]: r["tensor"] for r in images.image_to_tensor(decoded, 4, 4).collect()}
    as_rgb = {"a": kinds["a"], "b": np.repeat(kinds["b"], 3, -1), "c": kinds["c"][..., :3]}
    for name, rgb in as_rgb.items():
        tensor = np.frombuffer(got[f"coco_{name}.png"], FLOAT).reshape(4, 4, 3)
        assert np.array_equal(tensor, expected(rgb, 4, 4))


def test_rows_without_an_image_are_dropped(spark):
    whole = ("o", 2, 2, 3, 16, bytearray(range(12)))
    rows = [("a", None), ("b", whole), ("c", (*whole[:5], bytearray(5))), ("d", (*whole[:5], None))]
    fields = [schemas.T.StructField("name", schemas.T.StringType()), *schemas.IMAGE_ROW.fields]
    df = spark.createDataFrame(rows, schemas.T.StructType(fields))
    assert [r["name"] for r in images.image_to_tensor(df, 2, 2).collect()] == ["b"]


def test_stored_pixels_give_the_same_tensor(spark, folder):
    root, _ = folder
    decoded = files.decode_images(spark, root, "train")
    direct = images.image_to_tensor(decoded, 4, 4)
    stored = images.image_to_pixels(decoded, 4, 4).select(
        "name", T.standardize_pixels("pixels", (4, 4, 3)).alias("tensor")
    )
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, direct.collect()))


@pytest.mark.parametrize("shape", [(3, 2), (3, 2, 1), (3, 2, 3), (3, 2, 4)])
def test_harmonised_channels(shape):
    assert images.three_channels(np.zeros(shape, np.uint8)).shape == (3, 2, 3)


def test_constant_image(spark, tmp_path):
    (tmp_path / "train").mkdir()
    (tmp_path / "train" / "coco_0.png").write_bytes(png(np.full((5, 7, 3), 100, np.uint8)))
    decoded = files.decode_images(spark, str(tmp_path), "train")
    row = images.image_to_tensor(decoded).first()
    tensor = np.frombuffer(row["tensor"], FLOAT).reshape(fixed.IMAGE_SHAPE)
    want = (100 / 255 - np.array(fixed.CHANNEL_MEAN)) / np.array(fixed.CHANNEL_STD)
    assert np.allclose(tensor, want, atol=1e-6)


def ppm_decode(content):
    magic, size, _, body = content.split(b"\n", 3)
    if magic != b"P6":
        raise ValueError("not a pixmap")
    w, h = map(int, size.split())
    return np.frombuffer(body, np.uint8).reshape(h, w, 3)[..., ::-1]


def ppm(rgb):
    return b"P6\n%d %d\n255\n" % (rgb.shape[1], rgb.shape[0]) + rgb.tobytes()


def test_packed_contents(spark):
    image = pixels(6, 5)
    df = spark.createDataFrame(
        [("x", bytearray(ppm(image))), ("y", bytearray(b"junk"))], "name string, content binary"
    )
    rows = images.content_to_tensor(df, 3, 4, decode=ppm_decode).collect()
    assert [r["name"] for r in rows] == ["x"]
    assert np.array_equal(np.frombuffer(rows[0]["tensor"], FLOAT).reshape(3, 4, 3), expected(image, 3, 4))


def test_missing_codec_is_an_error(spark):
    def needs_a_codec(content):
        import no_such_codec

        return no_such_codec.decode(content)

    df = spark.createDataFrame([("x", bytearray(b"junk"))], "name string, content binary")
    with pytest.raises(Exception, match="no_such_codec"):
        images.content_to_tensor(df, decode=needs_a_codec).collect()
    with pytest.raises(TypeError):
        images.content_to_tensor(df)


def test_loose_files_can_be_written_twice(spark, tmp_path):
    rows = [("train", f"coco_{i:06d}.png", bytearray(png(pixels(2, 2)))) for i in range(20)]
    df = spark.createDataFrame(rows, "split string, name string, content binary")
    for _ in range(2):
        assert write_image_files(df, str(tmp_path)).count() == 20
    assert len(list((tmp_path / "train").iterdir())) == 20
    packed = files.read_contents(spark, str(tmp_path), "train")
    assert {(r["name"], bytes(r["content"])) for r in packed.collect()} == {(n, bytes(c)) for _, n, c in rows}


CLASSES = ["person", "cat", "dog", "car", "chair"]


@pytest.fixture()
def raw_root(tmp_path):
    """Two splits of images whose brightness tells their class; every 6th label is foreign."""
    for split, n in (("train", 130), ("validation", 40)):
        (tmp_path / split).mkdir()
        labels = []
        for i in range(n):
            k = i % 6
            labels.append((CLASSES + ["zebra"])[k])
            base = np.full((5, 4, 3), 20 + 40 * k) + RNG.integers(0, 8, (5, 4, 3))
            (tmp_path / split / f"coco_{i:06d}.png").write_bytes(png(base.astype(np.uint8)))
        (tmp_path / split / "labels.json").write_text(json.dumps({"labels": labels}))
    (tmp_path / "train" / "coco_000003.png").write_bytes(b"broken")
    return str(tmp_path)


def test_whole_run(spark, raw_root, tmp_path):
    shape = (2, 2, 3)
    caps = {"train": 100, "validation": 30, "test": 10}
    out = str(tmp_path / "processed")
    done = jobs.prepare(spark, raw_root, out, CLASSES, caps, shape, chunk_size=10)
    per_split = {r["split"]: r["n"] for r in done.groupBy("split").agg(F.count("*").alias("n")).collect()}
    # 130 images hold 109 listed ones; the cap leaves 100, of which one cannot be decoded.
    assert per_split == {"train": 99, "validation": 30}
    train = done.where("split='train'").groupBy("chunk_id").agg(F.count("*").alias("n"))
    chunk = {r["chunk_id"]: r["n"] for r in train.collect()}
    assert chunk == {i: 9 if i == 0 else 10 for i in range(10)}

    rows = jobs.build_batches(spark, out, str(tmp_path / "training"), CLASSES, per_batch=4, shape=shape)
    assert rows.count() == 99
    info = files.read_meta(spark, str(tmp_path / "training/batch_info"), jobs.schemas.BATCH_INFO).first()
    assert (info["total_images"], info["num_batches"]) == (99, 3)
    assert rows.where("aggregate(target, cast(0 as float), (a, x) -> a + x) <> 1").count() == 0

    model = str(tmp_path / "model")
    training_root = str(tmp_path / "training")
    jobs.train(spark, training_root, model, shape, epochs=60)
    result = jobs.evaluate(spark, out, model, training_root, shape=shape).first()
    assert result["accuracy"] > 0.9
    with pytest.raises(ValueError, match="trained with"):
        jobs.evaluate(spark, out, model, training_root, CLASSES[::-1], shape=shape)
    state_table = str(tmp_path / "state")
    step = [minibatch.Candidate(0.05)]
    jobs.train_minibatches(spark, training_root, state_table, out, step, shape=shape, epochs=1)
    state = jobs.train_minibatches(spark, training_root, state_table, out, step, shape=shape, epochs=4, balanced=True)
    assert state.epoch == 4 and len(state.history) == 4
    found = jobs.evaluate_minibatches(spark, out, state_table, training_root, shape=shape).first()
    best = max(state.history, key=lambda h: (h["val_accuracy"], -h["val_loss"]))
    assert found["accuracy"] == pytest.approx(best["val_accuracy"]) and found["loss"] == pytest.approx(best["val_loss"])
    jobs.train(spark, training_root, model, shape, balanced=True, epochs=60)
    assert jobs.evaluate(spark, out, model, training_root, CLASSES, shape=shape).first()["accuracy"] > 0.9
    perceptron = jobs.train(spark, training_root, model, shape, hidden=[4])
    stage = perceptron.stages[-1]
    config = files.read_meta(spark, f"{training_root}/config", schemas.RUN_CONFIG).first()
    layers = [int(x) for w in [stage.getLayers()] for x in w]
    assert layers == [12, 4, 5]
    assert stage.getOrDefault("maxIter") == config["epochs"] == 10
    assert stage.getOrDefault("blockSize") == config["batch_size"] == 32
    assert stage.getOrDefault("stepSize") == config["learning_rate"] == 0.001


def test_import_keeps_gaps_and_labels(spark, tmp_path):
    source, root = tmp_path / "source", str(tmp_path / "raw")
    source.mkdir()
    lines = []
    for i in range(60):
        split = "train" if i % 3 else "test"
        file = source / f"photo{i}.png"
        if i % 7:
            file.write_bytes(png(np.full((2, 2, 3), i, np.uint8)))
        lines.append({"sample_id": 1000 - i, "split": split, "filepath": str(file),
                      "ground_truth": {"detections": [{"label": " Cat " if i % 2 else "dog"}]}})
    (tmp_path / "samples.json").write_text("\n".join(map(json.dumps, lines)))
    caps = {"train": 30, "test": 100}
    got = jobs.import_samples(spark, str(tmp_path / "samples.json"), root, caps, "json").collect()

    want = []
    for split, cap in caps.items():
        mine = sorted((x for x in lines if x["split"] == split), key=lambda x: x["sample_id"])[:cap]
        names = [(f"coco_{i:06d}.jpg", x) for i, x in enumerate(mine)]
        kept = [(n, x) for n, x in names if (1000 - x["sample_id"]) % 7]
        want += [(split, n, p, x["ground_truth"]["detections"][0]["label"].strip().lower())
                 for p, (n, x) in enumerate(kept)]
    assert sorted((r["split"], r["name"], r["pos"], r["label"]) for r in got) == sorted(want)

    # A file of an earlier, longer run has no label and shifts nobody else's.
    (tmp_path / "raw" / "train" / "coco_000000.png").write_bytes(png(np.full((2, 2, 3), 2, np.uint8)))
    done = jobs.prepare(spark, root, str(tmp_path / "out"), ["cat"], caps, (2, 2, 3),
                        labels_of=jobs.imported_labels(spark, root))
    assert done.count() == sum(w[3] == "cat" for w in want)
    # The grey level of an image is its sample, so every tensor tells its own label.
    levels = T.pixel_table(fixed.CHANNEL_MEAN, fixed.CHANNEL_STD)[0]
    for r in done.collect():
        red = np.frombuffer(r["tensor"], FLOAT)[0]
        assert int(np.abs(levels - red).argmin()) % 2 == 1


def test_both_decoding_ways_agree(spark, tmp_path):
    (tmp_path / "train").mkdir()
    for i in range(12):
        image = pixels(3, 4)
        (tmp_path / "train" / f"coco_{i:06d}.jpg").write_bytes(ppm(image) if i != 4 else b"broken")
    (tmp_path / "train" / "labels.json").write_text(json.dumps(["cat", "dog", "zebra"] * 4))
    chosen = jobs.select_images(spark, str(tmp_path), CLASSES, {"train": 100}, 4, splits=["train"])
    by_path = images.path_to_tensor(chosen, 2, 2, decode=ppm_decode)
    packed = files.read_contents(spark, str(tmp_path), "train").drop("name").join(chosen, "path")
    by_content = images.content_to_tensor(packed, 2, 2, decode=ppm_decode)
    pick = ["name", "label", "pos", "chunk_id", "tensor"]
    a, b = (sorted(map(tuple, d.select(*pick).collect())) for d in (by_path, by_content))
    assert a == b and len(a) == 7


def test_images_arriving_as_files(spark, tmp_path):
    folder, sink, state = (tmp_path / n for n in ("in", "out", "state"))
    folder.mkdir()

    def arrive(*names):
        for name in names:
            (folder / name).write_bytes(ppm(pixels(3, 3)) if "bad" not in name else b"bad")
        arriving = build.read_image_stream(spark, str(folder), files_per_trigger=2)
        tensors = images.content_to_tensor(arriving, 2, 2, decode=ppm_decode)
        build.append(tensors, str(sink), str(state)).awaitTermination()
        return {r["name"] for r in spark.read.parquet(str(sink)).collect()}

    assert arrive("coco_1.jpg", "coco_2.png", "coco_bad.jpg", "x.jpg") == {"coco_1.jpg", "coco_2.png"}
    assert arrive("coco_3.jpg") == {"coco_1.jpg", "coco_2.png", "coco_3.jpg"}


def test_names_are_literal_and_unreadable_files_are_dropped(spark, tmp_path):
    names = ["x.ppm", "a b.ppm", "a%20b.ppm", "50%.ppm", "ü#?.ppm", "gone.ppm", "folder.ppm"]
    images_of = {}
    for name in names[:5]:
        images_of[name] = ppm(pixels(2, 2))
        (tmp_path / name).write_bytes(images_of[name])
    (tmp_path / "folder.ppm").mkdir()
    rows = [(n, f"{prefix}{tmp_path}/{n}") for n in names for prefix in ("", "file:", "file://")] + [("none", None)]
    df = spark.createDataFrame(rows, "name string, filepath string")
    kept = files.with_contents(df, keep_rejects=True).collect()
    reasons = {r["name"]: r["reject"] for r in kept}
    assert len(kept) == len(rows)
    assert {n: r for n, r in reasons.items() if r} == {
        "gone.ppm": "not found", "folder.ppm": "unreadable", "none": "no path"
    }
    assert all(bytes(r["content"]) == images_of[r["name"]] for r in kept if r["reject"] is None)
    assert files.with_contents(df).count() == 15
    assert images.path_to_tensor(df, 2, 2, path="filepath", decode=ppm_decode).count() == 15


def test_all_images_without_a_cap(spark, raw_root):
    rows = jobs.select_images(spark, raw_root, CLASSES, None)
    assert rows.count() == sum(i % 6 < 5 for n in (130, 40) for i in range(n))
    some = jobs.select_images(spark, raw_root, CLASSES, {"train": 3})
    counts = {r["split"]: r["n"] for r in some.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert counts == {"train": 3, "validation": sum(i % 6 < 5 for i in range(40))}


def test_settings_of_the_session_stay(spark, raw_root, tmp_path):
    from pixelweave.session import TENSOR_SETTINGS, tensor_settings

    before = {k: spark.conf.get(k) for k in TENSOR_SETTINGS}
    with tensor_settings(spark):
        assert all(spark.conf.get(k) == v for k, v in TENSOR_SETTINGS.items())
    assert {k: spark.conf.get(k) for k in TENSOR_SETTINGS} == before


def test_raw_table(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", "train", bytearray(b"1"), "cat", 0), ("b", "test", bytearray(b"22"), "dog", 1)],
        "name string, split string, content binary, label string, pos bigint",
    )
    tables.write_raw(df, str(tmp_path / "raw"))
    assert tables.read_table(spark, str(tmp_path / "raw")).where("split='test'").first()["name"] == "b"
    tables.write_label_lines(df, str(tmp_path / "labels"))
    lines = files.read_label_lines(spark, str(tmp_path / "labels/split=test"))
    assert [(r["pos"], r["label"]) for r in lines.collect()] == [(1, "dog")]
    assert files.read_label_lines(spark, str(tmp_path / "none")).count() == 0


def test_labels_from_a_table(spark, raw_root):
    def all_dogs(split):
        return spark.range(1000).select(F.col("id").alias("pos"), F.lit("dog").alias("label"))

    rows = jobs.select_images(spark, raw_root, CLASSES, {"train": 500, "validation": 5}, labels_of=all_dogs)
    got = {r["split"]: r["n"] for r in rows.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert got == {"train": 130, "validation": 5}
