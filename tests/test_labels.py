"""Label and name expressions on edge cases."""

import json

import pytest
from pyspark.sql import Row, functions as F

from pixelweave import fixed
from pixelweave.functions import labels as L
from pixelweave.operators import aggregates as A, filters, joins
from pixelweave.sinks import metadata
from pixelweave.sources import files, samples


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text", [" Dog\t", " CAT \n", "person", "", "\x1c a b \x1f"])
def test_norm_label_strips_like_python(spark, text):
    assert one(spark, L.norm_label(F.lit(text))) == text.lower().strip()


def test_first_label(spark):
    detection = "array<struct<label:string>>"
    cases = [
        ([Row(label=" Dog\t")], "dog"),
        ([Row(label="DOG"), Row(label="cat")], "dog"),
        ([], "unknown"),
        (None, "unknown"),
        ([Row(label=None)], "none"),
        ([Row(label="")], ""),
    ]
    df = spark.createDataFrame([(i, d) for i, (d, _) in enumerate(cases)], f"i int, d {detection}")
    got = df.select("i", L.first_label("d").alias("x")).orderBy("i").collect()
    assert [r["x"] for r in got] == [want for _, want in cases]


@pytest.mark.parametrize(
    "text,want",
    [
        ('{"labels":["a","b"]}', ["a", "b"]),
        ('["a","b"]', ["a", "b"]),
        ('{"other":1}', []),
        ("[]", []),
        ("{broken", []),
        ('{"labels":null}', []),
        ('["a", 3]', ["a", "3"]),
        (' \n["a"]\n ', ["a"]),
        ('["a","b"] xx', []),
        ('{"labels":["a"]} trailing', []),
        ("['a']", []),
        ("{'labels':['a']}", []),
        ('["a"]["b"]', []),
        ('{"labels":["}","]"]}', ["}", "]"]),
    ],
)
def test_label_file_shapes(spark, tmp_path, text, want):
    path = tmp_path / "labels.json"
    path.write_text(text)
    rows = files.read_labels(spark, str(path)).orderBy("pos").collect()
    assert [r["label"] for r in rows] == want
    assert [r["pos"] for r in rows] == list(range(len(want)))


def test_one_hot_of_no_classes(spark):
    assert one(spark, L.one_hot(F.lit(0), 0)) == []
    with pytest.raises(ValueError):
        L.one_hot(F.lit(0), -1)


def test_missing_label_file_is_empty(spark, tmp_path):
    assert files.read_labels(spark, str(tmp_path / "none.json")).count() == 0


@pytest.mark.parametrize("n_files,n_labels,want", [(3, 2, 2), (2, 3, 2), (2, 0, 2)])
def test_with_labels(spark, n_files, n_labels, want):
    listed = spark.range(n_files).select(F.col("id").alias("pos"))
    labels = spark.range(n_labels).select(F.col("id").alias("pos"), F.lit("x").alias("label"))
    rows = files.with_labels(listed, labels).orderBy("pos").collect()
    assert len(rows) == want
    assert [r["label"] for r in rows] == (["x"] * want if n_labels else ["0", "1"])


def test_fallback_labels_never_pass_a_class_filter(spark):
    listed = spark.range(200).select(F.col("id").alias("pos"))
    none = spark.range(0).select(F.col("id").alias("pos"), F.lit("x").alias("label"))
    assert filters.keep_classes(files.with_labels(listed, none)).count() == 0


def test_names(spark):
    assert one(spark, L.canonical_name(F.lit(7))) == "coco_000007.jpg"
    assert one(spark, L.basename(F.lit("/a/b/c.png"))) == "c.png"
    assert one(spark, L.chunk_path(F.lit("train"), F.lit(3))) == "train/images_chunk_3"
    assert one(spark, L.has_prefix(F.lit("labels.npy"))) is False
    assert one(spark, L.clamp_end(F.lit(100), 50, F.lit(120))) == 120


def test_encode_and_one_hot(spark):
    df = spark.createDataFrame([("dog",), ("car",)], "label string")
    coded = joins.encode_label(df, fixed.TARGET_CLASSES)
    assert {r["label"]: r["class_idx"] for r in coded.collect()} == {"dog": 2, "car": 3}
    assert one(spark, L.one_hot(F.lit(2), 5)) == [0.0, 0.0, 1.0, 0.0, 0.0]
    assert one(spark, L.label_of(F.lit(2), fixed.TARGET_CLASSES)) == "dog"
    present = joins.encode_label(df, fixed.TARGET_CLASSES, mode="present")
    assert {r["label"]: r["class_idx"] for r in present.collect()} == {"dog": 0, "car": 1}


def test_duplicate_class_keeps_last_index(spark):
    assert one(spark, L.label_index(F.lit("a"), ["a", "b", "a"])) == 2


@pytest.mark.parametrize("label", ["bird", None])
def test_unknown_label_is_an_error(spark, label):
    df = spark.createDataFrame([(label,)], "label string")
    with pytest.raises(Exception, match="label not in class list"):
        joins.encode_label(df, fixed.TARGET_CLASSES).collect()
    assert joins.unknown_labels(df, joins.class_list(spark, fixed.TARGET_CLASSES)).count() == 1


def test_reported_class_counts_add_up(spark):
    counts = {"person": 952, "car": 263, "dog": 169, "cat": 144, "chair": 134}
    rows = [(c,) for c, n in counts.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "label string")
    got = A.class_histogram(df, fixed.TARGET_CLASSES, zero_filled=True).collect()
    assert {r["label"]: r["n"] for r in got} == counts
    assert A.totals(df).first()["n"] == 1662
    share = {r["label"]: r["share"] for r in A.class_share(df).collect()}
    assert share["person"] == pytest.approx(952 / 1662)


def test_metadata_round_trip(spark, tmp_path):
    metadata.write_meta(metadata.label_map(spark), str(tmp_path / "map"))
    rows = files.read_label_map(spark, str(tmp_path / "map")).collect()
    assert {r["label"]: r["class_idx"] for r in rows} == dict(zip(fixed.TARGET_CLASSES, range(5)))
    metadata.write_meta(metadata.run_config(spark, num_batches=2), str(tmp_path / "config"))
    part = next((tmp_path / "config").glob("part-*.json"))
    assert json.loads(part.read_text())["batch_size"] == 32


def test_batch_info_counts_batches_without_kept_rows(spark):
    df = spark.createDataFrame([(0, "cat"), (0, "dog"), (1, "zebra")], "batch_id bigint, label string")
    assert metadata.batch_info(df, "d").first().asDict() == {
        "batch_dir": "d", "total_images": 2, "num_batches": 2, "num_classes": 2,
    }
    empty = metadata.batch_info(df.where("false"), "d").first()
    assert (empty["total_images"], empty["num_batches"]) == (0, 0)


def test_read_samples(spark, tmp_path):
    lines = [
        {"sample_id": i, "split": "train" if i % 2 else "test", "filepath": f"/x/{i}.jpg",
         "ground_truth": {"detections": [{"label": "Dog"}]}}
        for i in range(10)
    ]
    (tmp_path / "s.json").write_text("\n".join(json.dumps(x) for x in lines))
    rows = samples.read_samples(spark, str(tmp_path), "train", 3, "json")
    first = rows.select("sample_id", L.first_label("ground_truth.detections").alias("l")).collect()
    assert [(r["sample_id"], r["l"]) for r in first] == [(1, "dog"), (3, "dog"), (5, "dog")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        samples.read_samples(spark, str(tmp_path / "no"), "train")
