"""The programs of a run: import samples, prepare images, build batches, train, evaluate.

Each is a plan over the operators that ends in a write. ``prepare`` needs the raw folder
``<root>/<split>/`` with images and an optional ``labels.json``, or what ``import_samples``
has written.
"""

from __future__ import annotations

import contextlib
import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from pixelweave import fixed, schemas
from pixelweave.functions import labels as L, tensors as T
from pixelweave.learning import minibatch, scoring, training
from pixelweave.operators import images, layout
from pixelweave.operators.aggregates import evaluation
from pixelweave.operators.filters import drop_bad_payload, keep_classes
from pixelweave.operators.numbering import with_position
from pixelweave.operators.sets import all_splits
from pixelweave.session import tensor_settings
from pixelweave.sinks import metadata, tables
from pixelweave.sinks.image_files import write_image_files
from pixelweave.sources import chunks, files
from pixelweave.workspace import materialize, scope


# Bytes of a tensor from which the default batch sizes of Spark would fill the memory.
_WIDE_ROW = 64 << 10


def import_samples(
    spark: SparkSession,
    source: str,
    raw_root: str,
    caps: Mapping[str, int] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Copy the images of annotated samples to canonical names and write their labels.

    All samples are taken unless ``caps`` limits a split. A cap counts samples before missing files are dropped, and names keep the gaps.
    Returns ``(split, name, pos, label)`` of the images copied.
    """
    annotated = spark.read.schema(schemas.ANNOTATED_SAMPLE).format(fmt).load(source)
    labelled = annotated.select(
        "split", "sample_id", "filepath", L.first_label("ground_truth.detections").alias("label")
    )
    taken = layout.cap_per_split(labelled, caps, "sample_id")
    named = layout.spread(taken, ["split", "pos"]).select(
        "split", L.canonical_name("pos").alias("name"), "label", "filepath"
    )
    # Written first, so that the sort below does not copy the files a second time.
    copied = materialize(write_image_files(files.with_contents(named), raw_root), "copied")
    numbered = with_position(copied.select("split", "name", "label"), "name", by="split")
    tables.write_label_lines(numbered, f"{raw_root}/labels")
    return numbered


def imported_labels(spark: SparkSession, raw_root: str) -> Callable[[str], DataFrame]:
    """The ``labels_of`` argument of ``prepare`` for imported samples."""
    return lambda split: files.read_label_lines(spark, f"{raw_root}/labels/split={split}")


def select_images(
    spark: SparkSession,
    raw_root: str,
    classes: Sequence[str] | None = fixed.TARGET_CLASSES,
    caps: Mapping[str, int] | None = None,
    chunk_size: int = fixed.CHUNK_SIZE,
    labels_of: Callable[[str], DataFrame] | None = None,
    splits: Sequence[str] = fixed.SPLITS,
) -> DataFrame:
    """Images to prepare, with label, position and chunk. Only file names are read.

    ``labels_of`` gives the labels of a split where there is no ``labels.json``: either
    ``(pos, label)`` in file order, or ``(name, label)``, which files left over from an
    earlier run cannot shift.
    """
    per_split = {}
    for split in splits:
        listed = files.list_images(spark, raw_root, split)
        if labels_of:
            labels = labels_of(split)
        else:
            labels = files.read_labels(spark, f"{raw_root}/{split}/labels.json")
        if "name" in labels.columns:
            per_split[split] = listed.join(labels.select("name", "label"), "name")
        else:
            per_split[split] = files.with_labels(with_position(listed, "path"), labels).drop("pos")
    labelled = all_splits(**per_split)
    wanted = keep_classes(labelled, classes) if classes else labelled
    return layout.assign_chunk(layout.cap_per_split(wanted, caps, "path"), chunk_size)


@scope()
def prepare(
    spark: SparkSession,
    raw_root: str,
    out: str,
    classes: Sequence[str] | None = fixed.TARGET_CLASSES,
    caps: Mapping[str, int] | None = None,
    shape: T.Shape = fixed.IMAGE_SHAPE,
    chunk_size: int = fixed.CHUNK_SIZE,
    decode: images.Decoder | None = None,
    labels_of: Callable[[str], DataFrame] | None = None,
    splits: Sequence[str] = fixed.SPLITS,
) -> DataFrame:
    """Write the processed samples of loose images and return them.

    With ``decode`` every task opens just the selected files, and pixels are never shuffled.
    Without it, Spark's image source decodes the whole folder; pixels are then resized before
    the selection is joined. Many images are better packed; see ``prepare_packed``.
    """
    h, w, _ = shape
    chosen = select_images(spark, raw_root, classes, caps, chunk_size, labels_of, splits)
    if decode:
        dealt = layout.spread(chosen, ["split", "pos"])
        rows = images.path_to_tensor(dealt, h, w, decode=decode)
    else:
        decoded = all_splits(**{s: files.decode_images(spark, raw_root, s) for s in splits})
        resized = images.image_to_pixels(decoded, h, w)
        picked = resized.join(chosen.drop("path"), ["split", "name"])
        rows = picked.withColumn("tensor", T.standardize_pixels("pixels", shape))
    return _write_processed(spark, rows, out, shape)


@scope()
def prepare_packed(
    spark: SparkSession,
    raw_table: str,
    out: str,
    decode: images.Decoder,
    classes: Sequence[str] | None = fixed.TARGET_CLASSES,
    caps: Mapping[str, int] | None = None,
    shape: T.Shape = fixed.IMAGE_SHAPE,
    chunk_size: int = fixed.CHUNK_SIZE,
) -> DataFrame:
    """Write the processed samples of images packed by ``write_raw`` and return them.

    Class filter, caps and numbering read the narrow columns of the table; encoded files are
    read for the selected rows and decoded in the task that has them. No folder is listed.
    """
    h, w, _ = shape
    stored = tables.read_table(spark, raw_table)
    labelled = stored.select("split", "name", "label")
    wanted = keep_classes(labelled, classes) if classes else labelled
    chosen = layout.assign_chunk(layout.cap_per_split(wanted, caps, "name"), chunk_size)
    contents = stored.select("split", "name", "content")
    picked = contents.join(chosen, ["split", "name"])
    rows = images.content_to_tensor(picked, h, w, decode=decode)
    return _write_processed(spark, rows, out, shape)


def _write_processed(spark: SparkSession, rows: DataFrame, out: str, shape: T.Shape) -> DataFrame:
    sized = rows.withColumns({n: F.lit(x) for n, x in zip(("h", "w", "c"), shape)})
    tables.write_chunks(sized.select(*schemas.PROCESSED_SAMPLE.fieldNames()), out)
    return read_processed(spark, out)


def _expecting(spark: SparkSession, shape: T.Shape):
    """Smaller batches for the time being if rows of this shape are wide."""
    wide = math.prod(shape) * 4 > _WIDE_ROW
    return tensor_settings(spark) if wide else contextlib.nullcontext()


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """Processed samples.

    A split predicate prunes folders. Where a codec kept rows in position order, a chunk
    predicate skips files and row groups as well.
    """
    return tables.read_table(spark, path).select(*schemas.PROCESSED_SAMPLE.fieldNames())


@scope()
def build_batches(
    spark: SparkSession,
    processed: str,
    out: str,
    classes: Sequence[str] = fixed.TARGET_CLASSES,
    num_batches: int | None = None,
    per_batch: int = fixed.CHUNKS_PER_BATCH,
    shape: T.Shape = fixed.IMAGE_SHAPE,
    **settings,
) -> DataFrame:
    """Write the training rows of the train split and the run's metadata; return the rows.

    ``settings`` (epochs, batch_size, learning_rate) go into the run's config, which ``train``
    reads.
    """
    loaded = read_processed(spark, processed).where(F.col("split") == "train")
    packed = layout.pack_batches(loaded, per_batch, num_batches)
    with _expecting(spark, shape):
        tables.write_training_set(tables.training_set(packed, classes), f"{out}/batches")
    rows = tables.read_table(spark, f"{out}/batches")
    info = metadata.batch_info(packed, f"{out}/batches", classes)
    metadata.write_meta(info.select(*schemas.BATCH_INFO.fieldNames()), f"{out}/batch_info")
    metadata.write_meta(metadata.label_map(spark, classes), f"{out}/label_mapping")
    found = files.read_meta(spark, f"{out}/batch_info", schemas.BATCH_INFO).first()
    config = metadata.run_config(
        spark, found["num_batches"], len(L.label_lookup(classes)), chunks_per_batch=per_batch, **settings
    )
    metadata.write_meta(config, f"{out}/config")
    return rows


def stored_classes(spark: SparkSession, training_root: str) -> list[str]:
    """Class list of a run in index order, from its label map."""
    mapping = files.read_label_map(spark, f"{training_root}/label_mapping")
    # One row per class of the list that the map was made from.
    return [row["label"] for row in mapping.orderBy("class_idx").collect()]


def _model_rows(df: DataFrame, shape: T.Shape, *more: str) -> DataFrame:
    whole = drop_bad_payload(df, *shape)
    values = whole.withColumn("values", T.from_bytes("tensor", shape))
    return training.with_features(values, "values").select(
        "features", F.col("label_idx").cast("double").alias("label_idx"), *more
    )


@scope()
def train(
    spark: SparkSession,
    training_root: str,
    model_path: str,
    shape: T.Shape = fixed.IMAGE_SHAPE,
    hidden: Sequence[int] | None = None,
    balanced: bool = False,
    **params,
) -> PipelineModel:
    """Fit on the batch table that ``build_batches`` wrote under ``training_root`` and save
    the model.

    The run's config gives the epochs and, for a perceptron with ``hidden`` layers, the
    minibatch size and learning rate; the class count of the config must be that of the label
    map. ``balanced`` weighs rows so that classes count the same.
    """
    config = files.read_meta(spark, f"{training_root}/config", schemas.RUN_CONFIG).first()
    classes = stored_classes(spark, training_root)
    if config["num_classes"] != len(classes):
        raise ValueError(f"{config['num_classes']} classes in the config, {len(classes)} in the label map")
    settings = {"epochs": config["epochs"]}
    if hidden:
        settings |= {
            "layers": (math.prod(shape), *hidden, len(classes)), "solver": "gd",
            "blockSize": config["batch_size"], "stepSize": config["learning_rate"],
        }
    stored = tables.read_table(spark, f"{training_root}/batches")
    rows = _model_rows(training.with_class_weights(stored) if balanced else stored, shape, *["weight"] * balanced)
    if balanced:
        settings["weightCol"] = "weight"
    with _expecting(spark, shape):
        model = training.fit_classifier(rows, **settings | params)
    training.save_model(model, model_path)
    return model


@scope()
def train_minibatches(
    spark: SparkSession,
    training_root: str,
    state_table: str,
    processed: str | None = None,
    candidates: Sequence[minibatch.Candidate] = (),
    split: str = "validation",
    shape: T.Shape = fixed.IMAGE_SHAPE,
    balanced: bool = False,
    **settings,
) -> minibatch.State:
    """Fit with Adam in the run's minibatches, learning rate and epochs on the batch table that
    ``build_batches`` wrote, and keep the state of every epoch in ``state_table``.

    With ``processed`` every epoch is scored on its ``split``. Started again after a failure, the
    fit goes on from the last finished epoch. ``settings`` go to ``minibatch.fit``.
    """
    config = files.read_meta(spark, f"{training_root}/config", schemas.RUN_CONFIG).first()
    classes = stored_classes(spark, training_root)
    size = config["batch_size"]
    stored = drop_bad_payload(tables.read_table(spark, f"{training_root}/batches"), *shape)
    rows = training.with_class_weights(stored) if balanced else stored
    with _expecting(spark, shape):
        learned = minibatch.minibatches(rows, ["pos"], size, weight="weight" if balanced else None)
        held = None
        if processed:
            wanted = chunks.read_stored_prefix(spark, processed, split)
            encoded = keep_classes(drop_bad_payload(wanted, *shape), classes)
            held = minibatch.minibatches(encoded.withColumn("label_idx", L.label_index("label", classes)), ["pos"], size)
        chosen = tuple(candidates) or (minibatch.Candidate(config["learning_rate"]),)
        return minibatch.fit(
            learned, len(classes), chosen, validation=held, state_table=state_table,
            **{"epochs": config["epochs"]} | settings,
        )


@scope()
def evaluate_minibatches(
    spark: SparkSession,
    processed: str,
    state_table: str,
    training_root: str,
    split: str = "validation",
    shape: T.Shape = fixed.IMAGE_SHAPE,
) -> DataFrame:
    """Loss and accuracy of the best epoch of the best candidate of a state table; one row."""
    state = minibatch.load_state(spark, state_table)
    known = stored_classes(spark, training_root)
    rows = keep_classes(chunks.read_stored_prefix(spark, processed, split), known)
    encoded = drop_bad_payload(rows, *shape).withColumn("label_idx", L.label_index("label", known))
    with _expecting(spark, shape):
        answers = minibatch.probabilities(state.best[state.winner()], math.prod(shape))
        result = evaluation(encoded.select("label_idx", answers.alias("probs")), "probs", "label_idx")
        return spark.createDataFrame([result.first()], result.schema)


@scope()
def evaluate(
    spark: SparkSession,
    processed: str,
    model_path: str,
    training_root: str,
    classes: Sequence[str] | None = None,
    split: str = "validation",
    shape: T.Shape = fixed.IMAGE_SHAPE,
) -> DataFrame:
    """Loss and accuracy on the contiguous chunks of a split; one row.

    Labels are encoded by the label map of the training run; a class list that differs from
    it is an error.
    """
    known = stored_classes(spark, training_root)
    if classes is not None and list(L.label_lookup(classes)) != known:
        raise ValueError(f"the model was trained with classes {known}")
    rows = keep_classes(chunks.read_stored_prefix(spark, processed, split), known)
    encoded = rows.withColumn("label_idx", L.label_index("label", known))
    with _expecting(spark, shape):
        result = scoring.evaluate(_model_rows(encoded, shape), training.load_model(model_path))
        # One row, computed while the settings hold.
        return spark.createDataFrame([result.first()], result.schema)
