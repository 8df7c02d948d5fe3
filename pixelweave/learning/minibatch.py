"""Minibatch fits of softmax models with Adam, over tensors of any size.

Rows are sorted by position once and stored in files whose row groups hold about a quarter of a minibatch, so a
step reads the rows of its minibatch and no others. Every task turns its Arrow batches into
blocks of tensors and sums their gradient; the tasks' sums are merged in a tree, and the
optimiser's state, which is as large as the model, is updated on the driver and broadcast for
the next step. Rows are never gathered.

Several candidates (learning rate, penalty) are fitted in the same passes: their weights lie side
by side in one matrix, so the number of scans does not grow with their number. A pass over
validation rows after every epoch scores all of them; the best epoch of each is kept, a
candidate that no longer improves stops, and by successive halving the worse half goes after
given epochs. After every epoch the state is saved as a table, and a fit that is started again
from it ends with the same weights as one that was never interrupted.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pixelweave import fixed
from pixelweave.functions.arrow import FLOAT, block_of
from pixelweave.functions.storage import Storage
from pixelweave.learning.scoring import softmax
from pixelweave.operators.numbering import Order, _columns
from pixelweave.sinks import snapshots
from pixelweave.workspace import fresh_path

# Fixed values of Adam.
BETA_1, BETA_2, EPSILON = 0.9, 0.999, 1e-7

# Bytes of a file of sorted rows, and of the tensors that a task multiplies at a time.
_FILE_BYTES, _BLOCK_BYTES = 64 << 20, 16 << 20
# Row groups of a minibatch up to which its tasks open them by name; beyond it, Spark scans files.
_MOST_PIECES = 1_000
# Bytes of row groups that one task takes at least, and as a multiple of the sums it returns.
_TASK_BYTES, _TASK_SUMS = 4 << 20, 4
# Tasks whose sums meet in one place.
_FAN = 32


@dataclass(frozen=True)
class Candidate:
    """Settings of one fit: step size, and weight of the squared norm of the weights."""

    learning_rate: float = fixed.LEARNING_RATE
    penalty: float = 0.0


@dataclass(frozen=True)
class Minibatches:
    """Rows sorted by position in files of their own."""

    spark: SparkSession
    path: str
    # Of every file: name, first slot, rows, rows before it and rows of its row groups; slots grow
    # with positions.
    files: tuple[tuple[str, int, int, int, tuple[int, ...]], ...]
    rows: int
    width: int
    size: int

    @property
    def steps(self) -> int:
        return -(-self.rows // self.size)

    def read(self, first: int, end: int) -> DataFrame:
        """Rows at positions ``first`` to ``end``."""
        own = [f for f in self.files if f[3] < end and f[3] + f[2] > first]
        if not own:
            return self.spark.createDataFrame([], _STORED)
        low = own[0][1] + max(first - own[0][3], 0)
        high = own[-1][1] + min(end - own[-1][3], own[-1][2])
        scan = self.spark.read.schema(_STORED).parquet(*[f[0] for f in own])
        return scan.where((F.col("slot") >= low) & (F.col("slot") < high)).drop("slot")

    def pieces(self, first: int, end: int) -> list[tuple[str, int, int, int]]:
        """Row groups with rows at positions ``first`` to ``end``: file, row group, and which of
        its rows."""
        found = []
        for name, _, n, before, groups in self.files:
            if before < end and before + n > first:
                at = before
                for i, size in enumerate(groups):
                    if at < end and at + size > first:
                        found.append((name, i, max(first - at, 0), min(end - at, size)))
                    at += size
        return found


_STORED = T.StructType([
    T.StructField("slot", T.LongType()), T.StructField("tensor", T.BinaryType()),
    T.StructField("label_idx", T.IntegerType()), T.StructField("weight", T.DoubleType()),
])


def minibatches(df: DataFrame, order_by: Order, size: int = fixed.MINIBATCH_SIZE, tensor: str = "tensor",
                label: str = "label_idx", weight: str | None = None) -> Minibatches:
    """Sort ``df`` by position and store it for a fit: tensors as float32 bytes of one length.

    Minibatch ``i`` holds the rows from ``i * size`` on in the given order, however the rows lay
    before. One exchange of the rows, whatever the number of epochs.
    """
    spark = df.sparkSession
    about = df.agg(F.count("*").alias("n"), F.min(F.length(tensor)).alias("least"),
                   F.max(F.length(tensor)).alias("most")).first()
    if about["least"] != about["most"] or (about["least"] or 0) % FLOAT.itemsize:
        raise ValueError(f"tensors have {about['least']} to {about['most']} bytes")
    row_bytes, path = max(about["most"] or 0, 1), fresh_path(spark, "minibatches")
    if not about["n"]:
        return Minibatches(spark, path, (), 0, 0, size)
    n_files = max(1, math.ceil(about["n"] * row_bytes / max(_FILE_BYTES, size * row_bytes)))
    keys = _columns(order_by)
    rows = df.repartitionByRange(n_files, *keys).sortWithinPartitions(*keys).select(
        F.monotonically_increasing_id().alias("slot"), F.col(tensor).alias("tensor"),
        F.col(label).cast("int").alias("label_idx"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight"),
    )
    # Without the checks from the first row on, a row group has a hundred rows at least.
    options = {"parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1",
               "parquet.block.size": str(max(1 << 20, min(128 << 20, size * row_bytes // 4))),
               "parquet.enable.dictionary": "false", "compression": "uncompressed"}
    rows.write.options(**options).parquet(path)
    # One row per file.
    found = spark.read.schema(_STORED).parquet(path).groupBy(F.input_file_name().alias("name")).agg(
        F.min("slot").alias("slot"), F.count("*").alias("n")
    )
    files, before = [], 0
    for name, slot, n, groups in sorted(map(tuple, _with_groups(found).collect()), key=lambda f: f[1]):
        files.append((name, slot, n, before, tuple(groups)))
        before += n
    return Minibatches(spark, path, tuple(files), before, row_bytes // FLOAT.itemsize, size)


def _with_groups(files: DataFrame) -> DataFrame:
    """Files with the rows of their row groups, from the files' ends."""

    @F.arrow_udf("array<bigint>")
    def groups(names: pa.Array) -> pa.Array:
        storage = Storage()
        found = []
        for name in names.to_pylist():
            filesystem, place = storage.locate(unquote(name))
            held = pq.read_metadata(place, filesystem=filesystem)
            found.append([held.row_group(i).num_rows for i in range(held.num_row_groups)])
        return pa.array(found, pa.list_(pa.int64()))

    return files.withColumn("groups", groups("name"))


@dataclass
class State:
    """What a fit goes on from: per candidate the weights with the intercept last, both moments,
    and the best epoch so far."""

    candidates: tuple[Candidate, ...]
    weights: np.ndarray
    first: np.ndarray
    second: np.ndarray
    best: np.ndarray
    best_epoch: np.ndarray
    best_score: np.ndarray
    alive: np.ndarray
    epoch: int = 0
    step: int = 0
    history: list[dict] = field(default_factory=list)

    @classmethod
    def start(cls, candidates: Sequence[Candidate], classes: int, width: int) -> State:
        shape = len(candidates), classes, width + 1
        zeros = [np.zeros(shape) for _ in range(4)]
        n = len(candidates)
        return cls(tuple(candidates), *zeros, np.zeros(n, int), np.full(n, -np.inf), np.ones(n, bool))

    def winner(self) -> int:
        """The candidate with the best epoch; the first of equals."""
        return int(np.argmax(self.best_score))


# --- one pass ------------------------------------------------------------------------------

_SUMS = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("sums", T.BinaryType())])


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Tensors as rows of doubles, labels and weights, some megabytes at a time."""
    step = max(1, _BLOCK_BYTES // (8 * max(width, 1)))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            if part.column("label_idx").null_count:
                raise ValueError("a row without a label")
            yield (block_of(part.column("tensor"), FLOAT, (width,)).astype(np.float64),
                   part.column("label_idx").to_numpy(), part.column("weight").to_numpy())


def _answers(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Class probabilities, candidates x rows x classes, by one product with all weights."""
    n, classes, size = weights.shape
    logits = x @ weights[:, :, :-1].reshape(n * classes, size - 1).T
    return np.stack([softmax(part + w[:, -1]) for part, w in zip(np.split(logits, n, 1), weights)])


def _measures(answers: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Per candidate: weighted loss and hits."""
    if len(labels) and (labels.min() < 0 or labels.max() >= answers.shape[2]):
        raise ValueError("a label outside the classes")
    own = answers[:, np.arange(len(labels)), labels]
    loss = -np.log(np.clip(own, fixed.PROBABILITY_FLOOR, 1 - fixed.PROBABILITY_FLOOR))
    return np.stack([loss @ weight, (answers.argmax(2) == labels) @ weight], 1)


def _summed(rows: DataFrame, tasks: int, size: int) -> np.ndarray:
    """The sum of all tasks' vectors of ``size`` doubles, merged in a tree of ``_FAN`` at a time."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for value in batch.column("sums"):
                total += np.frombuffer(value.as_buffer(), np.float64)
        if total.any():
            yield _sum_row(total)

    while tasks > _FAN:
        tasks = -(-tasks // _FAN)
        rows = rows.repartition(tasks).mapInArrow(merge, _SUMS)
    total = np.zeros(size)
    # Arrow brings the few long rows as they are.
    for value in rows.toArrow().column("sums"):
        total += np.frombuffer(value.as_buffer(), np.float64)
    return total


def _sum_row(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())], _SUMS.names)


def _scan(data: Minibatches, first: int, end: int, run, length: int) -> tuple[DataFrame, int]:
    """``run`` over the rows at positions ``first`` to ``end``, and about how many tasks return
    their ``length`` sums.

    A small minibatch is a few row groups, for which planning a scan takes longer than reading
    them: tasks are told which to open.
    """
    pieces = data.pieces(first, end)
    if len(pieces) > _MOST_PIECES:
        return data.read(first, end).mapInArrow(run, _SUMS), len(data.files)
    per_piece = FLOAT.itemsize * data.width * (end - first) / max(1, len(pieces))
    per_task = math.ceil(max(_TASK_BYTES, _TASK_SUMS * 8 * length) / max(1, per_piece))
    dealt = [pieces[i : i + per_task] for i in range(0, len(pieces), per_task)]

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        storage = Storage()
        for batch in batches:
            for task in batch.column(0).to_pylist():
                for name, group, low, high in dealt[task]:
                    filesystem, place = storage.locate(unquote(name))
                    with filesystem.open_input_file(place) as source:
                        table = pq.ParquetFile(source).read_row_group(group, ["tensor", "label_idx", "weight"])
                    yield from table.slice(low, high - low).to_batches()

    tasks = data.spark.range(0, len(dealt), 1, max(1, len(dealt)))
    return tasks.mapInArrow(lambda batches: run(opened(batches)), _SUMS), len(dealt)


def _pass(data: Minibatches, first: int, end: int, weights: np.ndarray,
          with_gradient: bool) -> tuple[np.ndarray | None, np.ndarray, float]:
    """Over the rows at positions ``first`` to ``end``: mean gradient of all candidates if wanted,
    their sums of loss and hits, and the rows' weight."""
    held = data.spark.sparkContext.broadcast(weights)
    n, classes, size = weights.shape
    length = (weights.size if with_gradient else 0) + 2 * n + 1
    width = data.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x, labels, weight in _blocks(batches, width):
            if total is None:
                # Of the tasks that open a file, few find rows of the minibatch.
                weights, total = held.value, np.zeros(length)
                gradient = total[2 * n + 1 :].reshape(n, classes, size) if with_gradient else None
            answers = _answers(x, weights)
            total[: 2 * n] += _measures(answers, labels, weight).ravel()
            total[2 * n] += weight.sum()
            if gradient is None:
                continue
            answers[:, np.arange(len(labels)), labels] -= 1
            answers *= weight[:, None]
            flat = answers.transpose(0, 2, 1).reshape(n * classes, -1)
            gradient[:, :, :-1] += (flat @ x).reshape(n, classes, -1)
            gradient[:, :, -1] += answers.sum(1)
        if total is not None:
            yield _sum_row(total)

    try:
        total = _summed(*_scan(data, first, end, run, length), length)
    finally:
        held.destroy()
    measured, weight = total[: 2 * n].reshape(n, 2), total[2 * n]
    gradient = total[2 * n + 1 :].reshape(n, classes, size) / max(weight, 1e-300) if with_gradient else None
    return gradient, measured, float(weight)


def measure(data: Minibatches, weights: np.ndarray) -> np.ndarray:
    """Loss and accuracy of every candidate's weights on all rows, in one pass."""
    if not data.rows:
        return np.full((len(weights), 2), np.nan)
    _, measured, weight = _pass(data, 0, data.rows, weights, False)
    return measured / weight


# --- the fit -------------------------------------------------------------------------------


def _adam(state: State, gradient: np.ndarray, alive: np.ndarray) -> None:
    state.step += 1
    rate = np.array([c.learning_rate for c in state.candidates])[alive, None, None]
    penalty = np.array([c.penalty for c in state.candidates])[alive, None, None]
    if penalty.any():
        gradient[:, :, :-1] += penalty * state.weights[alive][:, :, :-1]
    # In place where all candidates take part: the arrays may be large.
    every = len(alive) == len(state.weights)
    first, second, weights = (x if every else x[alive] for x in (state.first, state.second, state.weights))
    first *= BETA_1
    first += (1 - BETA_1) * gradient
    second *= BETA_2
    gradient *= gradient
    gradient *= 1 - BETA_2
    second += gradient
    np.divide(second, 1 - BETA_2**state.step, out=gradient)
    np.sqrt(gradient, out=gradient)
    gradient += EPSILON
    np.divide(first, gradient, out=gradient)
    gradient *= rate / (1 - BETA_1**state.step)
    weights -= gradient
    if not every:
        state.first[alive], state.second[alive], state.weights[alive] = first, second, weights


def _order(steps: int, seed: int | None, epoch: int) -> np.ndarray:
    """Order of the minibatches in an epoch: by position, or a permutation of the seed."""
    return np.arange(steps) if seed is None else np.random.default_rng([seed, epoch]).permutation(steps)


def fit(
    data: Minibatches,
    classes: int,
    candidates: Sequence[Candidate] = (Candidate(),),
    epochs: int = fixed.EPOCHS,
    validation: Minibatches | None = None,
    patience: int | None = None,
    halve_after: Sequence[int] = (),
    seed: int | None = None,
    state_table: str | None = None,
) -> State:
    """Fit all candidates for ``epochs`` passes over ``data``.

    History has a row per epoch and candidate: loss and accuracy of the training rows as they
    were met, and of the validation rows after the epoch. An epoch's score is its validation
    accuracy, ties by loss; without validation every epoch replaces the one before. A candidate
    stops after ``patience`` epochs without a better one; after each epoch of ``halve_after`` the
    better half goes on. With ``state_table`` the state is saved after every epoch, and a fit
    that finds one there goes on from it.
    """
    state = State.start(candidates, classes, data.width)
    if state_table and snapshots.latest(data.spark, state_table):
        state = load_state(data.spark, state_table)
        if state.candidates != tuple(candidates) or state.weights.shape[1:] != (classes, data.width + 1):
            raise ValueError("the saved state belongs to another fit")
    while state.epoch < epochs and state.alive.any() and data.rows:
        state.epoch += 1
        alive = np.flatnonzero(state.alive)
        total, seen = np.zeros((len(alive), 2)), 0.0
        for number in _order(data.steps, seed, state.epoch):
            at = int(number) * data.size
            gradient, measured, weight = _pass(data, at, min(at + data.size, data.rows), state.weights[alive], True)
            total += measured
            seen += weight
            _adam(state, gradient, alive)
        checked = measure(validation, state.weights[alive]) if validation else np.full((len(alive), 2), np.nan)
        for i, (loss, hits), (val_loss, val_accuracy) in zip(alive.tolist(), total / max(seen, 1e-300), checked):
            state.history.append({
                "candidate": i, "epoch": state.epoch, "loss": float(loss), "accuracy": float(hits),
                "val_loss": float(val_loss), "val_accuracy": float(val_accuracy),
            })
            # Accuracy first; the loss decides among equals, as it adds less than one row does.
            score = float(state.epoch)
            if validation and validation.rows:
                score = float(val_accuracy - 0.4 / validation.rows * val_loss / (1 - math.log(fixed.PROBABILITY_FLOOR)))
            if score > state.best_score[i]:
                state.best[i], state.best_epoch[i], state.best_score[i] = state.weights[i], state.epoch, score
        if patience is not None and validation:
            state.alive &= state.epoch - state.best_epoch < patience
        if state.epoch in halve_after and state.alive.sum() > 1:
            ranked = sorted(np.flatnonzero(state.alive), key=lambda i: -state.best_score[i])
            state.alive[ranked[-(len(ranked) // 2) :]] = False
        if state_table:
            save_state(data.spark, state, state_table)
    return state


# --- tables of state and history -----------------------------------------------------------

_NUMBERS = ("weights", "first", "second", "best")
_STATE = T.StructType([
    T.StructField("candidate", T.IntegerType()), T.StructField("learning_rate", T.DoubleType()),
    T.StructField("penalty", T.DoubleType()), T.StructField("alive", T.BooleanType()),
    T.StructField("best_epoch", T.IntegerType()), T.StructField("best_score", T.DoubleType()),
    *(T.StructField(n, T.BinaryType()) for n in _NUMBERS),
])
HISTORY = T.StructType([
    T.StructField("candidate", T.IntegerType()), T.StructField("epoch", T.IntegerType()),
    *(T.StructField(n, T.DoubleType()) for n in ("loss", "accuracy", "val_loss", "val_accuracy")),
])


def save_state(spark: SparkSession, state: State, table: str) -> None:
    """Replace the state table by this epoch's; a row per candidate."""
    rows = [
        (i, c.learning_rate, c.penalty, bool(state.alive[i]), int(state.best_epoch[i]), float(state.best_score[i]),
         *(getattr(state, n)[i].tobytes() for n in _NUMBERS))
        for i, c in enumerate(state.candidates)
    ]
    notes = {"epoch": state.epoch, "step": state.step, "shape": list(state.weights.shape),
             "history": json.dumps(state.history)}
    snapshots.replace(spark.createDataFrame(rows, _STATE), table, notes=notes)


def load_state(spark: SparkSession, table: str) -> State:
    """The state that was saved last."""
    found = snapshots.latest(spark, table)
    rows = sorted(snapshots.read(spark, table, found.version).collect(), key=lambda r: r["candidate"])
    shape = found.notes["shape"]
    numbers = [np.stack([np.frombuffer(r[n], np.float64) for r in rows]).reshape(shape).copy() for n in _NUMBERS]
    return State(
        tuple(Candidate(r["learning_rate"], r["penalty"]) for r in rows), *numbers,
        np.array([r["best_epoch"] for r in rows]), np.array([r["best_score"] for r in rows]),
        np.array([r["alive"] for r in rows]), found.notes["epoch"], found.notes["step"],
        json.loads(found.notes["history"]),
    )


def history(spark: SparkSession, state: State) -> DataFrame:
    """A row per candidate and epoch."""
    rows = [tuple(h[n] for n in HISTORY.fieldNames()) for h in state.history]
    return spark.createDataFrame(rows, HISTORY)


def probabilities(weights: np.ndarray, width: int, tensor: str = "tensor") -> Column:
    """Class probabilities of tensors under one candidate's weights."""

    @F.arrow_udf("array<double>")
    def of(column: pa.Array) -> pa.Array:
        x = block_of(column, FLOAT, (width,)).astype(np.float64)
        answers = _answers(x, weights[None])[0]
        return pa.FixedSizeListArray.from_arrays(pa.array(answers.ravel()), len(weights)).cast(pa.list_(pa.float64()))

    return of(F.col(tensor))
