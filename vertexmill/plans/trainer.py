"""Training over a layout: two edge passes per epoch and layer above the first.

Only model-sized data meets the driver: the weights, their summed gradient and
one row of metrics per epoch. Weights go out as a broadcast each epoch, so a
plan never grows with the number of epochs.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from vertexmill.functions.vectors import (
    MATRIX_PIECES,
    map_batches,
    matrix_of,
    matrices_of,
    matrix_pieces,
    sum_matrices,
    vectors_of,
)
from vertexmill.operators.compressed import SlotEdges
from vertexmill.operators.evaluate import evaluate_splits
from vertexmill.operators.gcn import P_MAX, P_MIN, init_weights, layer_dims
from vertexmill.plans.layout import Layout, lay_out
from vertexmill.runtime import written
from vertexmill.schema import RUN_METRICS

SPLITS = ["is_train", "is_val", "is_test"]

#: Columns that tell where the messages of a vertex go.
TO = ["id", "copies", "first"]
ADDRESS = "id bigint, copies int, first bigint"
MESSAGE = f"{ADDRESS}, vec array<double>"


@dataclass(frozen=True)
class TrainConfig:
    """The defaults are those of the published runs."""

    num_layers: int = 2
    hidden_dim: int = 128
    learning_rate: float = 0.01
    epochs: int = 3
    seed: int = 42
    init: Callable[[list[int], int], list[np.ndarray]] = init_weights


@dataclass
class TrainResult:
    weights: list[np.ndarray]
    metrics: list[dict]

    def metrics_table(self, spark: SparkSession, config: str, peak_memory_mb: float = 0.0):
        """The epochs as a ``run_metrics`` table."""
        names = [f.name for f in RUN_METRICS]
        rows = [
            tuple({**m, "config": config, "peak_memory_mb": peak_memory_mb}[n] for n in names)
            for m in self.metrics
        ]
        return spark.createDataFrame(rows, RUN_METRICS)


def _relu(z: np.ndarray) -> np.ndarray:
    return np.maximum(z, 0.0)


def _address(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    return {c: batch.column(c) for c in TO}


def _scale(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("scale").to_numpy()[:, None]


def _first_messages(layout: Layout, shared, width: int) -> DataFrame:
    """Messages into the second layer, straight from the aggregated features."""

    def send(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        w = shared.value
        hidden = _relu(matrix_of(batch.column("ax")) @ w[0])
        out = hidden @ w[1] * _scale(batch)
        return {**_address(batch), "vec": vectors_of(out)}

    rows = layout.vertices.select(*TO, "scale", "ax")
    return map_batches(rows, MESSAGE, send)


def _next_messages(state: DataFrame, shared, layer: int) -> DataFrame:
    """Messages into ``layer`` from the sums received by the layer before."""

    def send(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        scale = _scale(batch)
        hidden = _relu(matrix_of(batch.column("vec")) * scale)
        out = hidden @ shared.value[layer] * scale
        return {**_address(batch), "vec": vectors_of(out)}

    rows = state.select(*TO, "scale", "vec")
    return map_batches(rows, MESSAGE, send)


def _received(layout: Layout, messages: DataFrame, width: int, columns: list[str]) -> DataFrame:
    """Pass messages along the edges and bring each sum to its vertex row; no vertex moves."""
    sums = layout.send(messages, width).hint(layout.hint(width))
    return layout.vertices.select("id", "scale", *columns).join(sums, "id")


def _score(state: DataFrame) -> DataFrame:
    """Prediction, loss and scaled logit gradient of every vertex, from its logits."""

    def score(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        scale = _scale(batch)
        logits = matrix_of(batch.column("vec")) * scale
        label = batch.column("label").to_numpy()
        powers = np.exp(logits - logits.max(axis=1, keepdims=True))
        probs = powers / powers.sum(axis=1, keepdims=True)
        row = np.arange(len(label))
        loss = -np.log(np.clip(probs[row, label], P_MIN, P_MAX))
        probs[row, label] -= 1.0
        grad = probs * batch.column("row_weight").to_numpy()[:, None] * scale
        kept = {c: batch.column(c) for c in ("label", *SPLITS)}
        return {
            **_address(batch),
            **kept,
            "pred": pa.array(logits.argmax(axis=1)),
            "loss": pa.array(loss),
            "vec": vectors_of(grad),
        }

    return map_batches(
        state,
        f"{ADDRESS}, label bigint, is_train boolean, is_val boolean, "
        "is_test boolean, pred bigint, loss double, vec array<double>",
        score,
    )


def _logit_states(layout: Layout, shared, dims: list[int]) -> list[DataFrame]:
    """Per layer the vertex rows with the sums they received; the last holds the logits."""
    carried = [*TO[1:], "label", "row_weight", *SPLITS]
    last = len(dims) - 2
    if last == 0:
        rows = layout.vertices.select("id", "scale", *carried, "ax")
        return [_only_layer(rows, shared)]
    states = []
    messages = _first_messages(layout, shared, dims[2])
    for layer in range(1, last + 1):
        columns = carried if layer == last else TO[1:]
        state = _received(layout, messages, dims[layer + 1], columns)
        if layer < last:
            state = state.persist(StorageLevel.MEMORY_AND_DISK)
            messages = _next_messages(state, shared, layer + 1)
        states.append(state)
    return states


def _only_layer(rows: DataFrame, shared) -> DataFrame:
    """A single layer needs no message passing at all: its logits are ``ax @ W``."""
    kept = [c for c in rows.columns if c not in ("ax", "scale")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in kept)

    def logits(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        out = matrix_of(batch.column("ax")) @ shared.value[0]
        same = {c: batch.column(c) for c in kept}
        return {**same, "scale": pa.array(np.ones(batch.num_rows)), "vec": vectors_of(out)}

    return map_batches(rows, f"{schema}, scale double, vec array<double>", logits)


def _partial_sums(
    rows: DataFrame, of_batch: Callable[[pa.RecordBatch], dict[int, np.ndarray]]
) -> DataFrame:
    """Per task, the sum of the matrices that ``of_batch`` gives per layer, as pieces."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                for layer, part in of_batch(batch).items():
                    totals[layer] = totals[layer] + part if layer in totals else part
        for layer, total in totals.items():
            yield from matrix_pieces(total, layer)

    return rows.mapInArrow(add_up, MATRIX_PIECES)


def _first_gradients(rows: DataFrame, shared) -> DataFrame:
    """Gradients of the first two layers from ``ax`` and the gradient sums of the second."""

    def of_batch(batch: pa.RecordBatch) -> dict[int, np.ndarray]:
        w = shared.value
        ax = matrix_of(batch.column("ax"))
        z = ax @ w[0]
        received = matrix_of(batch.column("vec")) * _scale(batch)
        back = (received @ w[1].T) * (z > 0)
        return {0: ax.T @ back, 1: _relu(z).T @ received}

    return _partial_sums(rows, of_batch)


def _only_gradient(layout: Layout, scored: DataFrame) -> DataFrame:
    rows = layout.vertices.select("id", "ax").join(scored.select("id", "vec"), "id")
    return _partial_sums(
        rows, lambda b: {0: matrix_of(b.column("ax")).T @ matrix_of(b.column("vec"))}
    )


def _inner_gradient(rows: DataFrame, layer: int) -> DataFrame:
    def of_batch(batch: pa.RecordBatch) -> dict[int, np.ndarray]:
        scale = _scale(batch)
        hidden = _relu(matrix_of(batch.column("z")) * scale)
        return {layer: hidden.T @ (matrix_of(batch.column("vec")) * scale)}

    return _partial_sums(rows, of_batch)


def _inner_messages(rows: DataFrame, shared, layer: int) -> DataFrame:
    """Gradient messages below ``layer``."""

    def send(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        scale = _scale(batch)
        received = matrix_of(batch.column("vec")) * scale
        back = (received @ shared.value[layer].T) * (matrix_of(batch.column("z")) > 0)
        return {**_address(batch), "vec": vectors_of(back * scale)}

    return map_batches(rows, MESSAGE, send)


def _gradient_pieces(
    layout: Layout, scored: DataFrame, states: list[DataFrame], shared, dims: list[int]
) -> tuple[DataFrame, list[DataFrame]]:
    """Partial gradients of all layers, and the tables persisted on the way."""
    last = len(dims) - 2
    if last == 0:
        return _only_gradient(layout, scored), []
    pieces, kept = [], []
    messages = scored.select(*TO, "vec")
    for layer in range(last, 1, -1):
        summed = layout.send(messages, dims[layer + 1])
        below = states[layer - 2].withColumnRenamed("vec", "z")
        rows = below.join(summed, "id").persist(StorageLevel.MEMORY_AND_DISK)
        kept.append(rows)
        pieces.append(_inner_gradient(rows, layer))
        messages = _inner_messages(rows, shared, layer)
    rows = _received(layout, messages, dims[2], ["ax"])
    pieces.append(_first_gradients(rows, shared))
    return reduce(DataFrame.unionByName, pieces), kept


# ------------------------------------------------------------------ parts that fit a task

_LOCAL = (
    "id bigint, label bigint, is_train boolean, is_val boolean, is_test boolean, pred bigint, loss double,"
    f" {MATRIX_PIECES}"
)

_LOCAL_NAMES = ["id", "label", *SPLITS, "pred", "loss", "layer", "i", "j0", "vec"]


def _local_epoch(layout: Layout, shared, dims: list[int]) -> DataFrame:
    """Forward and backward of every part where it lies: scored vertices, and the part's gradients as matrix pieces.

    Cached edges and vertices meet in place, so the plan has no exchange. The edge
    weights are symmetric, hence gradients pass the same way as messages.
    """
    last = len(dims) - 2

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        w = shared.value
        ids, label = (right.column(c).to_numpy() for c in ("id", "label"))
        scale = right.column("scale").to_numpy()[:, None]
        edges = SlotEdges(left, ids, ids)
        ax = matrix_of(right.column("ax"))
        z = [ax @ w[0]]
        for layer in range(1, last + 1):
            z.append(edges.sums(_relu(z[-1]) @ w[layer] * scale) * scale)
        powers = np.exp(z[-1] - z[-1].max(axis=1, keepdims=True))
        probs = powers / powers.sum(axis=1, keepdims=True)
        row = np.arange(len(label))
        loss = -np.log(np.clip(probs[row, label], P_MIN, P_MAX))
        probs[row, label] -= 1.0
        back = probs * right.column("row_weight").to_numpy()[:, None]
        pieces = []
        for layer in range(last, 0, -1):
            received = edges.sums(back * scale) * scale
            pieces += matrix_pieces(_relu(z[layer - 1]).T @ received, layer)
            back = (received @ w[layer].T) * (z[layer - 1] > 0)
        pieces += matrix_pieces(ax.T @ back, 0)
        scored = {c: right.column(c) for c in ("id", "label", *SPLITS)}
        scored = pa.table({**scored, "pred": z[-1].argmax(axis=1), "loss": loss})
        both = pa.concat_tables([scored, pa.Table.from_batches(pieces)], promote_options="default")
        return both.select(_LOCAL_NAMES)

    columns = ["slot", "id", "scale", "label", "row_weight", *SPLITS, "ax"]
    met = layout.edges.groupBy("slot").cogroup(layout.vertices.select(*columns).groupBy("slot"))
    return met.applyInArrow(run, _LOCAL)


#: Up to this many tasks their partial gradients are added in one step.
FLAT_TASKS = 64


def _branches(tasks: int) -> int:
    """Width of the first level of the gradient tree: about the root of the task count."""
    return 1 if tasks <= FLAT_TASKS else int(tasks**0.5)


@dataclass
class Epoch:
    """One forward pass with its persisted tables; ``close`` frees them."""

    scored: DataFrame
    states: list[DataFrame]
    shared: object
    broadcast_time: float
    pieces: DataFrame | None = None

    def close(self) -> None:
        self.scored.unpersist()
        for state in self.states:
            state.unpersist()
        self.shared.destroy()


def open_epoch(layout: Layout, weights: list[np.ndarray], dims: list[int]) -> Epoch:
    spark = layout.vertices.sparkSession
    start = time.perf_counter()
    shared = spark.sparkContext.broadcast(weights)
    sent = time.perf_counter() - start
    if layout.local:
        done = _local_epoch(layout, shared, dims).persist(StorageLevel.MEMORY_AND_DISK)
        pieces = done.filter("layer IS NOT NULL").select("layer", "i", "j0", "vec")
        return Epoch(done.filter("layer IS NULL"), [done], shared, sent, pieces)
    states = _logit_states(layout, shared, dims)
    scored = _score(states[-1]).persist(StorageLevel.MEMORY_AND_DISK)
    return Epoch(scored, states[:-1], shared, sent)


def score_row(epoch: Epoch) -> DataFrame:
    """Loss and split metrics of the weights the epoch started from, in one row."""
    return evaluate_splits(epoch.scored, loss="loss")


def gradients(
    layout: Layout, epoch: Epoch, dims: list[int], branches: int | None = None
) -> tuple[DataFrame, list[DataFrame]]:
    """Summed gradients of all layers as pieces; nothing vertex-sized leaves the cluster."""
    if epoch.pieces is not None:
        return sum_matrices(epoch.pieces, max(dims[1:]), branches or _branches(layout.tasks)), []
    pieces, kept = _gradient_pieces(layout, epoch.scored, epoch.states, epoch.shared, dims)
    return sum_matrices(pieces, max(dims[1:]), branches or _branches(layout.tasks)), kept


def run_epoch(
    layout: Layout, weights: list[np.ndarray], dims: list[int], lr: float
) -> tuple[list[np.ndarray], dict]:
    """One epoch: ``(new weights, metrics)``. Metrics belong to the weights before the update."""
    start = time.perf_counter()
    epoch = open_epoch(layout, weights, dims)
    kept: list[DataFrame] = []
    try:
        scores = score_row(epoch).first()
        forward_end = time.perf_counter()
        summed, kept = gradients(layout, epoch, dims)
        pieces = summed.collect()
        backward_end = time.perf_counter()
        grads = matrices_of(pieces, dims)
        updated = [w - lr * g for w, g in zip(weights, grads, strict=True)]
        update_end = time.perf_counter()
    finally:
        for table in kept:
            table.unpersist()
        epoch.close()
    return updated, {
        "forward_time": forward_end - start - epoch.broadcast_time,
        "backward_time": backward_end - forward_end,
        "comm_time": epoch.broadcast_time if layout.parts is not None else 0.0,
        "update_time": update_end - backward_end,
        "loss": scores["loss"],
        "train_acc": scores["train_acc"],
        "val_f1": scores["val_f1"],
        "test_f1": scores["test_f1"],
        "epoch_time": time.perf_counter() - start,
    }


def train_layout(layout: Layout, config: TrainConfig) -> TrainResult:
    dims = layer_dims(layout.input_dim, config.hidden_dim, layout.num_classes, config.num_layers)
    weights = config.init(dims, config.seed)
    metrics = []
    for number in range(1, config.epochs + 1):
        weights, measured = run_epoch(layout, weights, dims, config.learning_rate)
        metrics.append({"epoch": number, **measured})
    return TrainResult(weights, metrics)


def train_full_graph(nodes: DataFrame, edges: DataFrame, config: TrainConfig) -> TrainResult:
    """Train over all edges. ``edges`` are raw; preparation is part of the layout."""
    layout = lay_out(nodes, edges)
    try:
        return train_layout(layout, config)
    finally:
        layout.release()


def train_partition_local(
    nodes: DataFrame,
    edges: DataFrame,
    config: TrainConfig,
    parts: int,
    local_input: str = "normalized",
) -> TrainResult:
    """Train over independent parts: edges between parts are dropped, gradients averaged."""
    layout = lay_out(nodes, edges, parts=parts, local_input=local_input)
    try:
        return train_layout(layout, config)
    finally:
        layout.release()


def predict_layout(layout: Layout, weights: list[np.ndarray]) -> DataFrame:
    """``(id, label, splits, pred)`` of all vertices, as a written table."""
    dims = [weights[0].shape[0], *[w.shape[1] for w in weights]]
    epoch = open_epoch(layout, weights, dims)
    try:
        scored = epoch.scored.select("id", "label", *SPLITS, "pred")
        return written(scored, "predictions", layout.caller)
    finally:
        epoch.close()
