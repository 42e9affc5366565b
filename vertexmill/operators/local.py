"""Partition-local training, operator by operator.

A part is a block of one block-diagonal edge table, so forward and backward
passes are the full-graph ones; only sums that belong to a part carry its id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vertexmill.functions import vectors as V
from vertexmill.functions.scalars import part_of
from vertexmill.operators.gcn import (
    Forward,
    backward,
    gcn_forward,
    output_grad,
    row_loss,
)
from vertexmill.operators.messages import SpreadEdges, message_pass
from vertexmill.operators.partition import (
    assign_parts,
    small_side,
    train_rows_per_part,
    unit_blocks,
)
from vertexmill.operators.prepare import normalize_and_spread

#: Partial matrices a task keeps before it sends them on.
PARTIALS_KEPT = 32


def local_edges(edges: DataFrame, nodes: DataFrame, parts: int) -> SpreadEdges:
    """Block-diagonal edges of all parts, hubs split. ``edges`` as for ``local_normalize``."""
    return normalize_and_spread(unit_blocks(edges, parts), nodes)


def local_forward(
    blocks: SpreadEdges, nodes: DataFrame, weights: list[np.ndarray]
) -> Forward:
    """Forward run of every part over its own edges."""
    return gcn_forward(blocks, nodes.select("id", F.col("features").alias("vec")), weights)


def local_targets(nodes: DataFrame, parts: int) -> DataFrame:
    """``row_weight`` of the mean over the training rows of a row's own part."""
    share = F.try_divide(F.lit(1.0), F.col("n_train"))
    return (
        assign_parts(nodes, parts)
        .join(small_side(train_rows_per_part(nodes, parts), parts), "pid", "left")
        .withColumn(
            "row_weight",
            F.when(F.col("is_train"), F.coalesce(share, F.lit(0.0))).otherwise(F.lit(0.0)),
        )
    )


def local_weight_grad(inputs: DataFrame, message_grad: DataFrame, parts: int) -> DataFrame:
    """``H^T dM`` per part as ``(pid, layer, i, j0, vec)`` pieces.

    A task sums per part and sends what it holds whenever it holds many parts.
    """
    both = inputs.select("id", F.col("vec").alias("a")).join(
        message_grad.select("id", F.col("vec").alias("b")), "id"
    )
    rows = both.select(part_of(F.col("id"), parts).alias("pid"), "a", "b")

    def pieces(totals: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for pid, total in totals.items():
            for piece in V.matrix_pieces(total, 0):
                marked = pa.array(np.full(piece.num_rows, pid, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [marked, *piece.columns], names=["pid", *piece.schema.names]
                )

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for pid in pc.unique(batch.column("pid")).to_pylist():
                own = batch.filter(pc.equal(batch.column("pid"), pid))
                part = V.matrix_of(own.column("a")).T @ V.matrix_of(own.column("b"))
                totals[pid] = totals[pid] + part if pid in totals else part
                if len(totals) > PARTIALS_KEPT:
                    yield from pieces(totals)
                    totals = {}
        yield from pieces(totals)

    sums = rows.mapInArrow(add_up, f"pid int, {V.MATRIX_PIECES}")
    return V.sum_vectors(sums, ["pid", "layer", "i", "j0"], V.PIECE)


def local_grads(
    blocks: SpreadEdges, run: Forward, nodes: DataFrame, weights: list[np.ndarray], parts: int
) -> DataFrame:
    """Gradient of every part's own mean loss: ``(pid, layer, i, j, v)``."""
    grad = output_grad(run.logits, local_targets(nodes, parts))
    found = backward(blocks, run, grad, weights, partial(local_weight_grad, parts=parts))
    return found.select("pid", "layer", "i", "j0", F.posexplode("vec").alias("at", "v")).select(
        "pid", "layer", "i", (F.col("j0") + F.col("at")).alias("j"), "v"
    )


def average_gradients(grads: DataFrame, parts: int) -> DataFrame:
    """Plain mean over all parts, those without training rows included."""
    return grads.groupBy("layer", "i", "j").agg((F.sum("v") / parts).alias("v"))


def tree_average(grads: DataFrame, parts: int, branches: int) -> DataFrame:
    """The same mean as a two-level tree: sums per branch of parts first."""
    branch = F.pmod(F.col("pid"), F.lit(branches))
    level = grads.groupBy("layer", "i", "j", branch.alias("branch")).agg(F.sum("v").alias("v"))
    return average_gradients(level, parts)


def loss_per_part(logits: DataFrame, nodes: DataFrame, parts: int) -> DataFrame:
    """``(pid, loss, n_train)``; a part without training rows has loss 0."""
    known = assign_parts(nodes, parts).select("id", "pid", "label", "is_train")
    loss = row_loss(V.softmax(F.col("vec")), F.col("label"))
    return (
        logits.join(known, "id")
        .groupBy("pid")
        .agg(
            F.coalesce(F.avg(F.when(F.col("is_train"), loss)), F.lit(0.0)).alias("loss"),
            F.count_if("is_train").alias("n_train"),
        )
    )


def weighted_loss(losses: DataFrame) -> DataFrame:
    """Loss over all parts, weighted by training rows; 0 if there are none."""
    total = F.sum(F.col("loss") * F.col("n_train"))
    return losses.agg((total / F.greatest(F.sum("n_train"), F.lit(1))).alias("loss"))
