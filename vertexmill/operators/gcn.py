"""Graph convolution, operator by operator. Vectors are ``(id, vec)`` tables.

``edges`` is the normalised, symmetric table, so one table serves the forward
and the backward direction. What a pass over the edges brings is written once
and read by all that need it, so a run makes one pass per layer and direction. The
training plan composes the same steps with fewer; see ``vertexmill.plans.trainer``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vertexmill.functions import vectors as V
from vertexmill.operators.messages import SpreadEdges, message_pass
from vertexmill.runtime import drop_written, written

# ---------------------------------------------------------------- weights


def layer_dims(input_dim: int, hidden_dim: int, classes: int, num_layers: int) -> list[int]:
    return [input_dim] + [hidden_dim] * (num_layers - 1) + [classes]


def init_weights(dims: list[int], seed: int) -> list[np.ndarray]:
    """Seeded normal weights with deviation ``sqrt(2 / (fan_in + fan_out))``.

    Fixed values: generator, draw order, rounding to single precision and deviation
    decide the weights that published runs start from.
    """
    rng = np.random.RandomState(seed)
    return [
        rng.randn(a, b).astype(np.float32) * np.sqrt(2.0 / (a + b))
        for a, b in zip(dims[:-1], dims[1:], strict=True)
    ]


def wave_weights(dims: list[int], seed: int = 0) -> list[np.ndarray]:
    """Weights from a formula, for results that plain SQL can reproduce."""
    made = []
    for layer, (a, b) in enumerate(zip(dims[:-1], dims[1:], strict=True)):
        i, j = np.arange(a)[:, None], np.arange(b)[None, :]
        made.append(np.sqrt(2.0 / (a + b)) * np.sin(1.0 + 7 * i + 13 * j + 29 * layer + seed))
    return made


def weights_table(spark, weights: list[np.ndarray]) -> DataFrame:
    """``(layer, i, j, v)``; model-sized, made on the driver like the weights themselves."""
    rows = [
        (layer, i, j, float(w[i, j]))
        for layer, w in enumerate(weights)
        for i in range(w.shape[0])
        for j in range(w.shape[1])
    ]
    return spark.createDataFrame(rows, "layer int, i int, j int, v double")


# ---------------------------------------------------------------- forward


def relu_layer(pre_activation: DataFrame) -> DataFrame:
    return pre_activation.withColumn("vec", V.relu(F.col("vec")))


def gcn_layer(
    edges: DataFrame | SpreadEdges, inputs: DataFrame, weights: np.ndarray, apply_relu: bool = True
) -> DataFrame:
    """One layer: ``(id, pre, vec)`` with ``pre = A (H W)`` and its activation."""
    summed = message_pass(edges, V.project(inputs, weights), weights.shape[1])
    pre = summed.withColumnRenamed("vec", "pre")
    return pre.withColumn("vec", V.relu(F.col("pre")) if apply_relu else F.col("pre"))


@dataclass
class Forward:
    """Logits and, per layer, what the backward pass needs: ``pre`` and, read from it, ``inputs``.

    ``pre`` are written tables; ``release`` deletes them.
    """

    logits: DataFrame
    inputs: list[DataFrame] = field(default_factory=list)
    pre: list[DataFrame] = field(default_factory=list)

    def release(self) -> None:
        drop_written(*self.pre)


def gcn_forward(
    edges: DataFrame | SpreadEdges, features: DataFrame, weights: list[np.ndarray]
) -> Forward:
    """All layers; the last one stays linear. Runs one edge pass per layer."""
    run = Forward(logits=features)
    for layer, w in enumerate(weights):
        run.inputs.append(run.logits if layer == 0 else relu_layer(run.logits))
        summed = message_pass(edges, V.project(run.inputs[layer], w), w.shape[1])
        run.logits = written(summed, f"layer-{layer}")
        run.pre.append(run.logits)
    return run


def predict(logits: DataFrame) -> DataFrame:
    """Class with the largest logit, the lowest one on ties."""
    return logits.select("id", V.argmax(F.col("vec")).cast("bigint").alias("pred"))


# ---------------------------------------------------------------- loss

#: Probabilities are kept inside this interval before the logarithm.
P_MIN, P_MAX = 1e-15, 1.0


def row_loss(probs: Column, label: Column) -> Column:
    p = F.get(probs, label.cast("int"))
    return -F.log(F.least(F.greatest(p, F.lit(P_MIN)), F.lit(P_MAX)))


def ce_loss(logits: DataFrame, nodes: DataFrame, mask: Column | None = None) -> DataFrame:
    """Mean cross-entropy over the masked rows; 0 if there are none."""
    chosen = nodes.filter(F.col("is_train") if mask is None else mask).select("id", "label")
    per_row = logits.join(chosen, "id").select(
        row_loss(V.softmax(F.col("vec")), F.col("label")).alias("loss")
    )
    return per_row.agg(F.coalesce(F.avg("loss"), F.lit(0.0)).alias("loss"))


def output_grad(logits: DataFrame, targets: DataFrame) -> DataFrame:
    """``(p - onehot) * row_weight``.

    ``targets(id, label, row_weight)``: 1 / n_train on training rows and 0
    elsewhere gives the gradient of the mean loss.
    """
    known = targets.select("id", "label", "row_weight")
    hit = lambda p, k: F.when(k == F.col("label"), p - 1.0).otherwise(p)
    return logits.join(known, "id").select(
        "id",
        F.transform(
            F.transform(V.softmax(F.col("vec")), hit), lambda g: g * F.col("row_weight")
        ).alias("vec"),
    )


def mean_loss_weights(nodes: DataFrame) -> DataFrame:
    """``row_weight`` of the mean over all training rows."""
    n_train = nodes.agg(F.count_if("is_train")).scalar()
    share = F.coalesce(F.try_divide(F.lit(1.0), n_train), F.lit(0.0))
    return nodes.withColumn("row_weight", F.when(F.col("is_train"), share).otherwise(F.lit(0.0)))


# ---------------------------------------------------------------- backward


def relu_grad(grad: DataFrame, pre: DataFrame) -> DataFrame:
    gated = V.relu_gate(F.col("vec"), F.col("z"))
    return grad.join(pre.select("id", F.col("vec").alias("z")), "id").select(
        "id", gated.alias("vec")
    )


def weight_grad(inputs: DataFrame, message_grad: DataFrame) -> DataFrame:
    """``H^T dM`` as ``(layer, i, j, v)`` with layer 0."""
    return V.pieces_to_long(V.outer_sum(inputs, message_grad))


def input_grad(message_grad: DataFrame, weights: np.ndarray) -> DataFrame:
    """``dM W^T``."""
    return V.project(message_grad, np.ascontiguousarray(weights.T))


def backward(
    edges: DataFrame | SpreadEdges,
    run: Forward,
    grad: DataFrame,
    weights: list[np.ndarray],
    of_layer: Callable[[DataFrame, DataFrame], DataFrame],
) -> DataFrame:
    """``of_layer(inputs, message_grad)`` of all layers, marked by ``layer``, as a written table.

    Runs one edge pass per layer. Sums that two readers need are written and deleted again.
    """
    found, passed = None, []
    for layer in reversed(range(len(weights))):
        if layer < len(weights) - 1:
            grad = relu_grad(grad, run.pre[layer])
        messages = message_pass(edges, grad, weights[layer].shape[1])
        if layer:
            messages = written(messages, f"messages-{layer}")
            passed.append(messages)
            grad = input_grad(messages, weights[layer])
        own = of_layer(run.inputs[layer], messages).withColumn("layer", F.lit(layer))
        found = own if found is None else found.unionByName(own)
    made = written(found, "gradients")
    drop_written(*passed)
    return made


def gcn_backward(
    edges: DataFrame | SpreadEdges, run: Forward, grad: DataFrame, weights: list[np.ndarray]
) -> DataFrame:
    """Gradients of all layers as ``(layer, i, j, v)``."""
    return backward(edges, run, grad, weights, weight_grad)


def sgd_step(weights: DataFrame, grads: DataFrame, lr: float) -> DataFrame:
    """``W - lr * dW`` over two model-sized tables."""
    step = grads.select("layer", "i", "j", F.col("v").alias("g"))
    return weights.join(step, ["layer", "i", "j"], "left").select(
        "layer", "i", "j", (F.col("v") - lr * F.coalesce("g", F.lit(0.0))).alias("v")
    )
