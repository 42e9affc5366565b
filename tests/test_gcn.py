from pathlib import Path
from urllib.parse import urlparse

import dense
import numpy as np
import pytest
from pyspark.sql import functions as F

from vertexmill.functions import vectors as V
from vertexmill.operators import evaluate as S
from vertexmill.operators import gcn as D
from vertexmill.operators import prepare as B
from vertexmill.operators.messages import message_pass


def features(toy):
    return toy.nodes_df.select("id", F.col("features").alias("vec"))


def gradient_matrices(df, dims):
    made = [np.zeros(s) for s in zip(dims[:-1], dims[1:], strict=True)]
    for r in df.collect():
        made[r["layer"]][r["i"], r["j"]] = r["v"]
    return made


@pytest.mark.parametrize("hidden", [[], [4], [6, 3]])
def test_forward_and_backward_equal_the_dense_model(spark, hidden):
    toy = dense.Toy(spark)
    dims = [5, *hidden, 3]
    weights = D.wave_weights(dims)
    edges = B.normalize_edges(toy.edges_df, toy.nodes_df).persist()
    run = D.gcn_forward(edges, features(toy), weights)
    a = dense.normalized(dense.whole(toy.n, toy.edges))
    logits, grads = dense.gradients(a, toy.x, toy.labels, toy.row_weight(), weights)
    assert np.allclose(dense.matrix(run.logits, toy.n, 3), logits)
    grad = D.output_grad(run.logits, D.mean_loss_weights(toy.nodes_df))
    found = gradient_matrices(D.gcn_backward(edges, run, grad, weights), dims)
    for got, want in zip(found, grads, strict=True):
        assert np.allclose(got, want)
    loss = D.ce_loss(run.logits, toy.nodes_df).first()[0]
    assert loss == pytest.approx(dense.loss(logits, toy.labels, toy.masks[0]))


def test_a_run_makes_one_edge_pass_per_layer_and_direction(spark, monkeypatch):
    toy = dense.Toy(spark)
    weights = D.wave_weights([5, 4, 3])
    edges = B.normalize_edges(toy.edges_df, toy.nodes_df).persist()
    passes = spark.sparkContext.accumulator(0)

    def counted(edges, vectors, width):
        def count(batches):
            for batch in batches:
                passes.add(batch.num_rows)
                yield batch

        return message_pass(edges, vectors.mapInArrow(count, vectors.schema), width)

    monkeypatch.setattr(D, "message_pass", counted)
    run = D.gcn_forward(edges, features(toy), weights)
    D.gcn_backward(edges, run, D.output_grad(run.logits, D.mean_loss_weights(toy.nodes_df)), weights).collect()
    assert passes.value == 4 * toy.n
    # readers of a layer find its table, not the passes that led to it
    plan = run.inputs[1]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "FileScan parquet" in plan
    folders = {Path(urlparse(f).path).parent for t in run.pre for f in t.inputFiles()}
    run.release()
    assert len(folders) == 2 and not any(f.exists() for f in folders)


def test_layer_by_hand(spark):
    edges = spark.createDataFrame(
        [(0, 1, 0.5), (1, 0, 2.0), (2, 2, -1.0)], "src bigint, dst bigint, w double"
    )
    h = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, -1.0]), (2, [1.0, 0.0])],
                              "id bigint, vec array<double>")
    out = D.gcn_layer(edges, h, np.array([[1.0, 0.0], [0.0, -1.0]]))
    assert dense.matrix(out, 3, 2, "pre").tolist() == [[6.0, 2.0], [0.5, -1.0], [-1.0, 0.0]]
    assert dense.matrix(out, 3, 2).tolist() == [[6.0, 2.0], [0.5, 0.0], [0.0, 0.0]]


def test_gradients_by_finite_differences():
    rng = np.random.default_rng(3)
    n, dims, eps = 6, [3, 4, 2], 1e-5
    edges = [(int(u), int(v), 1.0) for u, v in rng.integers(0, n, size=(8, 2))]
    a, x = dense.normalized(dense.whole(n, edges)), rng.normal(size=(n, 3))
    labels, train = np.arange(n) % 2, np.arange(n) < 4
    weights = D.wave_weights(dims)
    _, grads = dense.gradients(a, x, labels, train / train.sum(), weights)
    for layer, w in enumerate(weights):
        for i in range(w.shape[0]):
            for j in range(w.shape[1]):
                both = []
                for step in (eps, -eps):
                    moved = [m.copy() for m in weights]
                    moved[layer][i, j] += step
                    both.append(dense.loss(dense.forward(a, x, moved)[0], labels, train))
                slope = (both[0] - both[1]) / (2 * eps)
                assert abs(slope - grads[layer][i, j]) < 1e-4 * max(1, abs(slope))


def test_softmax_sums_to_one_for_large_logits(spark):
    rows = spark.createDataFrame([(0, [1000.0, 1000.0]), (1, [-1000.0, 0.0])],
                                 "id bigint, vec array<double>")
    got = dense.matrix(rows.select("id", V.softmax(F.col("vec")).alias("vec")), 2, 2)
    assert np.allclose(got, [[0.5, 0.5], [0.0, 1.0]])


def test_ties_take_the_lowest_class(spark):
    rows = spark.createDataFrame([(0, [1.0, 2.0, 2.0])], "id bigint, vec array<double>")
    assert D.predict(rows).first()["pred"] == 1


def test_probability_zero_is_clipped(spark):
    toy = spark.createDataFrame([(0, 0, True)], "id bigint, label bigint, is_train boolean")
    logits = spark.createDataFrame([(0, [0.0, 5000.0])], "id bigint, vec array<double>")
    assert D.ce_loss(logits, toy).first()[0] == pytest.approx(-np.log(1e-15))


def test_no_training_rows_give_no_loss_and_no_gradient(spark):
    toy = dense.Toy(spark, trained=False)
    logits = features(toy).select("id", F.slice("vec", 1, 3).alias("vec"))
    assert D.ce_loss(logits, toy.nodes_df).first()[0] == 0.0
    grad = D.output_grad(logits, D.mean_loss_weights(toy.nodes_df))
    assert not dense.matrix(grad, toy.n, 3).any()


def test_seeded_weights_have_the_right_shape_and_spread():
    dims = D.layer_dims(60, 32, 5, 3)
    assert dims == [60, 32, 32, 5]
    first, again = D.init_weights(dims, 42), D.init_weights(dims, 42)
    assert all((a == b).all() for a, b in zip(first, again, strict=True))
    assert first[0].std() == pytest.approx(np.sqrt(2 / 92), rel=0.05)


def predictions(spark, rows):
    return spark.createDataFrame(rows, "id bigint, label bigint, pred bigint, m boolean")


def test_macro_f1_covers_classes_of_either_side_inside_the_mask(spark):
    rows = [(0, 0, 0, True), (1, 0, 2, True), (2, 1, 1, True), (3, 5, 6, False)]
    got = S.macro_f1(predictions(spark, rows), F.col("m")).first()[0]
    # class 0: 2/3, class 1: 1, class 2 only predicted: 0; 5 and 6 are outside
    assert got == pytest.approx((2 / 3 + 1 + 0) / 3)


def test_empty_masks_give_zero(spark):
    rows = predictions(spark, [(0, 0, 0, False)])
    assert S.macro_f1(rows, F.col("m")).first()[0] == 0.0
    assert S.accuracy(rows, F.col("m")).first()[0] == 0.0


def test_random_predictions_against_the_plain_definition(spark):
    rng = np.random.default_rng(5)
    label, pred, mask = rng.integers(0, 7, 200), rng.integers(0, 9, 200), rng.random(200) < 0.5
    rows = [(i, int(label[i]), int(pred[i]), bool(mask[i])) for i in range(200)]
    table = predictions(spark, rows)
    assert S.macro_f1(table, F.col("m")).first()[0] == pytest.approx(
        dense.macro_f1(pred, label, mask)
    )
    assert S.accuracy(table, F.col("m")).first()[0] == pytest.approx((pred == label)[mask].mean())
