"""Inputs that must not give a quiet wrong answer, and plans that must not shuffle too much."""

import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vertexmill.functions import vectors as V
from vertexmill.operators import partition as C
from vertexmill.operators import prepare as B
from vertexmill.plans import experiments
from vertexmill.plans.layout import block_edges, lay_out, row_weights
from vertexmill.plans.trainer import TrainConfig
from vertexmill.sources.nodes import load_nodes
from vertexmill.sources.runs import read_metrics, read_summary


def graph(spark, edges, n=4):
    rows = [(k, [float(k), 1.0], k % 2, k % 3 == 0, k % 3 == 1, k % 3 == 2) for k in range(n)]
    nodes = spark.createDataFrame(
        rows, "id bigint, features array<double>, label bigint, is_train boolean, is_val boolean, is_test boolean"
    )
    return nodes, spark.createDataFrame(edges, "src bigint, dst bigint, w double")


def test_null_elements_are_errors(spark):
    rows = spark.createDataFrame([(0, [1.0, None, 3.0])], "id bigint, vec array<double>")
    with pytest.raises(Exception, match="null in a vector"):
        V.sum_vectors(rows, ["id"], 3).collect()
    table = rows.selectExpr("id", "vec AS feature", "0 AS label", "1 AS node_types")
    with pytest.raises(Exception, match="null in the features of node 0"):
        load_nodes(table).collect()


def test_short_vectors_still_add_up(spark):
    rows = spark.createDataFrame([(0, [1.0]), (0, [1.0, 2.0])], "id bigint, vec array<double>")
    assert V.sum_vectors(rows, ["id"], 3).first()["vec"] == [2.0, 2.0]


def test_ragged_rows_are_errors(spark):
    with pytest.raises(ValueError, match="length"):
        V.matrix_of(pa.array([[1.0, 2.0, 3.0], [1.0]]))
    with pytest.raises(ValueError, match="null"):
        V.matrix_of(pa.array([[1.0], None]))
    nodes, _ = graph(spark, [(0, 1, 1.0)])
    ragged = nodes.withColumn("features", F.expr("slice(features, 1, 1 + CAST(id AS int) % 2)"))
    with pytest.raises(Exception, match="length"):
        B.standardize(ragged).collect()


def test_edges_to_unknown_ids_are_errors(spark):
    nodes, edges = graph(spark, [(0, 1, 1.0), (0, 99, 1.0)])
    with pytest.raises(ValueError, match="outside the node table"):
        lay_out(nodes, edges)


def test_negative_ids_are_errors(spark):
    nodes, edges = graph(spark, [(0, 1, 1.0)])
    shifted = nodes.withColumn("id", F.col("id") - 1)
    with pytest.raises(ValueError, match="negative"):
        lay_out(shifted, edges.selectExpr("src - 1 AS src", "dst - 1 AS dst", "w"))


def test_failed_runs_are_errors_or_marked(spark, monkeypatch):
    nodes, edges = graph(spark, [(0, 3, 1.0), (1, 2, 1.0)])
    real = experiments.train_layout

    def failing(layout, config):
        if layout.parts is not None and config.seed == 2:
            raise RuntimeError("lost")
        return real(layout, config)

    monkeypatch.setattr(experiments, "train_layout", failing)
    config = TrainConfig(epochs=1, hidden_dim=2)
    with pytest.raises(RuntimeError, match="lost"):
        experiments.experiment_grid(nodes, edges, config, part_counts=[2], seeds=[1, 2])
    marked = experiments.experiment_grid(
        nodes, edges, config, part_counts=[2], seeds=[1, 2], mark_failed=True
    ).collect()
    assert [(r["config"], r["run"], r["loss"]) for r in marked if r["epoch"] == 0] == [("spark_2", 2, None)]
    assert len(marked) == 4


def test_metrics_are_read_by_name(spark, tmp_path):
    folder = tmp_path / "m"
    folder.mkdir()
    (folder / "spark_4_run1_metrics.csv").write_text("epoch,loss,epoch_time,config\n1,3.5,10.0,spark_4\n")
    row = read_metrics(spark, str(folder)).first()
    assert (row["epoch_time"], row["loss"], row["config"], row["val_f1"]) == (10.0, 3.5, "spark_4", None)
    (folder / "spark_8_run1_metrics.csv").write_text("epoch,epoch_time,loss,config\n1,10.0,3.5,spark_8\n")
    with pytest.raises(Exception, match="CSV header"):
        read_metrics(spark, str(folder)).collect()
    (tmp_path / "s.csv").write_text("test_f1_mean,config\n0.5,spark_4\n")
    assert read_summary(spark, str(tmp_path / "s.csv")).first()["test_f1_mean"] == 0.5


# ---------------------------------------------------------------- plans and cost


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_parts_are_filtered_before_the_merge(spark):
    nodes, edges = graph(spark, [(0, 1, 1.0), (0, 2, 1.0)])
    tree = plan(B.undirected(block_edges(edges, 2), nodes)).splitlines()
    merge = next(k for k, line in enumerate(tree) if "Aggregate" in line)
    cut = next(k for k, line in enumerate(tree) if "Filter" in line and "pmod" in line)
    assert cut > merge  # further down the tree


def test_training_counts_come_by_broadcast(spark):
    nodes, _ = graph(spark, [(0, 1, 1.0)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tree = row_weights(nodes, 4)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in tree and "SortMergeJoin" not in tree


def test_dense_ids_need_no_join(spark):
    nodes, edges = graph(spark, [(0, 2, 1.0), (1, 3, 0.5), (0, 1, 1.0), (2, 40, 1.0)])
    inside = C.intra_edges(edges, nodes, 2)
    assert "Join" not in plan(inside) and "Sort" not in plan(inside)
    assert sorted(map(tuple, inside.collect())) == [(0, 0, 1, 1.0), (1, 0, 1, 0.5)]
    gaps = nodes.withColumn("id", F.col("id") * 3)
    told = {r["id"]: (r["pid"], r["local_id"]) for r in C.local_ids(gaps, 2).collect()}
    assert told == {0: (0, 0), 6: (0, 1), 3: (1, 0), 9: (1, 1)}


def test_moments_bear_large_means_and_send_no_row_per_value(spark):
    random = np.random.default_rng(0)
    rows = [(k, [1e9 + float(x), 5.0]) for k, x in enumerate(random.normal(size=500))]
    nodes = spark.createDataFrame(rows, "id bigint, features array<double>").repartition(7)
    want = np.array([r[1] for r in rows])
    got = {r["k"]: r for r in B.feature_moments(nodes).collect()}
    assert np.isclose(got[0]["std"], want[:, 0].std(), rtol=1e-6) and got[1]["std"] == 0
    assert np.isclose(got[0]["mean"], want[:, 0].mean(), rtol=1e-15)
    assert "Generate" not in plan(B.feature_moments(nodes))


def test_softmax_is_linear_in_the_classes(spark):
    def seconds(classes):
        rows = spark.range(20_000).select(
            F.transform(F.sequence(F.lit(1), F.lit(classes)), lambda k: F.sin(k * F.col("id"))).alias("v")
        ).persist()
        rows.count()
        took = []
        for _ in range(3):
            start = time.perf_counter()
            rows.select(V.softmax(F.col("v")).alias("p")).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        rows.unpersist()
        return min(took)

    seconds(16)
    assert seconds(128) < 20 * seconds(16) + 0.5  # a cubic one would take 500 times as long
    values = spark.createDataFrame([([1.0, 2.0, 1000.0],)], "v array<double>")
    assert values.select(V.softmax(F.col("v"))).first()[0] == [0.0, 0.0, 1.0]
