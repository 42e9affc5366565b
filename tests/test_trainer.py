import re
from concurrent.futures import ThreadPoolExecutor

import dense
import numpy as np
import pytest
from pyspark.sql import functions as F

from vertexmill.operators import gcn as D
from vertexmill.operators import local as L
from vertexmill.operators import prepare as B
from vertexmill.plans import experiments, trainer
from vertexmill.plans import layout as layouts
from vertexmill.plans.layout import lay_out, sum_columns, task_count
from vertexmill.sources.datasets import load_karate

SCORES = ("loss", "train_acc", "val_f1", "test_f1")


def config(layers=2, hidden=4, epochs=2, **more):
    return trainer.TrainConfig(
        num_layers=layers, hidden_dim=hidden, epochs=epochs, learning_rate=0.5,
        init=D.wave_weights, **more,
    )


def check(result, a, toy, row_weight, cfg):
    dims = D.layer_dims(toy.x.shape[1], cfg.hidden_dim, toy.classes, cfg.num_layers)
    weights, rows = dense.train(
        a, toy.x, toy.labels, toy.masks, row_weight, D.wave_weights(dims, cfg.seed),
        cfg.learning_rate, cfg.epochs,
    )
    for got, want in zip(result.metrics, rows, strict=True):
        assert [got[s] for s in SCORES] == pytest.approx([want[s] for s in SCORES])
    for got, want in zip(result.weights, weights, strict=True):
        assert np.allclose(got, want)


#: Layout options: compressed edge rows, or rows that are joined.
COMPRESSED, JOINED = {}, {"sum_bytes": 0, "part_bytes": 0}


def train(nodes, edges, cfg, **options):
    layout = lay_out(nodes, edges, **options)
    try:
        return trainer.train_layout(layout, cfg)
    finally:
        layout.release()


@pytest.mark.parametrize("layers, options", [(1, COMPRESSED), (2, COMPRESSED), (4, COMPRESSED), (1, JOINED), (3, JOINED)])
def test_full_graph_training_equals_the_dense_model(spark, layers, options):
    toy, cfg = dense.Toy(spark), config(layers)
    a = dense.normalized(dense.whole(toy.n, toy.edges))
    result = train(toy.nodes_df, toy.edges_df, cfg, **options)
    check(result, a, toy, toy.row_weight(), cfg)


@pytest.mark.parametrize("options", [JOINED, {"part_bytes": 0}])
def test_parts_over_several_tasks_equal_the_dense_model(spark, options):
    toy, cfg = dense.Toy(spark), config(3)
    a = dense.blocks(toy.n, toy.edges, 4, "normalized")
    result = train(toy.nodes_df, toy.edges_df, cfg, parts=4, **options)
    check(result, a, toy, toy.row_weight(4), cfg)


def test_parts_that_fit_a_task_train_in_place(spark):
    toy, cfg = dense.Toy(spark), config(3)
    layout = lay_out(toy.nodes_df, toy.edges_df, parts=4)
    assert layout.local
    dims = D.layer_dims(5, cfg.hidden_dim, toy.classes, 3)
    epoch = trainer.open_epoch(layout, D.wave_weights(dims), dims)
    done = epoch.states[0]
    plan = done._jdf.queryExecution().executedPlan().toString()
    # below the cached result: cached edges and vertices meet without an exchange or a sort
    above = plan.split("InMemoryTableScan [slot")[0]
    assert "FlatMapCoGroupsInArrow" in above and "Exchange" not in above and "Sort [" not in above
    epoch.close()
    result = trainer.train_layout(layout, cfg)
    layout.release()
    a = dense.blocks(toy.n, toy.edges, 4, "normalized")
    check(result, a, toy, toy.row_weight(4), cfg)


@pytest.mark.parametrize("parts, local_input", [(1, "raw"), (4, "normalized"), (10, "raw"), (50, "normalized")])
def test_partition_local_training_equals_the_dense_model(spark, parts, local_input):
    # with 10 parts four have no training row; with 50 some have no node
    toy, cfg = dense.Toy(spark), config()
    a = dense.blocks(toy.n, toy.edges, parts, local_input)
    result = trainer.train_partition_local(toy.nodes_df, toy.edges_df, cfg, parts, local_input)
    check(result, a, toy, toy.row_weight(parts), cfg)


def test_no_training_rows_leave_the_weights(spark):
    toy, cfg = dense.Toy(spark, trained=False), config(epochs=1)
    result = trainer.train_full_graph(toy.nodes_df, toy.edges_df, cfg)
    assert result.metrics[0]["loss"] == 0.0
    for got, want in zip(result.weights, D.wave_weights([5, 4, 3], cfg.seed), strict=True):
        assert np.array_equal(got, want)


def test_split_hubs_train_the_same(spark):
    toy = dense.Toy(spark)
    hub = [(0, i, 1.0) for i in range(toy.n)]
    toy.edges += hub
    toy.edges_df = spark.createDataFrame(toy.edges, "src bigint, dst bigint, w double")
    cfg = config()
    a = dense.normalized(dense.whole(toy.n, toy.edges))
    layout = lay_out(toy.nodes_df, toy.edges_df, hub_floor=4, **JOINED)
    assert layout.edges.filter("key < 0").count() > 0
    result = trainer.train_layout(layout, cfg)
    layout.release()
    check(result, a, toy, toy.row_weight(), cfg)
    check(train(toy.nodes_df, toy.edges_df, cfg, hub_floor=4), a, toy, toy.row_weight(), cfg)


def plan_lines(df, pattern):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if re.search(pattern, line)]


def test_edges_and_vertices_stay_where_they_are(spark):
    toy = dense.Toy(spark)
    layout = lay_out(toy.nodes_df, toy.edges_df, tasks=3, **JOINED)
    dims = [5, 4, 3]
    epoch = trainer.open_epoch(layout, D.wave_weights(dims), dims)
    state = trainer._logit_states(layout, epoch.shared, dims)[-1]
    # what moves is one vector per vertex copy, and one partial sum per target;
    # cached edges and vertices are neither exchanged nor sorted again
    assert len(plan_lines(state, "ShuffledHashJoin")) == 2
    assert len(plan_lines(state, "ENSURE_REQUIREMENTS")) == 2
    assert not plan_lines(state, r"[+:]- Sort \[")
    trainer.score_row(epoch).first()
    summed, _ = trainer.gradients(layout, epoch, dims)
    # the forward pass comes from its cache
    back = summed._jdf.queryExecution().executedPlan().toString()
    assert back.split("InMemoryRelation [id")[0].count("MapInArrow") == 1
    epoch.close()
    layout.release()


def test_compressed_edges_stay_where_they_are(spark):
    toy = dense.Toy(spark)
    layout = lay_out(toy.nodes_df, toy.edges_df, tasks=3)
    dims = [5, 4, 3]
    epoch = trainer.open_epoch(layout, D.wave_weights(dims), dims)
    state = trainer._logit_states(layout, epoch.shared, dims)[-1]
    # one vector per vertex copy moves to the blocks, and one partial sum per target from them
    assert len(plan_lines(state, "FlatMapCoGroupsInArrow")) == 1
    assert len(plan_lines(state, "ENSURE_REQUIREMENTS")) == 2
    epoch.close()
    layout.release()


def test_trainings_side_by_side_keep_to_their_own_task_counts(spark):
    toy, cfg = dense.Toy(spark), config()
    toy.nodes_df.persist().count()
    ways = [{"tasks": 3}, {"tasks": 2, **JOINED}, {"parts": 4}]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with ThreadPoolExecutor(len(ways)) as pool:
        layouts_made = list(pool.map(lambda way: lay_out(toy.nodes_df, toy.edges_df, **way), ways))
        spark.conf.set("spark.sql.shuffle.partitions", "7")  # of no account to plans of a layout
        try:
            results = list(pool.map(lambda made: trainer.train_layout(made, cfg), layouts_made))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    for way, made, result in zip(ways, layouts_made, results, strict=True):
        parts = way.get("parts")
        whole = dense.whole(toy.n, toy.edges)
        a = dense.normalized(whole) if parts is None else dense.blocks(toy.n, toy.edges, parts, "normalized")
        check(result, a, toy, toy.row_weight(parts) if parts else toy.row_weight(), cfg)
        assert made.vertices.rdd.getNumPartitions() == made.tasks == way.get("tasks", parts)
        scored = trainer.predict_layout(made, result.weights)
        assert scored.sparkSession is spark and scored.count() == toy.n
        made.release()
    # neither the caller's cache nor its catalog is touched
    assert toy.nodes_df.storageLevel.useMemory
    assert not spark.catalog.listTables("global_temp")
    toy.nodes_df.unpersist()


def test_a_first_layer_pass_in_parts_trains_the_same(spark, monkeypatch):
    toy, cfg = dense.Toy(spark), config()
    monkeypatch.setattr(layouts, "LEAST_COLUMNS", 1)
    layout = lay_out(toy.nodes_df, toy.edges_df, tasks=1, sum_bytes=8 * toy.n * 3)
    assert layout.columns == 3 < toy.x.shape[1]
    result = trainer.train_layout(layout, cfg)
    layout.release()
    a = dense.normalized(dense.whole(toy.n, toy.edges))
    check(result, a, toy, toy.row_weight(), cfg)


def test_columns_follow_the_memory_of_a_task():
    assert sum_columns(10**6, 1000, 8) > 602
    assert sum_columns(10**12, 10**9, 62_500) == 0
    assert sum_columns(115 * 10**6, 232_965, 9) == (256 << 20) // (8 * 232_965)


def test_task_count_follows_the_graph():
    assert task_count(0, 0, 5, 8) == 1
    assert task_count(300_000, 2_000, 64, 8) == 8
    assert task_count(30_000, 500, 64, 8) == 2
    assert task_count(10**12, 10**9, 602, 8_000) == 62_500
    assert task_count(10**9, 10**9, 602, 8) == -(-602 * 8 * 10**9 // (128 << 20))


def test_karate_club_is_learnt(spark):
    graph = load_karate(spark)
    assert (graph.nodes.count(), graph.raw_edges.count()) == (34, 78)
    assert {r["label"]: r["count"] for r in graph.nodes.groupBy("label").count().collect()} == {
        0: 17, 1: 17,
    }
    layout = lay_out(graph.nodes, graph.raw_edges)
    cfg = trainer.TrainConfig(hidden_dim=8, epochs=12, learning_rate=0.5, seed=42)
    result = trainer.train_layout(layout, cfg)
    losses = [m["loss"] for m in result.metrics]
    assert losses == sorted(losses, reverse=True)
    scored = trainer.predict_layout(layout, result.weights)
    right = scored.agg(F.avg((F.col("pred") == F.col("label")).cast("double"))).first()[0]
    layout.release()
    assert right > 0.6


def test_parts_by_operators_agree_with_training(spark):
    toy, parts = dense.Toy(spark), 10
    weights = D.wave_weights([5, 4, 3])
    edges = B.normalize_edges(toy.edges_df, toy.nodes_df)
    blocks = L.local_edges(edges, toy.nodes_df, parts)
    run = L.local_forward(blocks, toy.nodes_df, weights)
    a = dense.blocks(toy.n, toy.edges, parts, "normalized")
    _, want = dense.gradients(a, toy.x, toy.labels, toy.row_weight(parts), weights)
    each = L.local_grads(blocks, run, toy.nodes_df, weights, parts).persist()
    for mean in (L.average_gradients(each, parts), L.tree_average(each, parts, 3)):
        got = [np.zeros(w.shape) for w in weights]
        for r in mean.collect():
            got[r["layer"]][r["i"], r["j"]] = r["v"]
        assert all(np.allclose(g, w) for g, w in zip(got, want, strict=True))
    losses = L.loss_per_part(run.logits, toy.nodes_df, parts)
    logits = dense.forward(a, toy.x, weights)[0]
    assert {r["pid"]: r["loss"] for r in losses.collect() if r["n_train"] == 0} == {
        6: 0.0, 7: 0.0, 8: 0.0, 9: 0.0,
    }
    assert L.weighted_loss(losses).first()[0] == pytest.approx(
        dense.loss(logits, toy.labels, toy.masks[0])
    )


def test_experiment_grid(spark):
    toy = dense.Toy(spark)
    cfg = trainer.TrainConfig(hidden_dim=3, epochs=2)
    grid = experiments.experiment_grid(toy.nodes_df, toy.edges_df, cfg, (2,), (42, 123))
    rows = grid.orderBy("config", "run", "epoch").collect()
    assert [(r["config"], r["run"], r["seed"], r["epoch"]) for r in rows] == [
        (c, run, seed, e)
        for c in ("sequential", "spark_2")
        for run, seed in ((1, 42), (2, 123))
        for e in (1, 2)
    ]
    assert all(r["epoch_time"] > 0 for r in rows)
    assert all(r["comm_time"] == 0 for r in rows if r["config"] == "sequential")


def test_a_failed_parallel_run_is_an_error_or_marked(spark, monkeypatch):
    toy = dense.Toy(spark)
    real = experiments.train_layout

    def failing(layout, cfg):
        if layout.parts and cfg.seed == 42:
            raise RuntimeError("lost")
        return real(layout, cfg)

    monkeypatch.setattr(experiments, "train_layout", failing)
    cfg = trainer.TrainConfig(hidden_dim=3, epochs=1)
    with pytest.raises(RuntimeError, match="lost"):
        experiments.experiment_grid(toy.nodes_df, toy.edges_df, cfg, (2,), (42, 123))
    grid = experiments.experiment_grid(toy.nodes_df, toy.edges_df, cfg, (2,), (42, 123), mark_failed=True)
    assert sorted((r["config"], r["seed"], r["epoch"]) for r in grid.collect()) == [
        ("sequential", 42, 1), ("sequential", 123, 1), ("spark_2", 42, 0), ("spark_2", 123, 1),
    ]


def test_a_grid_merges_its_edges_once(spark, monkeypatch):
    toy, cfg, merges = dense.Toy(spark), config(epochs=1), []
    real = experiments.undirected
    for module in (experiments, layouts):
        monkeypatch.setattr(module, "undirected", lambda *a: merges.append(1) or real(*a))
    grid = experiments.experiment_grid(toy.nodes_df, toy.edges_df, cfg, (2, 4), (42,)).collect()
    assert len(merges) == 1
    for row in grid:
        alone = train(toy.nodes_df, toy.edges_df, cfg,
                      parts=None if row["config"] == "sequential" else int(row["config"].split("_")[1]))
        assert row["loss"] == pytest.approx(alone.metrics[0]["loss"])
