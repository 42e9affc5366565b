import dense
import numpy as np
import pytest
from pyspark.sql import functions as F

from vertexmill.operators import prepare as B


def edges(spark, *rows):
    return spark.createDataFrame(list(rows), "src bigint, dst bigint, w double")


def nodes(spark, n):
    return spark.range(n)


def as_dict(df):
    return {(r["src"], r["dst"]): pytest.approx(r["w"]) for r in df.collect()}


def test_path_graph_by_hand(spark):
    path = edges(spark, (0, 1, 1.0), (1, 2, 1.0), (2, 3, 1.0))
    got = as_dict(B.normalize_edges(path, nodes(spark, 4)))
    # degrees with loops are 2, 3, 3, 2
    assert got == {
        (0, 0): 1 / 2, (1, 1): 1 / 3, (2, 2): 1 / 3, (3, 3): 1 / 2,
        (0, 1): 1 / 6**0.5, (1, 0): 1 / 6**0.5, (1, 2): 1 / 3, (2, 1): 1 / 3,
        (2, 3): 1 / 6**0.5, (3, 2): 1 / 6**0.5,
    }


def test_repeats_add_up_before_the_clip(spark):
    twice = edges(spark, (0, 1, 0.3), (0, 1, 0.4), (2, 3, 0.7), (3, 2, 0.7))
    got = as_dict(B.clip_edges(B.symmetrize(twice)))
    assert got == {(0, 1): 0.7, (1, 0): 0.7, (2, 3): 1.0, (3, 2): 1.0}


def test_loops_count_twice_and_zero_weights_vanish(spark):
    some = edges(spark, (0, 0, 0.25), (1, 2, 1.0), (2, 1, -1.0))
    assert as_dict(B.symmetrize(some)) == {(0, 0): 0.5}


def test_undirected_equals_its_steps(spark):
    toy = dense.Toy(spark)
    steps = B.add_self_loops(B.clip_edges(B.symmetrize(toy.edges_df)), toy.nodes_df)
    fused = B.undirected(toy.edges_df, toy.nodes_df)
    want = dense.whole(toy.n, toy.edges) + np.eye(toy.n)
    assert np.allclose(dense.edge_matrix(steps, toy.n), want)
    assert np.allclose(dense.edge_matrix(fused, toy.n), want)
    assert want[1, 1] == 2


def test_normalised_table_is_symmetric_and_keeps_the_degree_identity(spark):
    toy = dense.Toy(spark)
    looped = B.undirected(toy.edges_df, toy.nodes_df)
    a = dense.edge_matrix(B.sym_normalize(looped), toy.n)
    d = dense.edge_matrix(looped, toy.n).sum(axis=1)
    assert np.allclose(a, a.T)
    assert np.allclose(a @ np.sqrt(d), np.sqrt(d))


def test_isolated_vertex_keeps_only_its_loop(spark):
    got = as_dict(B.normalize_edges(edges(spark, (0, 1, 1.0)), nodes(spark, 3)))
    assert got[(2, 2)] == 1.0


def test_constant_feature_only_loses_its_mean(spark):
    rows = [(0, [1.0, 5.0]), (1, [3.0, 5.0])]
    table = spark.createDataFrame(rows, "id bigint, features array<double>")
    got = {r["id"]: r["features"] for r in B.standardize(table).collect()}
    assert got == {0: [-1.0, 0.0], 1: [1.0, 0.0]}


def test_random_split_has_exact_sizes_and_follows_its_seed(spark):
    split = B.split_random(nodes(spark, 34), seed=7)
    rows = {r["id"]: (r["is_train"], r["is_val"], r["is_test"]) for r in split.collect()}
    assert [sum(r[k] for r in rows.values()) for k in range(3)] == [20, 6, 8]
    assert all(sum(r) == 1 for r in rows.values())
    again = {r["id"]: (r["is_train"], r["is_val"], r["is_test"])
             for r in B.split_random(nodes(spark, 34), seed=7).collect()}
    other = {r["id"]: (r["is_train"], r["is_val"], r["is_test"])
             for r in B.split_random(nodes(spark, 34), seed=8).collect()}
    assert rows == again
    assert rows != other


def test_positional_split_stops_at_the_end_and_may_overlap(spark):
    listed = spark.createDataFrame([(1,), (9,)], "id bigint")
    got = {r["id"]: r for r in B.split_positional(nodes(spark, 10), 3, listed, 500).collect()}
    assert sorted(i for i, r in got.items() if r["is_train"]) == [0, 1, 2]
    assert sorted(i for i, r in got.items() if r["is_val"]) == list(range(3, 10))
    assert sorted(i for i, r in got.items() if r["is_test"]) == [1, 9]


def test_first_maximum_wins(spark):
    rows = spark.createDataFrame([([0.0, 1.0, 1.0],), ([0.0, 0.0],)], "v array<double>")
    got = [r[0] for r in rows.select(B.onehot_argmax(F.col("v"))).collect()]
    assert sorted(got) == [0, 1]


def test_densify_adds_repeats(spark):
    triples = spark.createDataFrame(
        [(1, 2, 0.5), (1, 2, 0.25), (1, 0, 1.0), (4, 1, 3.0)], "id bigint, col bigint, val double"
    )
    got = {r["id"]: r["vec"] for r in B.densify(triples, 3).collect()}
    assert got == {1: [1.0, 0.0, 0.75], 4: [0.0, 3.0, 0.0]}


def test_gap_fill(spark):
    rows = spark.createDataFrame(
        [(5, [1.0], [0.0, 1.0]), (8, [2.0], [0.0, 1.0])],
        "id bigint, features array<double>, onehot array<double>",
    )
    got = {r["id"]: (r["row_pos"], r["features"], r["onehot"])
           for r in B.gap_fill(rows, 1, 2).collect()}
    assert got == {
        5: (0, [1.0], [0.0, 1.0]), 6: (1, [0.0], [0.0, 0.0]),
        7: (2, [0.0], [0.0, 0.0]), 8: (3, [2.0], [0.0, 1.0]),
    }


def test_ranges_longer_than_a_step_are_whole(spark):
    bounds = spark.createDataFrame([(3, 200_000)], "low bigint, high bigint")
    spelled = B.spell_range(bounds, "low", "high", "id")
    row = spelled.agg(F.count("*"), F.countDistinct("id"), F.min("id"), F.max("id")).first()
    assert tuple(row) == (199_998, 199_998, 3, 200_000)


def test_cuts_are_those_of_a_full_sort(spark):
    random = np.random.default_rng(6)
    keys = [int(k) for k in random.integers(-(1 << 62), 1 << 62, 300)] + [7] * 40 + [-(1 << 63), (1 << 63) - 1, -1, 0]
    rows = [(k, i) for i, k in enumerate(keys)]
    keyed = spark.createDataFrame(rows, "key bigint, id bigint").repartition(3)
    ranks = [0, 1, 150, 170, len(rows) - 1, len(rows), 10_000]
    want = sorted(rows)
    assert B.cuts_at(keyed, ranks) == [want[r] if r < len(rows) else None for r in ranks]
    assert B.cuts_at(keyed.limit(0), [0]) == [None]


def test_random_split_is_a_filter(spark):
    split = B.split_random(spark.range(1000).repartition(4), seed=3)
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Join" not in plan
    sums = split.selectExpr("count_if(is_train)", "count_if(is_val)", "count_if(is_test)").first()
    assert tuple(sums) == (600, 200, 200)
    assert split.filter("int(is_train) + int(is_val) + int(is_test) <> 1").count() == 0
    assert B.split_random(spark.range(0)).count() == 0
    whole = B.split_random(spark.range(5), train_share=1.0, val_share=0.0)
    assert whole.filter("is_train").count() == 5
