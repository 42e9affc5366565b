import dense
import numpy as np
import pytest

from vertexmill.operators import partition as C
from vertexmill.operators import prepare as B


@pytest.mark.parametrize("parts", [1, 3, 4, 50])
def test_parts_cover_all_nodes_once(spark, parts):
    toy = dense.Toy(spark)
    rows = C.local_ids(toy.nodes_df, parts).collect()
    assert sorted(r["id"] for r in rows) == list(range(toy.n))
    for p in range(parts):
        own = sorted((r["id"], r["local_id"]) for r in rows if r["pid"] == p)
        assert [i for i, _ in own] == [i for i in range(toy.n) if i % parts == p]
        assert [k for _, k in own] == list(range(len(own)))
    sizes = {r["pid"]: r["size"] for r in C.partition_sizes(toy.nodes_df, parts).collect()}
    assert sizes == {p: len([i for i in range(toy.n) if i % parts == p]) for p in range(parts)}


@pytest.mark.parametrize("parts", [1, 4, 50])
def test_inside_and_cross_edges_add_up(spark, parts):
    toy = dense.Toy(spark)
    looped = B.undirected(toy.edges_df, toy.nodes_df)
    q = C.partition_quality(toy.nodes_df, looped, parts).first()
    inside = C.intra_edges(looped, toy.nodes_df, parts).count()
    crossing = sum(r["n_edges"] for r in C.boundary_edges(looped, parts).collect())
    assert (inside, crossing) == (q["intra_partition_edges"], q["cross_partition_edges"])
    assert inside + crossing == q["total_edges"] == looped.count()
    sizes = [len(range(p, toy.n, parts)) for p in range(parts)]
    assert q["partition_sizes"] == sizes
    assert q["balance_ratio"] == pytest.approx(max(sizes) / np.mean(sizes))
    assert q["edge_cut_percentage"] == pytest.approx(100 * crossing / (inside + crossing))


def test_no_nodes_and_no_edges(spark):
    toy = dense.Toy(spark)
    q = C.partition_quality(toy.nodes_df.limit(0), toy.edges_df.limit(0), 2).first()
    assert q["balance_ratio"] == float("inf")
    assert q["edge_cut_percentage"] == 0.0


@pytest.mark.parametrize("parts", [1, 4, 10])
@pytest.mark.parametrize("local_input", ["normalized", "raw"])
def test_local_normalisation(spark, parts, local_input):
    toy = dense.Toy(spark)
    if local_input == "normalized":
        given = B.normalize_edges(toy.edges_df, toy.nodes_df)
    else:
        given = B.clip_edges(B.symmetrize(toy.edges_df))
    got = dense.edge_matrix(C.local_normalize(given, toy.nodes_df, parts), toy.n)
    assert np.allclose(got, dense.blocks(toy.n, toy.edges, parts, local_input))


def test_one_raw_part_is_the_whole_graph(spark):
    toy = dense.Toy(spark)
    raw = B.clip_edges(B.symmetrize(toy.edges_df))
    one = dense.edge_matrix(C.local_normalize(raw, toy.nodes_df, 1), toy.n)
    whole = dense.edge_matrix(B.normalize_edges(toy.edges_df, toy.nodes_df), toy.n)
    doubled = dense.blocks(toy.n, toy.edges, 1, "normalized")
    assert np.allclose(one, whole)
    assert not np.allclose(doubled, whole)


@pytest.mark.parametrize("ids, dense_ids", [
    (range(70_000), 70_000), ([0, 2, 3], None), ([0, 1, 1, 3], None), ([], 0), ([1, 2], None), ([0], 1),
])
def test_dense_ids_are_told_by_bitmaps(spark, ids, dense_ids):
    nodes = spark.createDataFrame([(i,) for i in ids], "id bigint").repartition(3)
    assert C.dense_count(nodes) == dense_ids


def test_hubs_among_ids_with_gaps(spark):
    random = np.random.default_rng(8)
    ids = sorted({int(i) for i in random.integers(0, 500, 60)} | {3, 4})
    nodes = spark.createDataFrame([(i,) for i in ids], "id bigint")
    edges = [(int(a), int(b), 1.0) for a, b in random.choice(ids, (300, 2))]
    edges += [(3, int(b), 2.0) for b in random.choice(ids, 200)] + [(3, 501, 1.0), (502, 4, 1.0)]
    table = spark.createDataFrame(edges, "src bigint, dst bigint, w double")
    parts = 3
    local = {i: k for p in range(parts) for k, i in enumerate(sorted(i for i in ids if i % parts == p))}
    want = sorted((a % parts, local[a], local[b], w) for a, b, w in edges if a % parts == b % parts and a in local and b in local)
    for floor in (5, 10_000):
        got = C.intra_edges(table, nodes, parts, hub_floor=floor)
        assert sorted(map(tuple, got.collect())) == want
