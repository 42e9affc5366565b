import pytest
from pyspark.sql import functions as F

from vertexmill.sources import edges as E
from vertexmill.sources import nodes as N
from vertexmill.sources.datasets import load_graph


def pairs(df):
    return sorted((r["src"], r["dst"], r["w"]) for r in df.collect())


def test_coordinates_keep_repeats(spark):
    table = spark.createDataFrame([(0, 1), (0, 1)], "row int, col int")
    assert pairs(E.edges_coo(table)) == [(0, 1, 1.0), (0, 1, 1.0)]


def test_compressed_rows_and_vectors_agree(spark):
    # rows: 0 -> (1: 0.5, 2: 1.5), 1 -> nothing, 2 -> (0: 2.0)
    rows = spark.createDataFrame([(0, [1, 2], [0.5, 1.5]), (1, [], []), (2, [0], [2.0])],
                                 "id bigint, indices array<bigint>, data array<double>")
    indptr = spark.createDataFrame([(0, 0), (1, 2), (2, 2), (3, 3)], "pos bigint, value bigint")
    entries = spark.createDataFrame([(0, 1, 0.5), (1, 2, 1.5), (2, 0, 2.0)],
                                    "pos bigint, index bigint, data double")
    want = [(0, 1, 0.5), (0, 2, 1.5), (2, 0, 2.0)]
    assert pairs(E.edges_from_csr_rows(rows)) == want
    assert pairs(E.edges_from_csr_vectors(indptr, entries)) == want
    assert pairs(E.edges_of_layout({"rows": rows})) == want
    assert pairs(E.edges_of_layout({"indptr": indptr, "entries": entries})) == want


def test_a_row_longer_than_a_step_is_whole(spark):
    n = 150_000
    indptr = spark.createDataFrame([(0, 0), (1, n)], "pos bigint, value bigint")
    entries = spark.range(n).select(F.col("id").alias("pos"), F.col("id").alias("index"), F.lit(1.0).alias("data"))
    got = E.edges_from_csr_vectors(indptr, entries)
    assert tuple(got.agg(F.count("*"), F.countDistinct("dst"), F.max("src")).first()) == (n, n, 0)


def test_unknown_layout(spark):
    table = spark.createDataFrame([(0, 1)], "a int, b int")
    with pytest.raises(ValueError):
        E.edges_of_layout({"coo": table})
    with pytest.raises(ValueError):
        E.edges_of_layout({"matrix": table})
    with pytest.raises(ValueError):
        E.edges_of_layout({})


def citation(spark, order_of_ids):
    """Five known rows, three test rows; feature = 10 * row, class = row % 2."""
    def block(first, count):
        rows = [(i, [10.0 * (first + i), 1.0]) for i in range(count)]
        return spark.createDataFrame(rows, "row_pos bigint, vec array<double>")

    def hot(first, count):
        rows = [(i, [float((first + i) % 2 == c) for c in (0, 1)]) for i in range(count)]
        return spark.createDataFrame(rows, "row_pos bigint, vec array<double>")

    blocks = {"x": block(0, 2), "y": hot(0, 2), "allx": block(0, 5), "ally": hot(0, 5),
              "tx": block(5, 3), "ty": hot(5, 3)}
    index = spark.createDataFrame(list(enumerate(order_of_ids)), "line bigint, id bigint")
    return blocks, index


def by_id(nodes):
    return {r["id"]: r for r in nodes.collect()}


def test_test_rows_follow_the_listing(spark):
    blocks, index = citation(spark, [7, 5, 6])
    as_listed = by_id(N.citation_nodes(blocks, index))
    assert {i: r["features"][0] for i, r in as_listed.items()} == {
        0: 0.0, 1: 10.0, 2: 20.0, 3: 30.0, 4: 40.0, 7: 50.0, 5: 60.0, 6: 70.0,
    }
    assert [as_listed[i]["label"] for i in (7, 5, 6)] == [1, 0, 1]
    ascending = by_id(N.citation_nodes(blocks, index, order="sorted"))
    assert [ascending[i]["features"][0] for i in (5, 6, 7)] == [50.0, 60.0, 70.0]
    masks = {i: (r["is_train"], r["is_val"], r["is_test"]) for i, r in as_listed.items()}
    assert masks[0] == (True, False, False)
    # validation takes the rows after training, test ids among them
    assert masks[4] == (False, True, False)
    assert masks[6] == (False, True, True)
    with pytest.raises(ValueError):
        N.citation_nodes(blocks, index, order="random").count()


def test_gaps_in_the_listing(spark):
    blocks, index = citation(spark, [8, 5, 7])
    nodes = by_id(N.citation_nodes(blocks, index, fill_gaps=True, feature_width=2, class_width=2))
    assert sorted(nodes) == list(range(9))
    assert [nodes[i]["features"][0] for i in (8, 5, 7)] == [50.0, 60.0, 70.0]
    assert (nodes[6]["features"], nodes[6]["label"], nodes[6]["is_test"]) == ([0.0, 0.0], 0, False)
    # ascending order reads the block with its gap, by compact position
    shifted = by_id(N.citation_nodes(blocks, index, order="sorted", fill_gaps=True,
                                     feature_width=2, class_width=2))
    assert [shifted[i]["features"][0] for i in (5, 7, 8)] == [50.0, 0.0, 60.0]


def test_plain_listing_keeps_the_order_of_its_lines(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("7\n 5 \n\n6\n")
    rows = N.read_test_index(spark, str(tmp_path / "ids.txt")).collect()
    assert {r["id"]: r["line"] for r in rows} == {7: 0, 5: 1, 6: 2}


def test_long_plain_listing_is_numbered_across_splits(spark, tmp_path):
    ids = [k * 37 % 5003 for k in range(5003)]
    (tmp_path / "ids.txt").write_text("\n".join(map(str, ids)) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        listed = N.read_test_index(spark, str(tmp_path / "ids.txt"))
        got = {r["line"]: r["id"] for r in listed.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [got[k] for k in range(5003)] == ids


def written_citation(spark, root, known, listing):
    """Blocks below ``root`` with ``known`` rows in allx; row r of tx has the feature 100 + r."""
    row = lambda k, v: (k, [float(v), 1.0])
    hot = lambda k: (k, [1.0, 0.0] if k % 2 == 0 else [0.0, 1.0])
    n = len(listing)
    blocks = {
        "x": [row(k, k) for k in range(2)], "y": [hot(k) for k in range(2)],
        "allx": [row(k, k) for k in range(known)], "ally": [hot(k) for k in range(known)],
        "tx": [row(k, 100 + k) for k in range(n)], "ty": [hot(k) for k in range(n)],
    }
    for name, rows in blocks.items():
        spark.createDataFrame(rows, "row_pos bigint, vec array<double>").write.parquet(f"{root}/{name}")
    lists = [(0, [1])]
    spark.createDataFrame(lists, "id bigint, neighbors array<bigint>").write.parquet(f"{root}/graph")
    with open(f"{root}/test.index", "w") as out:
        out.write("".join(f"{k}\n" for k in listing))


def test_plain_listings_place_the_test_rows(spark, tmp_path):
    for name, known, listing in (("citeseer", 6, [9, 6, 7]), ("cora", 6, [8, 6, 7])):
        root = str(tmp_path / name)
        written_citation(spark, root, known, listing)
        nodes = by_id(load_graph(spark, name, root, normalize=False).nodes)
        assert sorted(nodes) == list(range(max(listing) + 1))
        assert [nodes[i]["features"][0] for i in listing] == [100.0, 101.0, 102.0]
        ascending = by_id(load_graph(spark, name, root, normalize=False, order="sorted").nodes)
        assert [ascending[i]["features"][0] for i in (6, 7)] == [100.0, 101.0]


def test_a_listing_without_order_is_refused(spark):
    blocks, index = citation(spark, [7, 5, 6])
    with pytest.raises(ValueError, match="no order"):
        N.citation_nodes(blocks, index.selectExpr("CAST(null AS bigint) AS line", "id"))


def test_load_citation_graph(spark, tmp_path):
    root = str(tmp_path / "cora")
    blocks, index = citation(spark, [7, 5, 6])
    for name, block in blocks.items():
        block.write.parquet(f"{root}/{name}")
    N.write_test_index(index, f"{root}/test.index")
    lists = [(0, [1, 2]), (1, [0]), (7, [0, 99])]
    spark.createDataFrame(lists, "id bigint, neighbors array<bigint>").write.parquet(f"{root}/graph")
    graph = load_graph(spark, "cora", root, normalize=False)
    assert graph.nodes.count() == 8
    assert pairs(graph.edges) == [
        (0, 1, 1.0), (0, 2, 1.0), (0, 7, 1.0), (1, 0, 1.0), (2, 0, 1.0), (7, 0, 1.0),
    ]
    assert load_graph(spark, "cora", root).edges.count() == 6 + 8


def test_load_attributed_graph(spark, tmp_path):
    root = str(tmp_path / "reddit")
    rows = [(0, [1.0], 0, 1), (1, [3.0], 1, 2), (2, [5.0], 1, 3), (3, [7.0], 0, 9)]
    spark.createDataFrame(
        rows, "id int, feature array<float>, label int, node_types int"
    ).write.parquet(f"{root}/nodes")
    with pytest.raises(ValueError):
        load_graph(spark, "reddit", root)
    spark.createDataFrame([(0, 1), (1, 2)], "row int, col int").write.parquet(f"{root}/coo")
    graph = load_graph(spark, "Reddit", root, normalize=False)
    got = {r["id"]: (r["features"], r["is_train"], r["is_val"], r["is_test"]) for r in graph.nodes.collect()}
    assert got[0] == ([1.0], True, False, False)
    assert got[3] == ([7.0], False, False, False)
    assert graph.edges.count() == 4
    with pytest.raises(ValueError):
        load_graph(spark, "unheard-of", root)
    with pytest.raises(ValueError):
        load_graph(spark, "reddit")
