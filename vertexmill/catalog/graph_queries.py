"""Queries for sources, preparation and partitioning."""

from __future__ import annotations

from pyspark.sql import functions as F

from vertexmill.catalog import fixtures as X
from vertexmill.catalog.oracle import block_tables
from vertexmill.catalog.oracle import r6 as r
from vertexmill.catalog.registry import long_rows, query, r6, rounded
from vertexmill.operators import partition as C
from vertexmill.operators import prepare as B
from vertexmill.runtime import scratch_path, with_position
from vertexmill.sources import edges as E
from vertexmill.sources import nodes as N
from vertexmill.sources.datasets import load_graph as load_by_name

EDGE_SQL = f"SELECT src, dst, {r('w')} AS w FROM "
LONG_SQL = f"SELECT id, k, {r('v')} AS v FROM "
MASKS_SQL = "node_type = 1 AS is_train, node_type = 2 AS is_val, node_type = 3 AS is_test"

# ---------------------------------------------------------------- sources


@query("SELECT src, dst, w FROM raw")
def edges_coo(spark, folder):
    n = X.node_count(spark, folder)
    table = X.table(spark, folder, "orders").select(
        (F.col("o_custkey") % n).alias("row"), (F.col("o_orderkey") % n).alias("col")
    )
    return E.edges_coo(table)


@query(EDGE_SQL + "edges")
def edges_from_csr(spark, folder):
    return rounded(E.edges_from_csr_vectors(*X.csr_vectors(spark, folder)))


@query("SELECT src, dst, w FROM edges")
def edges_from_neighbor_lists(spark, folder):
    return E.edges_from_neighbor_lists(X.neighbor_lists(spark, folder))


@query(f"""SELECT x.id, x.k, {r('x.v')} AS v, n.label, {MASKS_SQL}
    FROM x JOIN nodes n ON x.id = n.id""")
def nodes_load(spark, folder):
    loaded = N.load_nodes(X.plain_nodes(spark, folder))
    masks = ["label", "is_train", "is_val", "is_test"]
    return loaded.select("id", *masks, F.posexplode("features").alias("k", "v")).select(
        "id", F.col("k").cast("bigint").alias("k"), r6("v").alias("v"), *masks
    )


@query(
    f"""SELECT 'allx' AS block, id AS row_pos, k, {r('v')} AS v FROM x, cnt WHERE id < n * 8 // 10
    UNION ALL SELECT 'x', id, k, {r('v')} FROM x, cnt WHERE id < n * 6 // 10
    UNION ALL SELECT 'tx', id - n * 8 // 10, k, {r('v')} FROM x, cnt WHERE id >= n * 8 // 10
    UNION ALL SELECT 'ally', id, k, v FROM hot, cnt WHERE id < n * 8 // 10
    UNION ALL SELECT 'y', id, k, v FROM hot, cnt WHERE id < n * 6 // 10
    UNION ALL SELECT 'ty', id - n * 8 // 10, k, v FROM hot, cnt WHERE id >= n * 8 // 10""",
    {
        "hot": """SELECT id, g.k::BIGINT AS k, CASE WHEN g.k = label THEN 1.0 ELSE 0.0 END::DOUBLE AS v
        FROM nodes, generate_series(0, 9) AS g(k)"""
    },
)
def planetoid_blocks(spark, folder):
    root = scratch_path(spark, "citation")
    blocks, _ = X.citation(spark, folder)
    for name, block in blocks.items():
        block.write.parquet(f"{root}/{name}")
    read = N.citation_blocks(spark, root)
    whole = None
    for name, block in read.items():
        part = block.select(
            F.lit(name).alias("block"), "row_pos", F.posexplode("vec").alias("k", "v")
        )
        whole = part if whole is None else whole.unionByName(part)
    return whole.select("block", "row_pos", F.col("k").cast("bigint").alias("k"), r6("v").alias("v"))


TESTED = {
    "tested": """SELECT id, row_number() OVER (ORDER BY id * 37 % n) - 1 AS line,
        row_number() OVER (ORDER BY id) - 1 AS place FROM nodes, cnt WHERE id >= n * 8 // 10"""
}


@query("SELECT id, line::BIGINT AS line, place::BIGINT AS place FROM tested", TESTED)
def test_index_read(spark, folder):
    path = scratch_path(spark, "test-index")
    N.write_test_index(X.citation(spark, folder)[1], path)
    listed = N.read_test_index(spark, path)
    return with_position(listed, "id", name="place")


@query(
    """SELECT n.id, CASE WHEN n.label < 5 THEN 0 ELSE 1 END::BIGINT AS label, n.id AS col,
    1.0::DOUBLE AS val, d.degree
    FROM nodes n JOIN (SELECT src, sum(w) AS degree FROM looped GROUP BY src) d ON n.id = d.src"""
)
def small_graph(spark, folder):
    root = scratch_path(spark, "labelled")
    side = F.when(F.col("label") < 5, "left").otherwise("right").alias("category")
    X.nodes(spark, folder).select("id", side).write.option("header", True).csv(f"{root}/nodes.csv")
    listed = X.raw_edges(spark, folder).select(F.col("src").alias("row"), F.col("dst").alias("col"))
    listed.write.option("header", True).csv(f"{root}/edges.csv")
    nodes = N.labelled_graph_nodes(E.read_table(spark, f"{root}/nodes.csv"), "left")
    edges = B.undirected(E.edges_coo(E.read_table(spark, f"{root}/edges.csv")), nodes)
    features = B.identity_triples(nodes)
    return (
        nodes.select("id", "label")
        .join(features, "id")
        .join(B.degree(edges), "id")
        .select("id", "label", "col", "val", "degree")
    )


@query(f"""SELECT 'edge' AS kind, src AS a, dst AS b, {r('w')} AS v FROM norm
    UNION ALL SELECT 'feature', id, k, {r('v')} FROM xs
    UNION ALL SELECT 'label', id, label, node_type::DOUBLE FROM nodes""")
def load_graph(spark, folder):
    root = scratch_path(spark, "graph")
    X.plain_nodes(spark, folder).write.parquet(f"{root}/nodes")
    X.raw_edges(spark, folder).select(
        F.col("src").alias("row"), F.col("dst").alias("col")
    ).write.parquet(f"{root}/coo")
    return graph_rows(load_by_name(spark, "reddit", root))


def graph_rows(graph):
    """A loaded graph as ``(kind, a, b, v)``: edges, features, labels with their split code."""
    code = F.when(F.col("is_train"), 1.0).when(F.col("is_val"), 2.0).when(F.col("is_test"), 3.0)
    edges = graph.edges.select(
        F.lit("edge").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"),
        r6("w").alias("v"),
    )
    features = long_rows(graph.nodes, "features").select(F.lit("feature"), "id", "k", "v")
    labels = graph.nodes.select(F.lit("label"), "id", "label", code)
    return edges.union(features).union(labels)


@query(f"""SELECT 'edge' AS kind, src AS a, dst AS b, {r('w')} AS v FROM edges
    UNION ALL SELECT 'feature', id, k, {r('v')} FROM x
    UNION ALL SELECT 'label', id, label, node_type::DOUBLE FROM nodes""")
def load_graph_plain(spark, folder):
    """Without normalisation: features as read, edges symmetrised and clipped."""
    root = scratch_path(spark, "graph")
    X.plain_nodes(spark, folder).write.parquet(f"{root}/nodes")
    X.raw_edges(spark, folder).select(
        F.col("src").alias("row"), F.col("dst").alias("col")
    ).write.parquet(f"{root}/coo")
    return graph_rows(load_by_name(spark, "reddit", root, normalize=False))


@query(
    f"""SELECT 'edge' AS kind, src AS a, dst AS b, {r('w')} AS v FROM edges
    UNION ALL SELECT 'feature', s.id, x.k, {r('x.v')} FROM came s JOIN x ON x.id = s.came
    UNION ALL SELECT 'label', s.id, n.label,
        CASE WHEN s.id < s.n * 6 // 10 THEN 1.0 WHEN s.id < s.n * 6 // 10 + 500 THEN 2.0 ELSE 3.0 END::DOUBLE
        FROM came s JOIN nodes n ON n.id = s.came""",
    {
        "tested": """SELECT id, row_number() OVER (ORDER BY id * 37 % n) - 1 AS line
            FROM nodes CROSS JOIN cnt WHERE id >= n * 8 // 10""",
        "came": """SELECT n.id, cnt.n, CASE WHEN t.line IS NULL THEN n.id
            ELSE t.line + cnt.n * 8 // 10 END AS came
            FROM nodes n CROSS JOIN cnt LEFT JOIN tested t ON n.id = t.id""",
    },
)
def load_citation(spark, folder):
    """Citation blocks with a plain listing, one id per line in the order of the test rows."""
    root = scratch_path(spark, "citation")
    blocks, index = X.citation(spark, folder)
    for name, block in blocks.items():
        block.write.parquet(f"{root}/{name}")
    one_file = index.repartition(1).sortWithinPartitions("line")
    one_file.select(F.col("id").cast("string")).write.text(f"{root}/test.index")
    X.neighbor_lists(spark, folder).write.parquet(f"{root}/graph")
    return graph_rows(load_by_name(spark, "cora", root, normalize=False))


# ---------------------------------------------------------------- splits and labels


@query(f"SELECT id, {MASKS_SQL} FROM nodes")
def split_masks(spark, folder):
    return X.nodes(spark, folder).select("id", "is_train", "is_val", "is_test")


@query("""SELECT id, id < n * 6 // 10 AS is_train,
    id >= n * 6 // 10 AND id < n * 6 // 10 + 500 AS is_val, id >= n * 8 // 10 AS is_test
    FROM nodes, cnt""")
def split_positional(spark, folder):
    blocks, index = X.citation(spark, folder)
    n_train = blocks["x"].agg(F.count("*")).scalar()
    nodes = X.nodes(spark, folder).select("id")
    return B.split_positional(nodes, n_train, index, N.CITATION_VAL).select(
        "id", "is_train", "is_val", "is_test"
    )


@query("""SELECT n AS nodes, floor(n * 0.6)::BIGINT AS train, floor(n * 0.2)::BIGINT AS val,
    n - floor(n * 0.6)::BIGINT - floor(n * 0.2)::BIGINT AS test FROM cnt""")
def split_random(spark, folder):
    split = B.split_random(X.nodes(spark, folder).select("id"), seed=42)
    return split.agg(
        F.countDistinct("id").alias("nodes"),
        F.count_if("is_train").alias("train"),
        F.count_if("is_val").alias("val"),
        F.count_if("is_test").alias("test"),
    )


@query("SELECT id, label FROM nodes")
def onehot_argmax(spark, folder):
    blocks, _ = X.citation(spark, folder)
    whole = B.stack_blocks(blocks["ally"], blocks["ty"])
    return whole.select("id", B.onehot_argmax(F.col("vec")).alias("label"))


@query(LONG_SQL + "x")
def stack_blocks(spark, folder):
    blocks, _ = X.citation(spark, folder)
    return long_rows(B.stack_blocks(blocks["allx"], blocks["tx"]))


#: Whole vectors are swapped before they are unfolded; no common table is read twice.
ALIGN_SQL = """SELECT id, k, round(v::DOUBLE, 6) + 0.0 AS v FROM (
    SELECT id, unnest(range(64))::BIGINT AS k, unnest(vec) AS v FROM (
        SELECT own.vec_id AS id, coalesce(other.embedding, own.embedding) AS vec
        FROM embeddings own
        LEFT JOIN (
            SELECT vec_id, row_number() OVER (ORDER BY vec_id * 37 % (SELECT count(*) FROM embeddings)) - 1
                + (SELECT count(*) FROM embeddings) * 8 // 10 AS came
            FROM embeddings WHERE vec_id >= (SELECT count(*) FROM embeddings) * 8 // 10) place
            ON place.vec_id = own.vec_id
        LEFT JOIN embeddings other ON other.vec_id = place.came))"""


@query(ALIGN_SQL)
def align_test_rows(spark, folder):
    blocks, index = X.citation(spark, folder)
    stacked = B.stack_blocks(blocks["allx"], blocks["tx"])
    return long_rows(B.align_test_rows(stacked, blocks["tx"], index, order="file"))


@query(
    f"""SELECT r.id, r.id - b.low AS row_pos, CASE WHEN r.id % 7 = 0 THEN 0 ELSE n.label END AS label,
    x.k, CASE WHEN r.id % 7 = 0 THEN 0.0 ELSE {r('x.v')} END AS v
    FROM (SELECT unnest(generate_series(low, high)) AS id FROM listed) r, listed b, nodes n, x
    WHERE n.id = r.id AND x.id = r.id""",
    {
        "listed": """SELECT min(id) AS low, max(id) AS high FROM nodes, cnt
        WHERE id >= n * 8 // 10 AND id % 7 <> 0"""
    },
)
def gap_fill(spark, folder):
    blocks, _ = X.citation(spark, folder)
    first = blocks["allx"].agg(F.count("*")).scalar()
    rows = N.join_block(blocks, "tx", "ty").withColumn("id", F.col("row_pos") + first)
    listed = rows.filter("id % 7 <> 0").drop("row_pos")
    filled = B.gap_fill(listed, 64, 10).withColumn("label", B.onehot_argmax(F.col("onehot")))
    return filled.select("id", "row_pos", "label", F.posexplode("features").alias("k", "v")).select(
        "id", "row_pos", "label", F.col("k").cast("bigint").alias("k"), r6("v").alias("v")
    )


@query(LONG_SQL + "(SELECT id, k, CASE WHEN v > 0 THEN v ELSE 0.0 END AS v FROM x)")
def densify(spark, folder):
    triples = (
        X.nodes(spark, folder)
        .select("id", F.posexplode("features").alias("col", "val"))
        .filter("val > 0")
    )
    return long_rows(B.densify(triples, 64))


@query("""SELECT CASE WHEN label < 5 THEN 0 ELSE 1 END::BIGINT AS label, id FROM nodes""")
def category_label(spark, folder):
    side = F.when(F.col("label") < 5, "left").otherwise("right")
    rows = X.nodes(spark, folder).select("id", side.alias("side"))
    return rows.select("id", B.category_label(F.col("side"), "left").alias("label"))


@query("SELECT id, id AS col, 1.0::DOUBLE AS val FROM nodes")
def identity_features(spark, folder):
    return B.identity_triples(X.nodes(spark, folder))


@query(LONG_SQL + "xs")
def standardize(spark, folder):
    return long_rows(B.standardize(X.nodes(spark, folder)), "features")


# ---------------------------------------------------------------- edges


@query("""SELECT src, dst, 1.0::DOUBLE AS w
    FROM (SELECT o_custkey AS src, o_orderkey % cnt.n AS dst FROM orders, cnt) e, cnt
    WHERE e.src < cnt.n""")
def edges_in_range(spark, folder):
    n = X.node_count(spark, folder)
    listed = X.table(spark, folder, "orders").select(
        F.col("o_custkey").alias("row"), (F.col("o_orderkey") % n).alias("col")
    )
    return B.edges_in_range(E.edges_coo(listed), X.nodes(spark, folder))


@query(EDGE_SQL + "dedup")
def dedup_edges(spark, folder):
    return rounded(B.dedup_edges(X.raw_edges(spark, folder)))


@query(EDGE_SQL + "sym")
def symmetrize(spark, folder):
    return rounded(B.symmetrize(X.raw_edges(spark, folder)))


@query(EDGE_SQL + "edges")
def clip_edges(spark, folder):
    return rounded(X.edges(spark, folder))


@query(EDGE_SQL + "looped")
def add_self_loops(spark, folder):
    return rounded(B.add_self_loops(X.edges(spark, folder), X.nodes(spark, folder)))


@query(EDGE_SQL + "looped")
def undirected_edges(spark, folder):
    return rounded(B.undirected(X.raw_edges(spark, folder), X.nodes(spark, folder)))


@query(f"SELECT id, {r('degree')} AS degree FROM deg")
def degree(spark, folder):
    looped = B.undirected(X.raw_edges(spark, folder), X.nodes(spark, folder))
    return rounded(B.degree(looped))


@query(EDGE_SQL + "norm")
def sym_normalize(spark, folder):
    return rounded(B.normalize_edges(X.raw_edges(spark, folder), X.nodes(spark, folder)))


@query("""SELECT 'embeddings' AS name, (SELECT count(*) FROM nodes) AS num_nodes,
    (SELECT count(*) FROM norm) AS num_edges, (SELECT max(len(embedding)) FROM embeddings) AS input_dim,
    (SELECT count(DISTINCT label) FROM nodes) AS num_classes,
    (SELECT count(*) FROM nodes WHERE node_type = 1) AS train,
    (SELECT count(*) FROM nodes WHERE node_type = 2) AS val,
    (SELECT count(*) FROM nodes WHERE node_type = 3) AS test""")
def dataset_stats(spark, folder):
    nodes = X.nodes(spark, folder)
    looped = B.undirected(X.raw_edges(spark, folder), nodes)
    return B.dataset_stats("embeddings", nodes, looped)


# ---------------------------------------------------------------- partitioning

PARTS = X.PARTS


@query(f"SELECT id, (id % {PARTS})::INTEGER AS pid FROM nodes")
def partition_assign(spark, folder):
    return C.assign_parts(X.nodes(spark, folder).select("id"), PARTS)


@query(f"""SELECT (n.id % {PARTS})::INTEGER AS pid, n.id, n.label, {MASKS_SQL}, x.k, {r('x.v')} AS v
    FROM nodes n JOIN x ON n.id = x.id""")
def partition_nodes(spark, folder):
    placed = C.distribute(X.nodes(spark, folder), PARTS)
    kept = ["pid", "id", "label", "is_train", "is_val", "is_test"]
    return placed.select(*kept, F.posexplode("features").alias("k", "v")).select(
        *kept, F.col("k").cast("bigint").alias("k"), r6("v").alias("v")
    )


LOCAL = {
    "numbered": f"""SELECT id, (id % {PARTS})::INTEGER AS pid,
        row_number() OVER (PARTITION BY id % {PARTS} ORDER BY id) - 1 AS local_id FROM nodes"""
}


@query("SELECT id, pid, local_id FROM numbered", LOCAL)
def local_ids(spark, folder):
    return C.local_ids(X.nodes(spark, folder), PARTS)


@query(
    f"""SELECT a.pid, a.local_id AS local_src, b.local_id AS local_dst, {r('e.w')} AS w
    FROM edges e JOIN numbered a ON e.src = a.id JOIN numbered b ON e.dst = b.id
    WHERE a.pid = b.pid""",
    LOCAL,
)
def intra_edges(spark, folder):
    return rounded(C.intra_edges(X.edges(spark, folder), X.nodes(spark, folder), PARTS))


@query(f"""SELECT (src % {PARTS})::INTEGER AS src_pid, (dst % {PARTS})::INTEGER AS dst_pid,
    count(*) AS n_edges FROM edges WHERE src % {PARTS} <> dst % {PARTS} GROUP BY ALL""")
def boundary_edges(spark, folder):
    return C.boundary_edges(X.edges(spark, folder), PARTS)


@query(
    f"SELECT (src % {PARTS})::INTEGER AS pid, src, dst, {r('w')} AS w FROM loc{PARTS}",
    block_tables(PARTS),
)
def local_normalize(spark, folder):
    whole = X.norm_edges(spark, folder).table
    return rounded(C.local_normalize(whole, X.nodes(spark, folder), PARTS))


@query(f"""SELECT g.p::INTEGER AS pid, count(n.id) AS size
    FROM generate_series(0, {PARTS - 1}) AS g(p) LEFT JOIN nodes n ON n.id % {PARTS} = g.p GROUP BY g.p""")
def partition_sizes(spark, folder):
    return C.partition_sizes(X.nodes(spark, folder), PARTS)


@query(f"""SELECT {r('(SELECT max(size) / avg(size) FROM parts)')} AS balance_ratio,
    {r(f'count(*) FILTER (WHERE src % {PARTS} <> dst % {PARTS}) * 100.0 / count(*)')} AS edge_cut_percentage,
    (SELECT string_agg(size, ',' ORDER BY pid) FROM parts) AS partition_sizes,
    count(*) AS total_edges,
    count(*) FILTER (WHERE src % {PARTS} <> dst % {PARTS}) AS cross_partition_edges,
    count(*) FILTER (WHERE src % {PARTS} = dst % {PARTS}) AS intra_partition_edges
    FROM looped""",
    {"parts": f"SELECT id % {PARTS} AS pid, count(*) AS size FROM nodes GROUP BY id % {PARTS}"},
)
def partition_quality(spark, folder):
    nodes = X.nodes(spark, folder)
    looped = B.undirected(X.raw_edges(spark, folder), nodes)
    found = C.partition_quality(nodes, looped, PARTS)
    return rounded(found).withColumn(
        "partition_sizes", F.array_join(F.col("partition_sizes").cast("array<string>"), ",")
    )
