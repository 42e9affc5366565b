import dense
import numpy as np
import pytest
from pyspark.sql import functions as F

from vertexmill.operators import compressed as C
from vertexmill.operators import messages as M
from vertexmill.operators import prepare as B


def vectors(spark, x):
    rows = [(i, row.tolist()) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "id bigint, vec array<double>")


@pytest.mark.parametrize("width", [1, 5, 64, 65, 130])
def test_any_width_equals_the_matrix_product(spark, width):
    toy = dense.Toy(spark)
    x = np.random.default_rng(0).normal(size=(toy.n, width))
    a = np.zeros((toy.n, toy.n))
    for u, v, w in toy.edges:
        a[v, u] += w
    summed = M.message_pass(toy.edges_df, vectors(spark, x), width)
    got = dense.matrix(M.fill_isolated(summed, toy.nodes_df, width), toy.n, width)
    assert np.allclose(got, a @ x)


def test_isolated_and_fully_connected(spark):
    edges = spark.createDataFrame(
        [(0, 2, 5.0), (1, 2, 5.0), (2, 0, 5.0), (0, 1, 5.0)], "src bigint, dst bigint, w double"
    )
    x = np.array([[1.0], [10.0], [100.0], [1000.0]])
    summed = M.neighbor_sum(edges, vectors(spark, x), 1)
    filled = M.fill_isolated(summed, spark.range(4), 1)
    assert dense.matrix(filled, 4, 1).ravel().tolist() == [100.0, 1.0, 11.0, 0.0]


def star(spark, leaves):
    """A hub that sends to all leaves, and a chain among them."""
    out = spark.range(1, leaves + 1).select(F.lit(0).cast("bigint").alias("src"), F.col("id").alias("dst"))
    chain = spark.range(1, leaves).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    return out.unionByName(chain).withColumn("w", F.lit(1.0))


def test_a_hub_is_split_and_the_sums_stay_whole(spark):
    leaves, limit = 1000, 100
    edges = star(spark, leaves)
    counted = M.with_copies(M.edges_per_source(edges), limit)
    hubs = M.find_hubs(counted)
    assert [tuple(r) for r in hubs.collect()] == [(0, 10, 0)]
    salted = M.salt_edges(edges, hubs)
    heaviest = salted.groupBy("key").count().agg(F.max("count")).first()[0]
    assert heaviest < 2 * limit
    x = spark.range(leaves + 1).select(
        "id", F.array(F.col("id").cast("double"), F.lit(1.0)).alias("vec")
    )
    plain = M.message_pass(edges, x, 2)
    split = M.message_pass(M.SpreadEdges(salted, hubs), x, 2)
    want = {r["id"]: r["vec"] for r in plain.collect()}
    assert {r["id"]: r["vec"] for r in split.collect()} == want
    assert want[5] == [4.0, 2.0]


def test_hub_table_cannot_grow_past_its_share():
    assert M.hub_limit(100) == M.HUB_FLOOR
    for n in (10**6, 10**9, 10**12 + 1):
        assert n / M.hub_limit(n) <= M.HUB_SHARE


@pytest.fixture
def eager_skew_handling(spark):
    """Adaptive skew handling at sizes a test can afford."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_plain_edges_leave_a_hub_to_adaptive_skew_handling(spark, eager_skew_handling):
    leaves = 40_000
    edges = star(spark, leaves).repartition(8)
    ids = spark.range(leaves + 1).select("id", F.array(F.lit(1.0)).alias("vec"))
    assert "skew=true" in final_plan(M.message_pass(edges, ids, 1))


def test_hub_rows_bypass_the_join_key(spark):
    edges = star(spark, 1000)
    values = spark.range(1001).select("id", (F.col("id") * 2).alias("value"))
    hubs = values.filter("id = 0")
    got = M.attach(M.attach(edges, "src", values, hubs, "a"), "dst", values, hubs, "b")
    assert got.count() == edges.count()
    assert got.filter("a <> 2 * src or b <> 2 * dst or a is null or b is null").count() == 0


def test_spread_edges_give_the_same_sums_and_normalised_weights(spark, monkeypatch):
    edges = star(spark, 500)
    ids = spark.range(501).select("id", F.array(F.col("id").cast("double")).alias("vec"))
    split = M.spread(edges, floor=20)
    assert split.hubs.collect() == [(0, 25, 0)]
    want = {r["id"]: r["vec"] for r in M.message_pass(edges, ids, 1).collect()}
    assert {r["id"]: r["vec"] for r in M.message_pass(split, ids, 1).collect()} == want
    both = B.undirected(edges, spark.range(501))
    plain = {(r["src"], r["dst"]): r["w"] for r in B.sym_normalize(both).collect()}
    monkeypatch.setattr(B, "hub_limit", lambda n: 20)
    bypassed = {(r["src"], r["dst"]): r["w"] for r in B.sym_normalize(both).collect()}
    assert bypassed == pytest.approx(plain)


def test_copies_of_several_hubs_have_keys_of_their_own(spark):
    counted = spark.createDataFrame([(3, 2), (5, 1), (8, 4), (9, 3)], "id bigint, copies int")
    hubs = M.find_hubs(counted)
    vectors = counted.select("id", F.array(F.lit(1.0)).alias("vec"))
    keyed = M.spread_vectors(M.SpreadEdges(counted, hubs).copies(vectors))
    keys = sorted(r["key"] for r in keyed.collect())
    assert keys == [-9, -8, -7, -6, -5, -4, -3, -2, -1, 5]


def test_compressed_rows_sum_like_a_dense_product(spark, monkeypatch):
    random = np.random.default_rng(3)
    n, width = 40, 70
    edges = [(int(a), int(b), float(w)) for a, b, w in zip(random.integers(0, n, 900), random.integers(0, 6, 900), random.integers(1, 4, 900))]
    edges += [(int(a), int(b), 1.0) for a, b in zip(random.integers(0, n, 60), random.integers(6, n, 60))]
    x = random.normal(size=(n, width))
    a = np.zeros((n, n))
    for u, v, w in edges:
        a[v, u] += w
    monkeypatch.setattr(C, "BLOCK_EDGES", 100)
    slots = C.slot_values(spark, 3)
    assert len({spark.sql(f"SELECT pmod(hash({v}L), 3) AS p").first()["p"] for v in slots}) == 3
    slot = C.slot_of(F.pmod(F.hash("key"), F.lit(3)), slots)
    keyed = spark.createDataFrame(edges, "key bigint, dst bigint, w double").withColumn("slot", slot)
    blocks = C.compressed(keyed.repartition(3, "slot").sortWithinPartitions("slot", "dst"))
    placed = vectors(spark, x).withColumnRenamed("id", "key").withColumn("slot", slot)
    for columns in (width, 33):
        got = {r["id"]: r["vec"] for r in C.compressed_pass(blocks, placed, width, columns).collect()}
        assert got.keys() == {v for _, v, _ in edges}
        for v, vec in got.items():
            assert np.allclose(vec, a[v] @ x)
    narrow = placed.withColumn("vec", F.slice("vec", 1, 5))
    got = {r["id"]: r["vec"] for r in C.compressed_pass(blocks, narrow, 5, 64).collect()}
    assert all(np.allclose(vec, a[v] @ x[:, :5]) for v, vec in got.items())
