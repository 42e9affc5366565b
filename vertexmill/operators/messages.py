"""Message passing: the weighted sum of neighbour vectors, ``A @ M``.

An edge table is joined to the vectors of its sources and summed per target.
The sum is combined before its shuffle, so a target with a third of all edges
costs one row per task. A *source* with that many edges would put them all in
one join task; :func:`spread` splits such sources over several join keys, and
only their vectors are copied. Adaptive skew handling alone would not do: it
is off wherever a side of the join is already hashed by the key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vertexmill.functions.vectors import PIECE, sum_vectors
from vertexmill.runtime import written

#: A vertex holding more than 1/HUB_SHARE of the edges is split, so at most
#: HUB_SHARE vertices can be hubs and their table is safe to broadcast.
HUB_SHARE = 10_000

#: No vertex with fewer edges than this is worth splitting.
HUB_FLOOR = 10_000


def edges_per_source(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("n_edges"))


def hub_limit(n_edges: int, floor: int = HUB_FLOOR) -> int:
    """Most edges one join key may hold."""
    return max(floor, -(-n_edges // HUB_SHARE))


def with_copies(vertices: DataFrame, limit: int) -> DataFrame:
    """``copies``: number of join keys the edges of a vertex are spread over."""
    return vertices.withColumn(
        "copies", F.greatest(F.lit(1), F.ceil(F.col("n_edges") / F.lit(limit))).cast("int")
    )


def find_hubs(counted: DataFrame) -> DataFrame:
    """``(id, copies, first)`` of the split vertices: fewer than ``HUB_SHARE`` rows by construction.

    ``first`` numbers the copies of all hubs through; the window over so few
    rows is one small task.
    """
    before = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    hubs = counted.filter("copies > 1").select("id", "copies")
    return hubs.withColumn("first", F.coalesce(F.sum("copies").over(before), F.lit(0)))


def _copy_key(salt: Column) -> Column:
    """Join key of one copy of a hub: negative, as vertex ids are not."""
    return -1 - F.col("first") - salt


def salt_edges(edges: DataFrame, hubs: DataFrame) -> DataFrame:
    """Add ``key``: the source itself, or for a hub one of its copies by target.

    One integer key joins faster than a source and a salt would.
    """
    named = F.broadcast(hubs.withColumnRenamed("id", "src"))
    copy = _copy_key(F.pmod(F.xxhash64("dst"), F.col("copies")))
    return edges.join(named, "src", "left").select(
        F.coalesce(copy, F.col("src")).alias("key"), "src", "dst", "w"
    )


@dataclass
class SpreadEdges:
    """Edges ``(key, src, dst, w)`` and the hubs ``(id, copies, first)`` behind their keys."""

    table: DataFrame
    hubs: DataFrame

    def copies(self, vectors: DataFrame) -> DataFrame:
        """Tell every vector which copies its edges ask for."""
        found = vectors.join(F.broadcast(self.hubs), "id", "left")
        return found.withColumn("copies", F.coalesce("copies", F.lit(1)))


def spread(edges: DataFrame, floor: int = HUB_FLOOR) -> SpreadEdges:
    """Split the hubs of an edge table. Counts its sources; give a written table."""
    counts = written(edges_per_source(edges), "counts")
    total = counts.agg(F.coalesce(F.sum("n_edges"), F.lit(0))).first()[0]
    hubs = find_hubs(with_copies(counts, hub_limit(total, floor)))
    return SpreadEdges(salt_edges(edges, hubs), hubs)


def spread_vectors(vectors: DataFrame) -> DataFrame:
    """One row per copy of a vertex; adds at most 2 * ``HUB_SHARE`` rows in all."""
    each = vectors.select(
        "id", "first", "vec", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt")
    )
    key = F.when(F.col("first").isNull(), F.col("id")).otherwise(_copy_key(F.col("salt")))
    return each.select(key.alias("key"), "vec")


#: Largest hash table of one join task, in bytes; beyond it the join sorts and may spill.
HASH_LIMIT = 128 << 20

#: Bytes a vector row takes besides its values.
ROW_OVERHEAD = 64


def join_hint(rows_per_task: float, width: int) -> str:
    """How to join edges to vectors, by the size of one task's share of the vectors."""
    size = rows_per_task * (width * 8 + ROW_OVERHEAD)
    return "shuffle_hash" if size <= HASH_LIMIT else "merge"


def message_pass(
    edges: DataFrame | SpreadEdges, vectors: DataFrame, width: int, hint: str | None = None
) -> DataFrame:
    """``(id, vec)``: for every target the sum of ``w`` times its sources' vectors.

    Give :func:`spread` edges where a vertex may be a hub; a table with ``key``
    goes with ``vectors`` that hold ``copies`` and ``first``. Vectors wider than ``PIECE`` travel
    in pieces. ``hint`` is the join strategy for a known layout, see
    :func:`join_hint`. Targets without edges give no row; see
    :func:`fill_isolated`.
    """
    if isinstance(edges, SpreadEdges):
        edges, vectors = edges.table, edges.copies(vectors)
    on = "key" if "key" in edges.columns else "src"
    sources = (
        spread_vectors(vectors) if on == "key" else vectors.select(F.col("id").alias("src"), "vec")
    )
    if width <= PIECE:
        if hint:
            sources = sources.hint(hint)
        joined = edges.join(sources, on).select(F.col("dst").alias("id"), "w", "vec")
        return sum_vectors(joined, ["id"], width, "w")

    cuts = ", ".join(
        f"named_struct('at', {at}, 'vec', slice(vec, {at + 1}, {PIECE}))"
        for at in range(0, width, PIECE)
    )
    pieces = sources.selectExpr(on, f"inline(array({cuts}))")
    if hint:
        pieces = pieces.hint(hint)
    joined = edges.join(pieces, on).select(F.col("dst").alias("id"), "at", "w", "vec")
    summed = sum_vectors(joined, ["id", "at"], PIECE, "w")
    return join_pieces(summed)


def join_pieces(pieces: DataFrame) -> DataFrame:
    """Put the pieces of every vector back in order; a vector has width / PIECE of them."""
    ordered = F.array_sort(F.collect_list(F.struct("at", "vec")))
    whole = pieces.groupBy("id").agg(ordered.alias("parts"))
    return whole.select("id", F.flatten(F.transform("parts", lambda p: p["vec"])).alias("vec"))


def fill_isolated(summed: DataFrame, vertices: DataFrame, width: int) -> DataFrame:
    """Zero vectors for the vertices of ``vertices`` that received no message."""
    zeros = F.array_repeat(F.lit(0.0), width)
    return (
        vertices.select("id")
        .join(summed, "id", "left")
        .select("id", F.coalesce("vec", zeros).alias("vec"))
    )


def neighbor_sum(edges: DataFrame, vectors: DataFrame, width: int) -> DataFrame:
    """Sum of neighbour vectors, every edge row counted once whatever its weight."""
    return message_pass(spread(edges.withColumn("w", F.lit(1.0))), vectors, width)


def attach(
    edges: DataFrame, end: str, values: DataFrame, hubs: DataFrame, name: str
) -> DataFrame:
    """Bring ``values(id, value)`` of the vertex at ``end`` to every edge as ``name``.

    ``hubs`` is the part of ``values`` that belongs to hubs, fewer than
    ``HUB_SHARE`` rows. Their edges take the value from a broadcast and travel
    under keys of their own, so no join task gets them all.
    """
    hot = F.broadcast(hubs.select(F.col("id").alias(end), F.col("value").alias("hot")))
    aside = -1 - F.pmod(F.xxhash64("src", "dst"), F.lit(HUB_SHARE))
    keyed = edges.join(hot, end, "left").withColumn(
        "key", F.when(F.col("hot").isNull(), F.col(end)).otherwise(aside)
    )
    cold = values.select(F.col("id").alias("key"), F.col("value").alias("cold"))
    return (
        keyed.join(cold, "key", "left")
        .withColumn(name, F.coalesce("hot", "cold"))
        .drop("key", "hot", "cold")
    )
