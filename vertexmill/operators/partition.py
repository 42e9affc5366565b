"""Graph partitioning by ``id % parts``: local ids, block edges, balance and edge cut.

A part is a column, never an object: nothing here gathers a part in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vertexmill.functions.scalars import part_of
from vertexmill.operators.messages import HUB_FLOOR, attach, hub_limit
from vertexmill.operators.prepare import normalize_edges
from vertexmill.runtime import with_position


def assign_parts(nodes: DataFrame, parts: int) -> DataFrame:
    return nodes.withColumn("pid", part_of(F.col("id"), parts))


def distribute(nodes: DataFrame, parts: int) -> DataFrame:
    """Node rows with their part, laid out by part and id.

    A part may span several tasks, so few parts do not mean few tasks.
    """
    return assign_parts(nodes, parts).repartitionByRange("pid", "id")


#: A table with one row a part is broadcast up to this many parts.
BROADCAST_PARTS = 100_000


def small_side(per_part: DataFrame, parts: int) -> DataFrame:
    """A table of one row per part, broadcast where its size is known to be small."""
    return F.broadcast(per_part) if parts <= BROADCAST_PARTS else per_part


def dense_count(nodes: DataFrame) -> int | None:
    """Number of nodes if their ids are 0, 1, ... without gap or repeat.

    Where least, largest and number fit, the ids are counted as bits of bitmaps, so
    what is shuffled is a bitmap per 32,768 ids and task, no ids.
    """
    found = nodes.agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high")).first()
    n = found["n"]
    if n == 0 or (found["low"], found["high"]) != (0, n - 1):
        return None if n else 0
    bitmaps = nodes.groupBy(F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("id"))).alias("ids")
    )
    return n if bitmaps.agg(F.sum("ids")).first()[0] == n else None


def _local(vertex: Column, parts: int) -> Column:
    """Place in its part of a vertex among dense ids."""
    return F.floor(vertex / F.lit(parts)).cast("bigint")


def local_ids(nodes: DataFrame, parts: int) -> DataFrame:
    """``local_id``: place of a node among the sorted ids of its part.

    Dense ids give it by division. Otherwise places come from one global
    numbering by (part, id) less the first place of the part, so a part larger
    than a task is no obstacle.
    """
    if dense_count(nodes) is not None:
        return assign_parts(nodes, parts).select(
            "id", "pid", _local(F.col("id"), parts).alias("local_id")
        )
    return _numbered_ids(nodes, parts)


def _numbered_ids(nodes: DataFrame, parts: int) -> DataFrame:
    placed = with_position(assign_parts(nodes, parts).select("pid", "id"), "pid", "id")
    starts = placed.groupBy("pid").agg(F.min("pos").alias("start"))
    return placed.join(F.broadcast(starts), "pid").select(
        "id", "pid", (F.col("pos") - F.col("start")).alias("local_id")
    )


def _ends(parts: int) -> tuple[Column, Column]:
    return part_of(F.col("src"), parts), part_of(F.col("dst"), parts)


def block_edges(edges: DataFrame, parts: int) -> DataFrame:
    """Edges whose two ends share a part, by global ids. No join: the part follows from the id."""
    src_pid, dst_pid = _ends(parts)
    return edges.filter(src_pid == dst_pid)


def intra_edges(
    edges: DataFrame, nodes: DataFrame, parts: int, hub_floor: int = HUB_FLOOR
) -> DataFrame:
    """Edges inside a part by local ids: ``(pid, local_src, local_dst, w)``.

    Edges to ids that no node has are left out. Dense ids need no join.
    """
    size = dense_count(nodes)
    if size is not None:
        known = [F.col(end).between(0, size - 1) for end in ("src", "dst")]
        return block_edges(edges, parts).filter(known[0] & known[1]).select(
            part_of(F.col("src"), parts).alias("pid"),
            _local(F.col("src"), parts).alias("local_src"),
            _local(F.col("dst"), parts).alias("local_dst"),
            "w",
        )
    numbered = _numbered_ids(nodes, parts).select("id", F.col("local_id").alias("value"))
    inside = block_edges(edges, parts)
    for end in ("src", "dst"):
        # edges of a hub take its number from a broadcast, so no join task gets them all
        counted = edges_per_end(inside, end)
        total = counted.agg(F.coalesce(F.sum("n_edges"), F.lit(0))).first()[0]
        hubs = numbered.join(F.broadcast(counted.filter(F.col("n_edges") > hub_limit(total, hub_floor))), "id")
        inside = attach(inside, end, numbered, hubs.select("id", "value"), f"local_{end}")
    known = F.col("local_src").isNotNull() & F.col("local_dst").isNotNull()
    return inside.filter(known).select(part_of(F.col("src"), parts).alias("pid"), "local_src", "local_dst", "w")


def edges_per_end(edges: DataFrame, end: str) -> DataFrame:
    return edges.groupBy(F.col(end).alias("id")).agg(F.count("*").alias("n_edges"))


def boundary_edges(edges: DataFrame, parts: int) -> DataFrame:
    """Edges between parts, counted per pair of parts."""
    src_pid, dst_pid = _ends(parts)
    return (
        edges.select(src_pid.alias("src_pid"), dst_pid.alias("dst_pid"))
        .filter(F.col("src_pid") != F.col("dst_pid"))
        .groupBy("src_pid", "dst_pid")
        .agg(F.count("*").alias("n_edges"))
    )


def unit_blocks(edges: DataFrame, parts: int) -> DataFrame:
    """Edges inside a part, all weights 1."""
    return block_edges(edges, parts).withColumn("w", F.lit(1.0))


def local_normalize(edges: DataFrame, nodes: DataFrame, parts: int) -> DataFrame:
    """Normalise every part on its own edges.

    Weights restart at 1, then symmetrise, clip, add loops, scale by local
    degrees. Given an already normalised table (which holds all loops), every
    diagonal is 2 before scaling; given the symmetrised table it is 1, or 2
    where a loop existed.
    """
    return normalize_edges(unit_blocks(edges, parts), nodes).select(
        part_of(F.col("src"), parts).alias("pid"), "src", "dst", "w"
    )


def partition_sizes(nodes: DataFrame, parts: int) -> DataFrame:
    """``(pid, size)`` for all parts, empty ones included."""
    spark = nodes.sparkSession
    every = spark.range(parts).select(F.col("id").cast("int").alias("pid"))
    counted = assign_parts(nodes, parts).groupBy("pid").agg(F.count("*").alias("size"))
    return every.join(counted, "pid", "left").select(
        "pid", F.coalesce("size", F.lit(0)).cast("bigint").alias("size")
    )


def partition_quality(nodes: DataFrame, edges: DataFrame, parts: int) -> DataFrame:
    """One row: balance ratio, edge cut in percent, part sizes, edge counts."""
    src_pid, dst_pid = _ends(parts)
    counts = edges.agg(
        F.struct(F.count("*").alias("total"), F.count_if(src_pid != dst_pid).alias("cross"))
    ).scalar()
    balance = F.when(F.avg("size") > 0, F.try_divide(F.max("size"), F.avg("size"))).otherwise(
        F.lit(float("inf"))
    )
    in_order = F.array_sort(F.collect_list(F.struct("pid", "size")))
    sizes = partition_sizes(nodes, parts).agg(
        balance.alias("balance_ratio"),
        F.transform(in_order, lambda s: s["size"]).alias("partition_sizes"),
    ).withColumn("cut", counts)
    share = F.try_divide(F.col("cut.cross"), F.col("cut.total")) * 100.0
    return sizes.select(
        "balance_ratio",
        F.coalesce(share, F.lit(0.0)).alias("edge_cut_percentage"),
        "partition_sizes",
        F.col("cut.total").alias("total_edges"),
        F.col("cut.cross").alias("cross_partition_edges"),
        (F.col("cut.total") - F.col("cut.cross")).alias("intra_partition_edges"),
    )


def train_rows_per_part(nodes: DataFrame, parts: int) -> DataFrame:
    """``(pid, n_train)`` of the parts that hold training rows."""
    return (
        assign_parts(nodes.filter("is_train"), parts)
        .groupBy("pid")
        .agg(F.count("*").alias("n_train"))
    )
