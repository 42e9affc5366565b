"""What training keeps for all epochs: edges and vertices laid out once.

The normalisation ``w / sqrt(degree(src) * degree(dst))`` stays out of the
edge table. Scaling a vertex's vector by ``degree ** -0.5`` before and after
message passing gives the same sums, so no edge is ever joined to degrees.

``ax`` holds the aggregated features ``A X``. They are constant, so the first
layer needs no edge pass in any epoch, forward or backward.

Edges lie by source, so a pass moves vectors to edges and never edges. Inside
a task they are sorted by target: the sums of a target are added up while
they are at hand, and only the small table of source vectors is probed at random.

A layout's plans belong to a session of its own that shuffles into as many parts as
the layout has tasks. So the caller's settings are neither changed nor heeded
afterwards, and layouts of one session can train side by side.
"""

from __future__ import annotations

from contextlib import ExitStack
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexmill.functions.scalars import inverse_sqrt_degree, part_of
from vertexmill.functions.vectors import map_batches, matrix_of, vectors_of
from vertexmill.operators.compressed import (
    SlotEdges,
    compressed,
    compressed_pass,
    slot_of,
    slot_values,
)
from vertexmill.operators.messages import (
    HUB_FLOOR,
    find_hubs,
    hub_limit,
    join_hint,
    message_pass,
    salt_edges,
    spread_vectors,
    with_copies,
)
from vertexmill.operators.partition import block_edges, small_side, train_rows_per_part
from vertexmill.operators.prepare import feature_width, undirected
from vertexmill.runtime import drop_written, kept_by, seen_from, side_session, written

#: Edges one task reads in a large graph, and the fewest worth a task of their own.
#: Edges are streamed, so large tasks cost no memory, and the more edges of a target
#: meet in one task the fewer partial sums are shuffled.
EDGES_PER_TASK = 16_000_000
EDGES_WORTH_A_TASK = 20_000

#: Bytes of sums that a task of the first-layer pass holds, and fewest columns worth a pass of their own.
SUM_BYTES, LEAST_COLUMNS = 256 << 20, 64

#: A part whose edges and features take at most so many bytes is one task's.
PART_BYTES = 1 << 30

#: Bytes of vertex vectors one task holds.
VECTOR_BYTES_PER_TASK = 128 << 20


def task_count(n_edges: int, n_vertices: int, width: int, cores: int) -> int:
    """Tasks per stage of training, from the size of the graph.

    Small graphs get no more tasks than are worth starting, others at least
    one per core, and large ones as many as keep a task's share in memory.
    """
    by_edges = -(-n_edges // EDGES_PER_TASK)
    by_vectors = -(-n_vertices * width * 8 // VECTOR_BYTES_PER_TASK)
    for_cores = min(cores, -(-n_edges // EDGES_WORTH_A_TASK))
    return max(1, by_edges, by_vectors, for_cores)


@dataclass
class Layout:
    """``edges(key, dst, w)`` by source; ``vertices(id, ..., ax)`` by id.

    Both are hashed into ``tasks`` parts. ``rows_per_task`` is how many source
    vectors, copies included, meet the edges of one task.

    With ``slots``, the values that lead to each task, ``edges`` are compressed blocks by
    ``slot`` instead, and a task sums up to ``columns`` at a time. With ``local``, the vertices
    lie by slot too, one part in each: then nothing but gradients leaves a part's task.
    Tables for the caller are read in its session, ``caller``.
    """

    caller: SparkSession
    edges: DataFrame
    vertices: DataFrame
    tasks: int
    rows_per_task: float
    input_dim: int
    num_classes: int
    n_train: int
    parts: int | None
    tables: tuple[DataFrame, ...] = ()
    local: bool = False
    slots: tuple[int, ...] = ()
    columns: int = 0

    def hint(self, width: int) -> str:
        return join_hint(self.rows_per_task, width)

    def send(self, messages: DataFrame, width: int) -> DataFrame:
        """One edge pass; its sums come back hashed by id like the vertices."""
        if self.slots:
            return compressed_pass(self.edges, in_slots(messages, self.slots), width, self.columns)
        return message_pass(self.edges, messages, width, self.hint(width))

    def release(self) -> None:
        """Free the caches and delete the tables they are rebuilt from."""
        self.edges.unpersist()
        self.vertices.unpersist()
        drop_written(*self.tables)


def block_weights(whole: DataFrame, parts: int, local_input: str) -> DataFrame:
    """Edge table of partition-local training, from the whole undirected table with loops.

    Weights restart at 1 inside a part, and a loop is added once more: on top
    of the loops of the normalised table (``"normalized"``, always 2), or of
    the natural ones only (``"raw"``). In ``whole`` a natural loop is one whose
    weight is not the bare 1 of the added loop.
    """
    if local_input == "normalized":
        loop = F.lit(2.0)
    elif local_input == "raw":
        loop = F.when(F.col("w") != 1.0, F.lit(2.0)).otherwise(F.lit(1.0))
    else:
        raise ValueError(f"local_input must be 'normalized' or 'raw', not {local_input!r}")
    weight = F.when(F.col("src") == F.col("dst"), loop).otherwise(F.lit(1.0))
    return block_edges(whole, parts).withColumn("w", weight)


def row_weights(nodes: DataFrame, parts: int | None) -> DataFrame:
    """``row_weight``: what a training row counts in the gradient.

    ``1 / n_train`` over the whole graph. With parts, gradients are a plain
    mean over parts of per-part means, so ``1 / (parts * n_train(part))``.
    """
    if parts is None:
        n_train = nodes.agg(F.count_if("is_train")).scalar()
        weight = F.try_divide(F.lit(1.0), n_train)
        weighted = nodes.withColumn("row_weight", weight)
    else:
        per_part = train_rows_per_part(nodes, parts)
        weighted = (
            nodes.withColumn("pid", part_of(F.col("id"), parts))
            .join(small_side(per_part, parts), "pid", "left")
            .withColumn("row_weight", F.try_divide(F.lit(1.0), F.col("n_train") * parts))
            .drop("pid", "n_train")
        )
    known = F.coalesce("row_weight", F.lit(0.0))
    return weighted.withColumn("row_weight", F.when(F.col("is_train"), known).otherwise(F.lit(0.0)))


def check_vertices(nodes: DataFrame, vertices: int, least: int) -> None:
    """Every vertex has a loop, so more vertices than nodes come from edges to unknown ids."""
    n_nodes = nodes.count()
    if vertices != n_nodes:
        raise ValueError(
            f"{vertices} vertices in edges and loops, {n_nodes} node rows: edges name ids outside"
            " the node table (see edges_in_range), or node ids repeat"
        )
    if least < 0:
        raise ValueError(f"vertex ids must not be negative: {least}")


def scale_vectors(df: DataFrame, kept: list[str]) -> DataFrame:
    """``vec * scale`` row by row, keeping the named columns."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema if f.name in kept)

    def scale(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        factor = batch.column("scale").to_numpy()[:, None]
        out = {c: batch.column(c) for c in batch.schema.names if c in kept}
        return {**out, "vec": vectors_of(matrix_of(batch.column("vec")) * factor)}

    return map_batches(df, f"{schema}, vec array<double>", scale)


def sum_columns(n_edges: int, n_vertices: int, tasks: int, sum_bytes: int = SUM_BYTES) -> int:
    """Columns that a task can sum at once for all targets of its edges; 0 if too few."""
    targets = max(1, min(n_vertices, -(-n_edges // tasks)))
    columns = sum_bytes // (8 * targets)
    return columns if columns >= LEAST_COLUMNS else 0


def in_slots(vectors: DataFrame, slots: tuple[int, ...]) -> DataFrame:
    """``(slot, key, vec)``: every copy of a vertex where the edges of its key are."""
    task = F.pmod(F.hash("key"), F.lit(len(slots)))
    return spread_vectors(vectors).withColumn("slot", slot_of(task, slots))


def kept_blocks(keyed: DataFrame, slots: tuple[int, ...]) -> tuple[DataFrame, DataFrame]:
    """Edges ``(slot, key, dst, w)`` as compressed blocks: kept by slot, and the table below."""
    tasks = len(slots)
    ordered = keyed.repartition(tasks, "slot").sortWithinPartitions("slot", "dst")
    blocks = written(compressed(ordered), "blocks")
    return kept_by(blocks, tasks, "slot", order=["slot", "seq"]), blocks


def part_sizes(merged: DataFrame, nodes: DataFrame, parts: int, width: int) -> int:
    """Bytes of the largest part: edges as numbers, features twice over."""
    edges = merged.groupBy(part_of(F.col("src"), parts).alias("pid")).agg(F.count("*").alias("n"))
    rows = nodes.groupBy(part_of(F.col("id"), parts).alias("pid")).agg(F.count("*").alias("m"))
    size = F.coalesce("n", F.lit(0)) * 24 + F.coalesce("m", F.lit(0)) * 16 * width
    return rows.join(edges, "pid", "left").agg(F.coalesce(F.max(size), F.lit(0))).first()[0]


def lay_out_parts(
    caller: SparkSession,
    merged: DataFrame,
    nodes: DataFrame,
    counted: DataFrame,
    parts: int,
    width: int,
    classes: int | None,
) -> Layout:
    """Layout by part, for parts that fit a task: edges and vertices of one part lie together."""
    spark = nodes.sparkSession
    slots = slot_values(spark, parts)

    def slot(column: str):
        return slot_of(part_of(F.col(column), parts), slots)

    laid_edges, blocks = kept_blocks(
        merged.select(slot("src").alias("slot"), F.col("src").alias("key"), "dst", "w"), slots
    )
    vertices = row_weights(nodes, parts).join(counted.drop("copies"), "id").withColumn("slot", slot("id"))
    vertices = vertices.withColumn("features", F.col("features").cast("array<double>"))
    carried = [c for c in vertices.columns if c != "features"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vertices.schema if f.name in carried)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))

    def aggregate(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = right.column("id").to_numpy()
        scale = right.column("scale").to_numpy()[:, None]
        sums = SlotEdges(left, ids, ids).sums(matrix_of(right.column("vec")) * scale)
        out = {c: right.column(c) for c in carried}
        return pa.table({**out, "ax": vectors_of(sums * scale)})

    named = vertices.withColumnRenamed("features", "vec").select(*carried, "vec")
    met = laid_edges.groupBy("slot").cogroup(named.groupBy("slot"))
    aggregated = written(met.applyInArrow(aggregate, f"{schema}, ax array<double>"), "vertices")
    laid_vertices = kept_by(aggregated, parts, "slot", order="slot")
    found = laid_vertices.agg(
        F.countDistinct("label").alias("classes"), F.count_if("is_train").alias("n_train")
    ).first()
    return Layout(
        caller=caller,
        edges=laid_edges,
        vertices=laid_vertices,
        tasks=parts,
        rows_per_task=0.0,
        input_dim=width,
        num_classes=classes or found["classes"],
        n_train=found["n_train"],
        parts=parts,
        tables=(merged, counted, blocks, aggregated),
        local=True,
        slots=slots,
    )


def lay_out(
    nodes: DataFrame,
    edges: DataFrame,
    parts: int | None = None,
    local_input: str = "normalized",
    num_classes: int | None = None,
    tasks: int | None = None,
    hub_floor: int = HUB_FLOOR,
    part_bytes: int = PART_BYTES,
    sum_bytes: int = SUM_BYTES,
    merged: DataFrame | None = None,
) -> Layout:
    """Build the training layout from a node table and *raw* edges.

    Shuffles every edge twice: once to merge repeats, once to its place. Edges are kept
    as compressed blocks where a task's sums take at most ``sum_bytes``, else as rows that are
    joined and may spill. Parts of at most ``part_bytes`` lie in a task each.

    ``merged`` is the written undirected table with loops, where several layouts of a graph
    share it: then a layout is a filter of it, and leaves it to its owner.
    """
    caller = nodes.sparkSession
    side = side_session(caller)
    with ExitStack() as views:
        if merged is not None and parts is None:
            table, own = views.enter_context(seen_from(side, merged)), ()
        else:
            if merged is not None:
                chosen = block_weights(merged, parts, local_input)
            elif parts is None:
                chosen = undirected(edges, nodes)
            else:
                # edges between parts go before the shuffle, as no merged edge needs them
                inside = undirected(block_edges(edges, parts), nodes)
                chosen = block_weights(inside, parts, local_input)
            table = written(chosen, "edges", side)
            own = (table,)
        rows = views.enter_context(seen_from(side, nodes))
        return _lay_out(caller, rows, table, own, parts, num_classes, tasks, hub_floor, part_bytes, sum_bytes)


def _lay_out(
    caller: SparkSession,
    nodes: DataFrame,
    merged: DataFrame,
    own: tuple[DataFrame, ...],
    parts: int | None,
    num_classes: int | None,
    tasks: int | None,
    hub_floor: int,
    part_bytes: int,
    sum_bytes: int,
) -> Layout:
    """The layout of a written edge table, in the session of ``nodes`` and ``merged``; ``own`` are its tables so far."""
    per_vertex = merged.groupBy(F.col("src").alias("id")).agg(
        F.sum("w").alias("degree"), F.count("*").alias("n_edges")
    )
    scaled = per_vertex.select(
        "id", "n_edges", inverse_sqrt_degree(F.col("degree")).alias("scale")
    )
    n_edges, width = merged.count(), feature_width(nodes)
    counted = written(with_copies(scaled, hub_limit(n_edges, hub_floor)).drop("n_edges"), "degrees")
    hubs = written(find_hubs(counted), "hubs")
    size = counted.agg(
        F.count("*").alias("vertices"), F.sum("copies").alias("copies"), F.min("id").alias("least")
    ).first()
    check_vertices(nodes, size["vertices"], size["least"])
    if parts is not None and part_sizes(merged, nodes, parts, width) <= part_bytes:
        layout = lay_out_parts(caller, merged, nodes, counted, parts, width, num_classes)
        drop_written(hubs)
        return layout
    spark = nodes.sparkSession
    cores = spark.sparkContext.defaultParallelism
    tasks = tasks or task_count(n_edges, size["vertices"], width, cores)
    rows_per_task = size["copies"] / tasks

    keyed = salt_edges(merged, hubs).select("key", "dst", "w")
    columns = sum_columns(n_edges, size["vertices"], tasks, sum_bytes)
    slots, blocks = (), ()
    if columns:
        slots = slot_values(spark, tasks)
        task = F.pmod(F.hash("key"), F.lit(tasks))
        laid_edges, *blocks = kept_blocks(keyed.withColumn("slot", slot_of(task, slots)), slots)
    else:
        laid_edges = kept_by(keyed, tasks, "key", order="dst")
    firsts = F.broadcast(hubs.select("id", "first"))
    vertices = row_weights(nodes, parts).join(counted, "id").join(firsts, "id", "left")
    vectors = scale_vectors(
        vertices.select("id", "copies", "first", "scale", F.col("features").alias("vec")),
        ["id", "copies", "first"],
    )
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    if columns:
        placed = in_slots(vectors, slots)
        if columns < width:
            placed = written(placed, "vectors")  # read for each part of the width
            blocks = [*blocks, placed]
        summed = compressed_pass(laid_edges, placed, width, columns)
    else:
        summed = message_pass(laid_edges, vectors, width, join_hint(rows_per_task, width))
    joined = vertices.drop("features").join(summed, "id")
    kept = [c for c in joined.columns if c != "vec"]
    aggregated = written(scale_vectors(joined, kept).withColumnRenamed("vec", "ax"), "vertices")
    laid_vertices = kept_by(aggregated, tasks, "id")

    found = laid_vertices.agg(
        F.countDistinct("label").alias("classes"), F.count_if("is_train").alias("n_train")
    ).first()
    return Layout(
        caller=caller,
        edges=laid_edges,
        vertices=laid_vertices,
        tasks=tasks,
        rows_per_task=rows_per_task,
        input_dim=width,
        num_classes=num_classes or found["classes"],
        n_train=found["n_train"],
        parts=parts,
        tables=(*own, counted, hubs, *blocks, aggregated),
        slots=slots,
        columns=columns,
    )
