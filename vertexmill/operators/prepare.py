"""Graph preparation: features, labels, splits, and the normalised edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vertexmill.functions.scalars import inverse_sqrt_degree
from vertexmill.functions.vectors import argmax, map_batches, matrix_of, vectors_of
from vertexmill.operators.messages import (
    SpreadEdges,
    attach,
    find_hubs,
    hub_limit,
    salt_edges,
    with_copies,
)
from vertexmill.runtime import with_position, written

# ---------------------------------------------------------------- splits

#: Node type codes of the three splits.
TRAIN, VAL, TEST = 1, 2, 3


def split_masks(nodes: DataFrame, code: str = "node_type") -> DataFrame:
    """Boolean masks from a split code; any other code is in no split."""
    return nodes.withColumns(
        {
            "is_train": F.col(code) == TRAIN,
            "is_val": F.col(code) == VAL,
            "is_test": F.col(code) == TEST,
        }
    )


def split_positional(
    nodes: DataFrame, n_train: int | Column, test_ids: DataFrame, n_val: int = 500
) -> DataFrame:
    """First ``n_train`` ids train, the next ``n_val`` validation, listed ids test.

    The masks may overlap: a listed id stays in the slice it falls into.
    """
    first = n_train if isinstance(n_train, Column) else F.lit(n_train)
    listed = test_ids.select("id").distinct().withColumn("is_test", F.lit(True))
    return (
        nodes.join(listed, "id", "left")
        .withColumn("is_train", F.col("id") < first)
        .withColumn("is_val", (F.col("id") >= first) & (F.col("id") < first + n_val))
        .withColumn("is_test", F.coalesce("is_test", F.lit(False)))
    )


#: Bits of a key that one level of a rank search tells apart.
LEVEL_BITS = 16


def _unsigned(key: Column) -> Column:
    """Bits of a signed key whose unsigned order is the key's order."""
    return key.bitwiseXOR(F.lit(-(1 << 63)))


def cuts_at(keyed: DataFrame, ranks: list[int]) -> list[tuple[int, int] | None]:
    """The ``(key, id)`` at each of ``ranks`` in the order of ``(key, id)``; None beyond the last row.

    No row is sorted: a level counts the rows by the next bits of their keys, within the
    bucket where the rank falls, for all ranks at once. Only rows of equal keys are told
    apart by their ids.
    """
    found = [(0, rank) for rank in ranks]
    size = keyed.count()
    asked = [k for k, rank in enumerate(ranks) if rank < size]
    bits = _unsigned(F.col("key"))
    for shift in range(64 - LEVEL_BITS, -1, -LEVEL_BITS):
        here = [
            keyed.filter(F.shiftrightunsigned(bits, shift + LEVEL_BITS) == found[k][0] if shift < 64 - LEVEL_BITS else F.lit(True))
            .groupBy(F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << LEVEL_BITS) - 1)).alias("bucket"))
            .agg(F.count("*").alias("n"))
            .select(F.lit(k).alias("k"), "bucket", "n")
            for k in asked
        ]
        counts: dict[int, list[tuple[int, int]]] = {k: [] for k in asked}
        for part in here:
            for r in part.collect():
                counts[r["k"]].append((r["bucket"], r["n"]))
        for k in asked:
            prefix, left = found[k]
            for bucket, n in sorted(counts[k]):
                if left < n:
                    found[k] = (prefix << LEVEL_BITS | bucket, left)
                    break
                left -= n
    out: list[tuple[int, int] | None] = [None] * len(ranks)
    for k in asked:
        key = found[k][0] - (1 << 63)
        same = keyed.filter(F.col("key") == F.lit(key)).orderBy("id").limit(found[k][1] + 1).collect()
        out[k] = (key, same[-1]["id"])
    return out


def split_random(
    nodes: DataFrame, seed: int = 42, train_share: float = 0.6, val_share: float = 0.2
) -> DataFrame:
    """Seeded random split with exact sizes: ``int(share * n)`` rows, the rest test.

    Nodes are taken in the order of a hash of their ids; two cut points in that order, found
    by counting, make the split a filter.
    """
    size = nodes.count()
    n_train, n_val = int(size * train_share), int(size * val_share)
    keyed = nodes.select("id", F.xxhash64("id", F.lit(seed)).alias("key"))
    first, second = cuts_at(keyed, [n_train, n_train + n_val])
    key = F.xxhash64("id", F.lit(seed))

    def before(cut: tuple[int, int] | None) -> Column:
        if cut is None:
            return F.lit(True)
        return (key < F.lit(cut[0])) | ((key == F.lit(cut[0])) & (F.col("id") < F.lit(cut[1])))

    return nodes.withColumns(
        {"is_train": before(first), "is_val": ~before(first) & before(second), "is_test": ~before(second)}
    )


# ---------------------------------------------------------------- labels and features


def onehot_argmax(vec: Column) -> Column:
    """Class of a one-hot row: the first maximum wins."""
    return argmax(vec).cast("bigint")


def category_label(category: Column, first: str) -> Column:
    """Two-way label: 0 for the named category, 1 for any other."""
    return F.when(category == first, F.lit(0)).otherwise(F.lit(1)).cast("bigint")


def identity_triples(nodes: DataFrame) -> DataFrame:
    """Identity features as ``(id, col, val)``: one row per node at any size."""
    return nodes.select("id", F.col("id").alias("col"), F.lit(1.0).alias("val"))


def densify(triples: DataFrame, width: int) -> DataFrame:
    """``(id, col, val) -> (id, vec)``; repeated places add up, absent ones are 0.

    A row gathers at most ``width`` places because repeats are summed first.
    """
    places = triples.groupBy("id", "col").agg(F.sum("val").alias("val"))
    rows = places.groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("col", "val"))).alias("places")
    )
    split = rows.select(
        "id",
        F.transform("places", lambda p: p["col"]).alias("cols"),
        F.transform("places", lambda p: p["val"]).alias("vals"),
    )

    def scatter(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        cols, vals = batch.column("cols"), batch.column("vals")
        row = np.repeat(np.arange(batch.num_rows), cols.value_lengths().to_numpy())
        dense = np.zeros((batch.num_rows, width))
        dense[row, cols.flatten().to_numpy()] = vals.flatten().to_numpy()
        return {"id": batch.column("id"), "vec": vectors_of(dense)}

    return map_batches(split, "id bigint, vec array<double>", scatter)


def stack_blocks(first: DataFrame, second: DataFrame) -> DataFrame:
    """Put ``second`` below ``first``: ids run on from the size of the first block.

    Both hold ``row_pos`` from 0; the other columns are kept.
    """
    size = first.agg(F.count("*")).scalar()
    top = first.withColumn("id", F.col("row_pos"))
    below = second.withColumn("id", F.col("row_pos") + size)
    return top.unionByName(below).drop("row_pos")


def align_test_rows(
    stacked: DataFrame, test_rows: DataFrame, test_index: DataFrame, order: str = "file"
) -> DataFrame:
    """Write the i-th test row to the i-th listed id.

    ``order="file"`` takes ids as listed (column ``line``), the published
    convention; ``order="sorted"`` takes them in ascending order. Ids outside
    the stacked table are skipped.
    """
    if order == "file":
        if not test_index.filter("line IS NULL").isEmpty():
            raise ValueError("the listing has no order: give every id its line, or order='sorted'")
        placed = test_index.select(F.col("line").alias("row_pos"), "id")
    elif order == "sorted":
        placed = with_position(test_index.select("id"), "id", name="row_pos")
    else:
        raise ValueError(f"order must be 'file' or 'sorted', not {order!r}")
    kept = [c for c in stacked.columns if c != "id"]
    fresh = placed.join(test_rows, "row_pos").select(
        "id", F.lit(True).alias("replaced"), *[F.col(c).alias(f"new_{c}") for c in kept]
    )
    return stacked.join(fresh, "id", "left").select(
        "id",
        *[
            F.when(F.col("replaced"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c)
            for c in kept
        ],
    )


#: Ids generated per task row when a range is spelled out.
RANGE_STEP = 65_536


def spell_range(bounds: DataFrame, low: str, high: str, name: str) -> DataFrame:
    """Rows ``low..high`` of every bounds row, in two steps so no array grows with the range."""
    steps = bounds.filter(F.col(low) <= F.col(high)).withColumn(
        "step", F.explode(F.sequence(F.col(low), F.col(high), F.lit(RANGE_STEP).cast("bigint")))
    )
    upto = F.least(F.col("step") + (RANGE_STEP - 1), F.col(high))
    return steps.withColumn(name, F.explode(F.sequence(F.col("step"), upto))).drop("step")


def gap_fill(test_rows: DataFrame, feature_width: int, class_width: int) -> DataFrame:
    """Rows for every id between the smallest and largest test id.

    ``test_rows(id, features, onehot)``; ids that are not listed get zeros.
    ``row_pos`` counts from the smallest id.
    """
    bounds = test_rows.agg(F.min("id").alias("low"), F.max("id").alias("high"))
    every = spell_range(bounds, "low", "high", "id").select("id", "low")
    return every.join(test_rows, "id", "left").select(
        "id",
        (F.col("id") - F.col("low")).alias("row_pos"),
        F.coalesce("features", F.array_repeat(F.lit(0.0), feature_width)).alias("features"),
        F.coalesce("onehot", F.array_repeat(F.lit(0.0), class_width)).alias("onehot"),
    )


def feature_moments(nodes: DataFrame, column: str = "features") -> DataFrame:
    """One row per feature: ``(k, mean, std)`` with the population deviation.

    A task adds up its own rows as vectors and sends one row per feature; the
    squared deviations of the tasks are moved to the common mean, so large means
    cost no precision.
    """

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, squares = 0, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = matrix_of(batch.column(column))
            own = rows.mean(axis=0)
            off = ((rows - own) ** 2).sum(axis=0)
            if mean is None:
                n, mean, squares = len(rows), own, off
            elif len(own) != len(mean):
                raise ValueError(f"vectors of {len(mean)} and {len(own)} values in one column")
            else:
                both = n + len(rows)
                squares = squares + off + (own - mean) ** 2 * n * len(rows) / both
                mean, n = mean + (own - mean) * len(rows) / both, both
        if mean is not None:
            yield pa.RecordBatch.from_pydict(
                {
                    "k": pa.array(np.arange(len(mean), dtype=np.int32)),
                    "n": pa.array(np.full(len(mean), n, dtype=np.int64)),
                    "mean": pa.array(mean),
                    "squares": pa.array(squares),
                }
            )

    tasks = nodes.select(F.col(column).cast("array<double>").alias(column)).mapInArrow(
        moments, "k int, n bigint, mean double, squares double"
    )
    whole = Window.partitionBy("k")
    common = F.sum(F.col("n") * F.col("mean")).over(whole) / F.sum("n").over(whole)
    moved = tasks.withColumn("common", common)
    spread = F.col("squares") + F.col("n") * (F.col("mean") - F.col("common")) ** 2
    return moved.groupBy("k").agg(
        F.first("common").alias("mean"), F.sqrt(F.sum(spread) / F.sum("n")).alias("std")
    )


def standardize(nodes: DataFrame, column: str = "features") -> DataFrame:
    """Zero mean and unit population deviation per feature; constant features only lose their mean.

    The moments are feature-sized and come in as a scalar subquery.
    """
    divisor = F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")).alias("std")
    rows = feature_moments(nodes, column).select("k", "mean", divisor)
    by_place = F.array_sort(F.collect_list(F.struct("k", "mean", "std")))
    scaled = F.when(
        F.size(column) == F.size("_moments"),
        F.zip_with(column, "_moments", lambda x, m: (x - m["mean"]) / m["std"]),
    ).otherwise(F.raise_error(F.lit("feature vectors differ in length")).cast("array<double>"))
    return (
        nodes.withColumn("_moments", rows.agg(by_place).scalar())
        .withColumn(column, scaled)
        .drop("_moments")
    )


# ---------------------------------------------------------------- edges


def edges_in_range(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose two ends are below the number of nodes (ids are dense)."""
    size = nodes.agg(F.count("*")).scalar()
    return edges.filter((F.col("src") < size) & (F.col("dst") < size))


def dedup_edges(edges: DataFrame) -> DataFrame:
    """Add up the weights of repeated edges."""
    return edges.groupBy("src", "dst").agg(F.sum("w").alias("w"))


def _pairs(edges: DataFrame) -> DataFrame:
    """Edges by unordered pair; a loop meets itself, so it counts twice."""
    return edges.select(
        F.least("src", "dst").alias("lo"),
        F.greatest("src", "dst").alias("hi"),
        F.when(F.col("src") == F.col("dst"), 2 * F.col("w")).otherwise(F.col("w")).alias("w"),
    )


def _both_ways(pairs: DataFrame) -> DataFrame:
    """Every pair as its two directed edges, a loop once. Zero weights are no edges."""
    forth = F.struct(F.col("lo").alias("src"), F.col("hi").alias("dst"))
    back = F.struct(F.col("hi").alias("src"), F.col("lo").alias("dst"))
    ends = F.when(F.col("lo") == F.col("hi"), F.array(forth)).otherwise(F.array(forth, back))
    return pairs.filter("w <> 0").select("w", F.inline(ends)).select("src", "dst", "w")


def symmetrize(edges: DataFrame) -> DataFrame:
    """``A + A^T``, repeats added up.

    Grouping unordered pairs shuffles every edge once, half of what a union
    with the swapped table would.
    """
    return _both_ways(_pairs(edges).groupBy("lo", "hi").agg(F.sum("w").alias("w")))


def clip_edges(edges: DataFrame) -> DataFrame:
    """Weights above 1 become 1; smaller ones stay."""
    return edges.withColumn("w", F.least("w", F.lit(1.0)))


def add_self_loops(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``A + I``: adds 1 to the loop of every node, whether it had one or not."""
    loops = nodes.select(
        F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(1.0).alias("w")
    )
    return dedup_edges(edges.unionByName(loops))


def undirected(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Symmetrise, clip and add loops in one shuffle of the raw edges."""
    loops = nodes.select(
        F.col("id").alias("lo"), F.col("id").alias("hi"), F.lit(0.0).alias("w"),
        F.lit(1.0).alias("loop"),
    )
    pairs = _pairs(edges).withColumn("loop", F.lit(0.0)).unionByName(loops)
    merged = pairs.groupBy("lo", "hi").agg(F.sum("w").alias("w"), F.max("loop").alias("loop"))
    return _both_ways(
        merged.select("lo", "hi", (F.least("w", F.lit(1.0)) + F.col("loop")).alias("w"))
    )


def degree(edges: DataFrame) -> DataFrame:
    """Weighted degree ``(id, degree)``."""
    return edges.groupBy(F.col("src").alias("id")).agg(F.sum("w").alias("degree"))


def degree_scales(edges: DataFrame) -> tuple[DataFrame, int]:
    """``(id, value, n_edges)`` with ``value = degree ** -0.5``, written, and the hub limit."""
    counted = edges.groupBy(F.col("src").alias("id")).agg(
        F.sum("w").alias("degree"), F.count("*").alias("n_edges")
    )
    scales = written(
        counted.select("id", inverse_sqrt_degree(F.col("degree")).alias("value"), "n_edges"),
        "degrees",
    )
    return scales, hub_limit(scales.agg(F.coalesce(F.sum("n_edges"), F.lit(0))).first()[0])


def scale_edges(edges: DataFrame, scales: DataFrame, limit: int) -> DataFrame:
    """Multiply every weight by the values of its two ends."""
    hubs = scales.filter(F.col("n_edges") > limit)
    both = attach(attach(edges, "src", scales, hubs, "a"), "dst", scales, hubs, "b")
    return both.select("src", "dst", (F.col("w") * F.col("a") * F.col("b")).alias("w"))


def sym_normalize(edges: DataFrame) -> DataFrame:
    """``w / sqrt(degree(src) * degree(dst))`` over a symmetric table.

    Training does not need this table: it scales vertex vectors by the same
    factors before and after message passing and leaves the edges alone.
    """
    return scale_edges(edges, *degree_scales(edges))


def normalize_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """From raw edges to the normalised table used by the model."""
    return sym_normalize(written(undirected(edges, nodes), "edges"))


def normalize_and_spread(edges: DataFrame, nodes: DataFrame) -> SpreadEdges:
    """The normalised table, written, with its hubs split for message passing."""
    whole = written(undirected(edges, nodes), "edges")
    scales, limit = degree_scales(whole)
    normal = written(scale_edges(whole, scales, limit), "normalized")
    hubs = find_hubs(with_copies(scales, limit))
    return SpreadEdges(salt_edges(normal, hubs), hubs)


# ---------------------------------------------------------------- statistics


def dataset_stats(name: str, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: sizes, feature width, distinct classes and split counts."""
    n_edges = edges.agg(F.count("*")).scalar()
    return nodes.agg(
        F.lit(name).alias("name"),
        F.count("*").alias("num_nodes"),
        F.first(n_edges).alias("num_edges"),
        F.max(F.size("features")).cast("bigint").alias("input_dim"),
        F.countDistinct("label").alias("num_classes"),
        F.count_if("is_train").alias("train"),
        F.count_if("is_val").alias("val"),
        F.count_if("is_test").alias("test"),
    )


def feature_width(nodes: DataFrame, column: str = "features") -> int:
    """Length of the vectors, read from one row."""
    row = nodes.select(F.size(column).alias("n")).first()
    if row is None:
        raise ValueError("the node table is empty")
    return row["n"]


