"""Vector columns: built-in expressions, and NumPy over Arrow batches for dense products."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row, as the variable of a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def relu(vec: Column) -> Column:
    return F.transform(vec, lambda x: F.greatest(x, F.lit(0.0)))


def relu_gate(grad: Column, pre_activation: Column) -> Column:
    """Gradient where the pre-activation is positive, else 0."""
    return F.zip_with(grad, pre_activation, lambda g, z: F.when(z > 0, g).otherwise(F.lit(0.0)))


def softmax(logits: Column) -> Column:
    """Row softmax, shifted by the row maximum; maximum and sum are taken once per row."""

    def shares(powers: Column) -> Column:
        total = F.aggregate(powers, F.lit(0.0), lambda acc, x: acc + x)
        return bound(total, lambda t: F.transform(powers, lambda x: x / t))

    powers = bound(F.array_max(logits), lambda m: F.transform(logits, lambda x: F.exp(x - m)))
    return bound(powers, shares)


def argmax(vec: Column) -> Column:
    """Index of the first maximum, from 0."""
    return F.array_position(vec, F.array_max(vec)) - 1


def matrix_of(column: pa.Array) -> np.ndarray:
    """A list column as a matrix without copying. Rows must have one length and no nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten()
    if not len(column):
        return flat.to_numpy(zero_copy_only=False).reshape(0, 0)
    lengths = column.value_lengths()
    if column.null_count or flat.null_count:
        raise ValueError("null vector, or null in a vector")
    width = lengths[0].as_py()
    if (lengths.to_numpy() != width).any():
        raise ValueError("vectors of one column differ in length")
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), width)


def vectors_of(matrix: np.ndarray) -> pa.ListArray:
    """The rows of a matrix as a list column."""
    rows, width = matrix.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * width, type=pa.int32())
    flat = np.ascontiguousarray(matrix, dtype=np.float64).reshape(-1)
    return pa.ListArray.from_arrays(offsets, pa.array(flat))


def map_batches(
    df: DataFrame,
    schema: str,
    fn: Callable[[pa.RecordBatch], dict[str, pa.Array]],
) -> DataFrame:
    """Apply ``fn`` to every non-empty Arrow batch; it returns the output columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(fn(batch))

    return df.mapInArrow(run, schema)


def project(vectors: DataFrame, weights: np.ndarray) -> DataFrame:
    """``(id, vec) -> (id, vec @ weights)``. The matrix is model-sized and is broadcast."""
    shared = vectors.sparkSession.sparkContext.broadcast(np.asarray(weights, dtype=np.float64))

    def multiply(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        rows = matrix_of(batch.column("vec"))
        return {"id": batch.column("id"), "vec": vectors_of(rows @ shared.value)}

    return map_batches(vectors.select("id", "vec"), "id bigint, vec array<double>", multiply)


def outer_sum(left: DataFrame, right: DataFrame) -> DataFrame:
    """``sum over ids of left.vec^T right.vec`` as matrix pieces.

    Every task adds its own rows up and sends one partial matrix, so the
    shuffle carries matrices, never per-vertex products.
    """
    both = left.select("id", F.col("vec").alias("a")).join(
        right.select("id", F.col("vec").alias("b")), "id"
    )
    return sum_matrices(both.select("a", "b").mapInArrow(_outer_partials, MATRIX_PIECES))


def _outer_partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if batch.num_rows:
            part = matrix_of(batch.column("a")).T @ matrix_of(batch.column("b"))
            total = part if total is None else total + part
    if total is not None:
        yield from matrix_pieces(total, 0)


#: Widest vector summed in one aggregate; keeps the generated aggregation code compiled.
PIECE = 64

#: A piece of one row of a layer's matrix: layer, row, first column, values.
MATRIX_PIECES = "layer int, i int, j0 int, vec array<double>"


def sum_vectors(df: DataFrame, keys: list[str], width: int, weight: str | None = None) -> DataFrame:
    """Element-wise sum of ``vec`` per key, at most ``PIECE`` wide, combined before the shuffle.

    Vectors may be shorter than ``width``; the sum is as long as the longest. A
    place that is null in all vectors of a key is an error, never left out.
    ``weight`` names a column to multiply by.
    """
    times = f"{weight} * " if weight else ""
    sums = [F.expr(f"sum({times}get(vec, {k})) AS s{k}") for k in range(width)]
    whole = ", ".join(f"s{k}" for k in range(width))
    known = "coalesce(x, CAST(raise_error('null in a vector') AS DOUBLE))"
    return df.groupBy(*keys).agg(*sums, F.expr("max(size(vec)) AS longest")).selectExpr(
        *keys, f"transform(slice(array({whole}), 1, longest), x -> {known}) AS vec"
    )


def matrix_pieces(matrix: np.ndarray, layer: int) -> Iterator[pa.RecordBatch]:
    """A matrix as rows of at most ``PIECE`` columns."""
    rows, columns = matrix.shape
    for first in range(0, columns, PIECE):
        yield pa.RecordBatch.from_pydict(
            {
                "layer": pa.array(np.full(rows, layer, dtype=np.int32)),
                "i": pa.array(np.arange(rows, dtype=np.int32)),
                "j0": pa.array(np.full(rows, first, dtype=np.int32)),
                "vec": vectors_of(matrix[:, first : first + PIECE]),
            }
        )


def sum_matrices(pieces: DataFrame, columns: int = PIECE, branches: int = 1) -> DataFrame:
    """Add up matrix pieces of equal place, for matrices of at most ``columns`` columns.

    With ``branches`` above 1 the sum is a two-level tree: the partials of
    every place are first added in that many groups, then together.
    """
    place, width = ["layer", "i", "j0"], min(columns, PIECE)
    if branches > 1:
        marked = pieces.withColumn("branch", F.spark_partition_id() % branches)
        pieces = sum_vectors(marked, [*place, "branch"], width).drop("branch")
    return sum_vectors(pieces, place, width)


def matrices_of(pieces: list, dims: list[int]) -> list[np.ndarray]:
    """Collected pieces as one matrix per layer; absent places are 0."""
    made = [np.zeros((a, b)) for a, b in zip(dims[:-1], dims[1:], strict=True)]
    for p in pieces:
        made[p["layer"]][p["i"], p["j0"] : p["j0"] + len(p["vec"])] = p["vec"]
    return made


def pieces_to_long(pieces: DataFrame) -> DataFrame:
    """``(layer, i, j, v)`` from matrix pieces."""
    return pieces.select("layer", "i", "j0", F.posexplode("vec").alias("at", "v")).select(
        F.col("layer").cast("int").alias("layer"),
        F.col("i").cast("int").alias("i"),
        (F.col("j0") + F.col("at")).cast("int").alias("j"),
        "v",
    )
