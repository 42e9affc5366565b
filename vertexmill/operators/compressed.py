"""Message passing over compressed edge rows: runs of a target, summed by NumPy.

Edges lie in slots, one for a task, sorted by target. A slot's edges are blocks of row
pointers, targets, sources and weights, so an edge costs its numbers and no row, and the
sums of a target are formed where its edges stand next to each other. Blocks and
vectors of a slot meet in one task, which neither holds more than the layout allows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexmill.functions.vectors import PIECE, matrix_of, sum_vectors, vectors_of
from vertexmill.operators.messages import join_pieces

#: Edges of one block; a run may go on in the next one.
BLOCK_EDGES = 1 << 18

#: Runs of fewer edges on average are summed all at once, longer ones by a product each.
LONG_RUN = 8

#: Numbers that are gathered at a time where runs are summed at once.
GATHERED = 1 << 21

BLOCKS = "slot bigint, seq bigint, pointers binary, targets binary, sources binary, weights binary"


def slot_values(spark: SparkSession, tasks: int) -> tuple[int, ...]:
    """A value of ``slot`` for each of ``tasks`` tasks, such that hashing it leads there.

    Consecutive numbers would leave some of so many tasks empty and give others two slots.
    """
    tried = spark.range(64 * tasks + 64).groupBy(F.pmod(F.hash("id"), F.lit(tasks)).alias("task"))
    found = {r["task"]: r["value"] for r in tried.agg(F.min("id").alias("value")).collect()}
    return tuple(found.get(task, task) for task in range(tasks))


def slot_of(number: Column, values: tuple[int, ...]) -> Column:
    """The slot of the task ``number``, a column counting from 0."""
    return F.get(F.array(*[F.lit(v).cast("bigint") for v in values]), number.cast("int"))


def _block(slot: int, seq: int, source: np.ndarray, target: np.ndarray, weight: np.ndarray) -> pa.RecordBatch:
    first = np.concatenate([[0], np.flatnonzero(target[1:] != target[:-1]) + 1])
    pointers = np.append(first, len(target)).astype(np.int64)
    plain = b"" if (weight == 1.0).all() else weight.astype(np.float64).tobytes()
    return pa.RecordBatch.from_pydict(
        {
            "slot": pa.array([slot], pa.int64()),
            "seq": pa.array([seq], pa.int64()),
            "pointers": pa.array([pointers.tobytes()], pa.binary()),
            "targets": pa.array([target[first].astype(np.int64).tobytes()], pa.binary()),
            "sources": pa.array([source.astype(np.int64).tobytes()], pa.binary()),
            "weights": pa.array([plain], pa.binary()),
        }
    )


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("slot", "key", "dst", "w")
    held, count, seq = [], 0, 0

    def cut(parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        nonlocal seq
        slot, key, dst, w = (np.concatenate(c) for c in zip(*parts, strict=True))
        edges = np.concatenate([[0], np.flatnonzero(slot[1:] != slot[:-1]) + 1, [len(slot)]])
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield _block(int(slot[a]), seq, key[a:b], dst[a:b], w[a:b])
            seq += 1

    for batch in batches:
        if batch.num_rows:
            held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in names])
            count += batch.num_rows
        if count >= BLOCK_EDGES:
            yield from cut(held)
            held, count = [], 0
    if held:
        yield from cut(held)


def compressed(edges: DataFrame) -> DataFrame:
    """Blocks of an edge table ``(slot, key, dst, w)`` whose partitions are sorted by slot and target."""
    return edges.select("slot", "key", "dst", "w").mapInArrow(_blocks_of, BLOCKS)


class SlotEdges:
    """The blocks of one slot over its vertices ``ids``: sources and targets as rows of theirs."""

    def __init__(self, blocks: pa.Table, ids: np.ndarray, targets: np.ndarray | None = None):
        order = np.argsort(ids, kind="stable")
        named = ids[order]

        def numbers(column: str, kind: type) -> list[np.ndarray]:
            return [np.frombuffer(v, dtype=kind) for v in blocks.column(column).to_pylist()]

        self.pointers = numbers("pointers", np.int64)
        to = numbers("targets", np.int64)
        self.targets = np.unique(np.concatenate(to)) if targets is None and to else targets
        if self.targets is None:
            self.targets = np.zeros(0, dtype=np.int64)
        by_target = np.argsort(self.targets, kind="stable")
        sorted_targets = self.targets[by_target]
        self.to = [by_target[np.searchsorted(sorted_targets, t)] for t in to]
        self.sources = [order[np.searchsorted(named, s)] for s in numbers("sources", np.int64)]
        self.weights = [w if len(w) else None for w in numbers("weights", np.float64)]

    def sums(self, vectors: np.ndarray) -> np.ndarray:
        """For every target the weighted sum of its sources' rows of ``vectors``."""
        out = np.zeros((len(self.targets), vectors.shape[1]))
        for pointers, to, sources, weights in zip(self.pointers, self.to, self.sources, self.weights, strict=True):
            if len(sources) >= LONG_RUN * len(to):
                ones = np.ones(len(sources)) if weights is None else weights
                for k, target in enumerate(to):
                    a, b = pointers[k], pointers[k + 1]
                    out[target] += ones[a:b] @ vectors[sources[a:b]]
                continue
            step = max(1, GATHERED // max(1, vectors.shape[1]))
            for a in range(0, len(sources), step):
                b = min(a + step, len(sources))
                first = np.searchsorted(pointers, a, side="right") - 1
                last = np.searchsorted(pointers, b, side="left")
                rows = vectors[sources[a:b]]
                if weights is not None:
                    rows = rows * weights[a:b, None]
                out[to[first:last]] += np.add.reduceat(rows, np.maximum(pointers[first:last], a) - a, axis=0)
        return out


def _slot_sums(at: int, some: int):
    """Partial sums of a slot for ``some`` columns from ``at``, in pieces."""

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = right.column("key").to_numpy()
        edges = SlotEdges(left, ids)
        sums = edges.sums(matrix_of(right.column("vec"))) if len(edges.targets) else np.zeros((0, some))
        made = [
            pa.table(
                {
                    "id": edges.targets,
                    "at": np.full(len(sums), at + first, dtype=np.int32),
                    "vec": vectors_of(sums[:, first : first + PIECE]),
                }
            )
            for first in range(0, some, PIECE)
        ]
        return pa.concat_tables(made)

    return add_up


def compressed_pass(blocks: DataFrame, vectors: DataFrame, width: int, columns: int) -> DataFrame:
    """``(id, vec)``: as a message pass, from blocks and vectors ``(slot, key, vec)`` of ``width`` numbers.

    Each slot's partial sums leave its task in pieces of ``PIECE`` and are added up per
    target. ``columns`` bounds how much of the width is summed at a time, and with it a
    task's memory; blocks and vectors meet anew for each such part of the width.
    """
    parts = []
    if width <= min(PIECE, columns):
        met = blocks.groupBy("slot").cogroup(vectors.select("slot", "key", "vec").groupBy("slot"))
        sums = met.applyInArrow(_slot_sums(0, width), "id bigint, at int, vec array<double>")
        return sum_vectors(sums.drop("at"), ["id"], width)
    step = -(-width // -(-width // columns))  # parts of about the same width
    for at in range(0, width, step):
        some = min(step, width - at)
        cut = vectors.select("slot", "key", F.slice("vec", at + 1, some).alias("vec"))
        met = blocks.groupBy("slot").cogroup(cut.groupBy("slot"))
        parts.append(met.applyInArrow(_slot_sums(at, some), "id bigint, at int, vec array<double>"))
    pieces = parts[0]
    for part in parts[1:]:
        pieces = pieces.unionAll(part)
    return join_pieces(sum_vectors(pieces, ["id", "at"], min(PIECE, width)))
