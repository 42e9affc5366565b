"""Joins that bear hot keys, and small helpers around tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vertexmill.runtime import scratch_path, written

__all__ = ["fresh", "in_sorted_groups", "join_by", "scratch_path", "sorted_runs", "table", "written"]

#: Rows of a side that is broadcast at most; wider sides must say how many they bear.
BROADCAST_ROWS = 100_000

#: Join keys that a key is spread over where a side can't be broadcast.
SALTS = 16


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(name: str, columns: list[str]) -> str:
    """``name``, with underscores before it until no column begins so."""
    while any(c.lower().startswith(name.lower()) for c in columns):
        name = f"_{name}"
    return name


def join_by(
    rows: DataFrame, side: DataFrame, keys: list[str], how: str = "left", spread: str | None = None,
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join ``side`` (a written table with one row a key) to ``rows``, null keys equal.

    A side of at most ``limit`` rows, counted first, is broadcast. A larger one
    is joined by a shuffle in which every key is spread over ``SALTS`` join
    keys by the column ``spread`` of ``rows``, so that a hot key meets no single task.
    """
    mark, salt = fresh("_side_", rows.columns), fresh("_salt", rows.columns)
    named = side.select([F.col(c).alias(f"{mark}{c}") for c in side.columns])
    on = [rows[k].eqNullSafe(named[f"{mark}{k}"]) for k in keys]
    if named.limit(limit + 1).count() <= limit:
        named = F.broadcast(named)
    elif spread is not None:
        rows = rows.withColumn(salt, F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        named = named.withColumn(f"{mark}{salt}", salts)
        on = [rows[k].eqNullSafe(named[f"{mark}{k}"]) for k in keys]
        on.append(rows[salt] == named[f"{mark}{salt}"])
    joined = rows.join(named, on, how).drop(salt, f"{mark}{salt}")
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[f"{mark}{k}" for k in keys]).withColumnsRenamed(
        {f"{mark}{c}": c for c in side.columns if c not in keys}
    )


def sorted_runs(table: DataFrame, group: str) -> tuple[DataFrame, DataFrame]:
    """Rows of a table written in sorted order with their ``place`` in their group, and ``(group, rows)``.

    Files follow each other by their numbers, and rows by their index in the file, so
    no window runs over rows: a group is one run in each file that it spans.
    """
    laid = table.select(
        "*",
        F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("bigint").alias("_file"),
        F.col("_metadata.row_index").alias("_within"),
    )
    runs = written(laid.groupBy(group, "_file").agg(F.min("_within").alias("first"), F.count("*").alias("n")), "sorted-runs")
    before = F.sum("n").over(Window.partitionBy(group).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1))
    shifts = runs.select(group, "_file", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("_shift"))
    placed = join_by(laid, written(shifts, "sorted-shifts"), [group, "_file"], "inner", spread="_within")
    placed = placed.withColumn("place", F.col("_within") + F.col("_shift")).select(*table.columns, "place")
    return placed, runs.groupBy(group).agg(F.sum("n").alias("rows"))


def in_sorted_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], names: list[str]
) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Keys and columns of consecutive rows with the same keys, across batches."""
    key, kept = None, {}
    for batch in batches:
        found = list(zip(*[batch.column(c).to_pylist() for c in keys], strict=True))
        columns = {c: batch.column(c).to_pylist() for c in names}
        at = 0
        while at < len(found):
            end = at
            while end < len(found) and found[end] == found[at]:
                end += 1
            if found[at] != key:
                if key is not None:
                    yield key, kept
                key, kept = found[at], {c: [] for c in names}
            for c in names:
                kept[c] += columns[c][at:end]
            at = end
    if key is not None:
        yield key, kept
