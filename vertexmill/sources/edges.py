"""Edge sources: coordinate lists, compressed rows, neighbour lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexmill.operators.prepare import spell_range


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table by its ending: ``.csv`` with a header, anything else Parquet."""
    if path.rstrip("/").endswith(".csv"):
        return spark.read.option("header", True).csv(path)
    return spark.read.parquet(path)


def read_if_there(read: Callable[[str], DataFrame], path: str) -> DataFrame | None:
    """``read(path)``, or None where the path or pattern names nothing."""
    try:
        return read(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def edges_coo(table: DataFrame, row: str = "row", col: str = "col") -> DataFrame:
    """Coordinate list; every entry weighs 1."""
    return table.select(
        F.col(row).cast("bigint").alias("src"),
        F.col(col).cast("bigint").alias("dst"),
        F.lit(1.0).alias("w"),
    )


def edges_from_csr_rows(rows: DataFrame) -> DataFrame:
    """Compressed rows as ``(id, indices[], data[])``; a row may come in several pieces."""
    return rows.select(
        F.col("id").cast("bigint").alias("src"), F.inline(F.arrays_zip("indices", "data"))
    ).select(
        "src", F.col("indices").cast("bigint").alias("dst"), F.col("data").cast("double").alias("w")
    )


def edges_from_csr_vectors(indptr: DataFrame, entries: DataFrame) -> DataFrame:
    """The flat layout: ``indptr(pos, value)`` and ``entries(pos, index, data)``.

    Row bounds pair each pointer with the next by an equi-join, the positions
    of a row are spelled out in bounded steps, and entries join by position,
    which is unique, so a row with most of the entries stays spread out.
    """
    upper = indptr.select((F.col("pos") - 1).alias("pos"), (F.col("value") - 1).alias("high"))
    bounds = indptr.select("pos", F.col("value").alias("low")).join(upper, "pos")
    places = spell_range(bounds, "low", "high", "at").select(
        F.col("pos").cast("bigint").alias("src"), F.col("at").alias("pos")
    )
    return places.join(entries, "pos").select(
        "src", F.col("index").cast("bigint").alias("dst"), F.col("data").cast("double").alias("w")
    )


def edges_from_neighbor_lists(lists: DataFrame) -> DataFrame:
    """``(id, neighbors[])``; every listed neighbour is one edge of weight 1."""
    return lists.select(
        F.col("id").cast("bigint").alias("src"),
        F.explode(F.col("neighbors").cast("array<bigint>")).alias("dst"),
        F.lit(1.0).alias("w"),
    )


def edges_of_layout(tables: dict[str, DataFrame]) -> DataFrame:
    """Edges from whichever layout the named tables form; any other set is an error.

    ``{"coo"}`` with columns row and col; ``{"indptr", "entries"}``;
    ``{"rows"}`` with id, indices and data; ``{"lists"}`` with id and neighbors.
    """
    wanted = {
        "coo": {"row", "col"},
        "rows": {"id", "indices", "data"},
        "lists": {"id", "neighbors"},
        "indptr": {"pos", "value"},
        "entries": {"pos", "index", "data"},
    }
    for name, table in tables.items():
        if name not in wanted or not wanted[name] <= set(table.columns):
            raise ValueError(f"unknown edge layout: {name}({', '.join(table.columns)})")
    names = set(tables)
    if names == {"coo"}:
        return edges_coo(tables["coo"])
    if names == {"rows"}:
        return edges_from_csr_rows(tables["rows"])
    if names == {"lists"}:
        return edges_from_neighbor_lists(tables["lists"])
    if names == {"indptr", "entries"}:
        return edges_from_csr_vectors(tables["indptr"], tables["entries"])
    raise ValueError(f"unknown edge layout: {sorted(names)}")
