"""Graphs and run tables derived from the given tables, whole at every scale."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexmill.operators.local import local_edges
from vertexmill.operators.messages import SpreadEdges
from vertexmill.operators.prepare import (
    clip_edges,
    normalize_and_spread,
    split_masks,
    standardize,
    symmetrize,
)
from vertexmill.runtime import with_position, with_total_before, written

Made = TypeVar("Made")


def once(make: Callable[[SparkSession, str], Made]) -> Callable[[SparkSession, str], Made]:
    """Prepared graphs are written once per session and serve all model queries."""
    return cache(make)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def node_count(spark: SparkSession, folder: str) -> Column:
    return table(spark, folder, "embeddings").agg(F.count("*")).scalar()


def plain_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes as a source would hold them: id, feature, label, split code."""
    place = F.col("vec_id") % 10
    code = F.when(place < 6, 1).when(place < 8, 2).otherwise(3)
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").alias("feature"),
        "label",
        code.alias("node_types"),
    )


def nodes(spark: SparkSession, folder: str) -> DataFrame:
    rows = plain_nodes(spark, folder).select(
        "id",
        F.col("feature").cast("array<double>").alias("features"),
        F.col("label").cast("bigint").alias("label"),
        F.col("node_types").cast("bigint").alias("node_type"),
    )
    return split_masks(rows)


@once
def scaled_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return written(standardize(nodes(spark, folder)), "nodes")


def features(rows: DataFrame) -> DataFrame:
    return rows.select("id", F.col("features").alias("vec"))


def raw_edges(spark: SparkSession, folder: str) -> DataFrame:
    n = node_count(spark, folder)
    return table(spark, folder, "orders").select(
        (F.col("o_custkey") % n).alias("src"),
        (F.col("o_orderkey") % n).alias("dst"),
        F.lit(1.0).alias("w"),
    )


def edges(spark: SparkSession, folder: str) -> DataFrame:
    """Symmetrised and clipped."""
    return clip_edges(symmetrize(raw_edges(spark, folder)))


@once
def norm_edges(spark: SparkSession, folder: str) -> SpreadEdges:
    return normalize_and_spread(raw_edges(spark, folder), nodes(spark, folder))


#: Parts of the partition queries.
PARTS = 4


@once
def part_edges(spark: SparkSession, folder: str) -> SpreadEdges:
    whole = norm_edges(spark, folder).table
    return local_edges(whole, nodes(spark, folder), PARTS)


def run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Events read as epoch rows. Forward, backward and update times are left out."""
    kind = F.col("event_type")
    config = (
        F.when(kind == "view", "sequential")
        .when(kind == "click", "spark_4")
        .when(kind == "purchase", "spark_8")
        .when(kind == "signup", "spark_16")
        .when(kind == "error", "spark_2")
    )
    number = F.col("event_id")
    return table(spark, folder, "events").select(
        config.alias("config"),
        (F.col("user_id") % 3 + 1).cast("int").alias("run"),
        number.cast("int").alias("epoch"),
        (F.col("value") + 1).alias("epoch_time"),
        F.when(config == "sequential", 0.0).otherwise(F.col("value") / 10).alias("comm_time"),
        (4 - (number % 83) / 100).alias("loss"),
        ((number % 79) / 100).alias("train_acc"),
        ((number % 89) / 100).alias("val_f1"),
        ((number % 97) / 100).alias("test_f1"),
        F.lit(512.0).alias("peak_memory_mb"),
    )


# ---------------------------------------------------------------- storage layouts


def csr_vectors(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """``indptr(pos, value)`` and ``entries(pos, index, data)`` of the edge table."""
    placed = with_position(edges(spark, folder), "src", "dst")
    entries = placed.select("pos", F.col("dst").alias("index"), F.col("w").alias("data"))
    rows = nodes(spark, folder).select("id")
    beyond = rows.agg((F.max("id") + 1).alias("id"))
    sizes = placed.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("n"))
    counted = rows.unionByName(beyond).join(sizes, "id", "left").fillna(0, ["n"])
    indptr = with_total_before(counted, "id", "n", "value")
    return indptr.select(F.col("id").alias("pos"), "value"), entries


#: Targets per neighbour list piece, so no list grows with a vertex's degree.
LIST_SPAN = 4096


def neighbor_lists(spark: SparkSession, folder: str) -> DataFrame:
    """``(id, neighbors[])``, in pieces by target range."""
    span = F.floor(F.col("dst") / LIST_SPAN)
    return (
        edges(spark, folder)
        .groupBy(F.col("src").alias("id"), span.alias("span"))
        .agg(F.collect_list("dst").alias("neighbors"))
        .select("id", "neighbors")
    )


def citation(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Citation blocks and the test listing ``(line, id)``.

    The first 80 % of the ids are ``allx``, the first 60 % ``x``, the rest
    ``tx``; test ids are listed in the order of ``id * 37 % n``.
    """
    n = node_count(spark, folder)
    n_known, n_train = (n * 8 / 10).cast("bigint"), (n * 6 / 10).cast("bigint")
    hot = F.transform(
        F.sequence(F.lit(0), F.lit(9)), lambda c: (c == F.col("label")).cast("double")
    )
    rows = nodes(spark, folder).select(
        "id", "features", hot.alias("onehot"), n_known.alias("n_known"), n_train.alias("n_train")
    )
    known = rows.filter("id < n_known").withColumn("row_pos", F.col("id"))
    tested = rows.filter("id >= n_known").withColumn("row_pos", F.col("id") - F.col("n_known"))
    first = known.filter("id < n_train")
    blocks = {}
    for name, part in (("x", first), ("tx", tested), ("allx", known)):
        blocks[name] = part.select("row_pos", F.col("features").alias("vec"))
        blocks[name[:-1] + "y"] = part.select("row_pos", F.col("onehot").alias("vec"))
    keyed = tested.select("id", ((F.col("id") * 37) % n).alias("key"))
    index = with_position(keyed, "key", name="line").select("line", "id")
    return blocks, index
