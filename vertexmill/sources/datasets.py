"""Graphs by name, prepared the same way whatever their storage layout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexmill.operators.prepare import (
    clip_edges,
    edges_in_range,
    normalize_edges,
    standardize,
    symmetrize,
)
from vertexmill.sources.edges import (
    edges_from_neighbor_lists,
    edges_of_layout,
    read_if_there,
    read_table,
)
from vertexmill.sources.karate import INSTRUCTOR, MEMBERS, karate_tables
from vertexmill.sources.nodes import (
    citation_blocks,
    citation_nodes,
    labelled_graph_nodes,
    load_nodes,
    read_test_index,
    with_identity_features,
)

#: The known data sets by layout, and the one with gaps in its test ids.
ATTRIBUTED = ("reddit",)
CITATION = ("pubmed", "cora", "citeseer")
WITH_GAPS = ("citeseer",)
SMALL = ("karate",)


@dataclass
class Graph:
    """``nodes`` as in ``schema.NODES``; ``raw_edges`` as read; ``edges`` as the model wants them."""

    name: str
    nodes: DataFrame
    raw_edges: DataFrame
    edges: DataFrame


def prepare_graph(
    name: str, nodes: DataFrame, raw_edges: DataFrame, normalize: bool = True
) -> Graph:
    """Standardise features and normalise edges, or only symmetrise and clip."""
    if normalize:
        return Graph(name, standardize(nodes), raw_edges, normalize_edges(raw_edges, nodes))
    return Graph(name, nodes, raw_edges, clip_edges(symmetrize(raw_edges)))


def load_graph(
    spark: SparkSession,
    name: str,
    root: str | None = None,
    normalize: bool = True,
    order: str = "file",
) -> Graph:
    """Load a data set by name. Tables live below ``root``:

    attributed: ``nodes`` (id, feature, label, node_types) and one edge layout
    of ``coo``, ``rows``, ``lists`` or ``indptr`` + ``entries``;
    citation: ``x y tx ty allx ally`` (row_pos, vec), ``graph`` (id, neighbors)
    and the text listing ``test.index``, whose ids take the test rows as listed
    (``order="file"``) or ascending (``"sorted"``); the karate club needs no files.
    """
    name = name.lower()
    if name in SMALL:
        members, friends = karate_tables(spark)
        nodes = with_identity_features(labelled_graph_nodes(members, INSTRUCTOR), MEMBERS)
        return prepare_graph(name, nodes, friends, normalize)
    if root is None:
        raise ValueError(f"{name} is read from files: give root")
    if name in CITATION:
        return prepare_graph(name, *load_citation(spark, root, name, order), normalize)
    if name in ATTRIBUTED:
        return prepare_graph(name, *load_attributed(spark, root), normalize)
    raise ValueError(f"unknown data set: {name}")


def load_attributed(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    found = {}
    for name in ("coo", "rows", "lists", "indptr", "entries"):
        table = read_if_there(spark.read.parquet, f"{root}/{name}")
        if table is not None:
            found[name] = table
    return load_nodes(read_table(spark, f"{root}/nodes")), edges_of_layout(found)


def load_citation(
    spark: SparkSession, root: str, name: str, order: str = "file"
) -> tuple[DataFrame, DataFrame]:
    blocks = citation_blocks(spark, root)
    index = read_test_index(spark, f"{root}/test.index")
    widths = blocks["allx"].join(
        blocks["ally"].select("row_pos", F.col("vec").alias("hot")), "row_pos"
    ).select(F.size("vec").alias("f"), F.size("hot").alias("c")).first()
    nodes = citation_nodes(
        blocks, index, order, fill_gaps=name in WITH_GAPS,
        feature_width=widths["f"], class_width=widths["c"],
    )
    lists = spark.read.parquet(f"{root}/graph")
    return nodes, edges_in_range(edges_from_neighbor_lists(lists), nodes)


load_reddit = lambda spark, root, normalize=True: load_graph(spark, "reddit", root, normalize)
load_pubmed = lambda spark, root, normalize=True: load_graph(spark, "pubmed", root, normalize)
load_cora = lambda spark, root, normalize=True: load_graph(spark, "cora", root, normalize)
load_karate = lambda spark, normalize=True: load_graph(spark, "karate", None, normalize)
