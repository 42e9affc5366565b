"""Node sources: attributed nodes, citation blocks, test id lists, small labelled graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexmill.operators.prepare import (
    align_test_rows,
    category_label,
    densify,
    gap_fill,
    identity_triples,
    onehot_argmax,
    split_masks,
    split_positional,
    split_random,
    stack_blocks,
)
from vertexmill.runtime import with_position

#: The blocks of a citation data set. x, tx and allx hold feature
#: rows, y, ty and ally the one-hot labels of the same rows.
CITATION_BLOCKS = ("x", "y", "tx", "ty", "allx", "ally")

#: Fixed value: rows after the training rows that form the validation split.
CITATION_VAL = 500


def load_nodes(
    table: DataFrame, features: str = "feature", label: str = "label", code: str = "node_types"
) -> DataFrame:
    """Nodes with explicit types and split masks. ``table`` needs an ``id`` column.

    A vector that is null or holds a null is an error.
    """
    vector = F.col(features).cast("array<double>")
    broken = vector.isNull() | F.exists(vector, lambda x: x.isNull())
    message = F.concat(F.lit("null in the features of node "), F.col("id").cast("string"))
    typed = table.select(
        F.col("id").cast("bigint").alias("id"),
        F.when(broken, F.raise_error(message).cast("array<double>")).otherwise(vector).alias("features"),
        F.col(label).cast("bigint").alias("label"),
        F.col(code).cast("bigint").alias("node_type"),
    )
    return split_masks(typed)


def citation_blocks(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The six blocks as ``(row_pos, vec)`` tables below ``root``."""
    return {
        name: spark.read.parquet(f"{root}/{name}").select(
            F.col("row_pos").cast("bigint").alias("row_pos"),
            F.col("vec").cast("array<double>").alias("vec"),
        )
        for name in CITATION_BLOCKS
    }


def read_test_index(spark: SparkSession, path: str) -> DataFrame:
    """``(line, id)`` of a listing: text with one id per line, or ``line<TAB>id``.

    Plain lines are numbered from 0 in the order of the file, blank ones left
    out: by the place of a split in its file and of a row in its split, since
    Spark keeps the order inside a split only. Several files follow each other
    by name.
    """
    field = F.split(F.trim("value"), "\t")
    rows = (
        spark.read.text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("row"),
        )
        .filter(F.trim("value") != "")
        .select(
            "file", "start", "row",
            F.when(F.size(field) > 1, field[0]).cast("bigint").alias("told"),
            F.element_at(field, -1).cast("bigint").alias("id"),
        )
    )
    placed = with_position(rows, "file", "start", "row")
    return placed.select(F.coalesce("told", "pos").alias("line"), "id")


def write_test_index(index: DataFrame, path: str) -> None:
    index.select(F.concat_ws("\t", "line", "id").alias("value")).write.mode("overwrite").text(path)


def join_block(blocks: dict[str, DataFrame], features: str, onehot: str) -> DataFrame:
    """Feature and label rows of a block side by side."""
    labels = blocks[onehot].select("row_pos", F.col("vec").alias("onehot"))
    return blocks[features].select("row_pos", F.col("vec").alias("features")).join(labels, "row_pos")


def citation_nodes(
    blocks: dict[str, DataFrame],
    test_index: DataFrame,
    order: str = "file",
    fill_gaps: bool = False,
    feature_width: int | None = None,
    class_width: int | None = None,
) -> DataFrame:
    """Stack the blocks, put test rows at their ids, label and split them.

    ``fill_gaps`` adds zero rows for ids missing between the smallest and the
    largest test id, and needs both widths.
    """
    known = join_block(blocks, "allx", "ally")
    tested = join_block(blocks, "tx", "ty")
    below = tested
    if fill_gaps:
        listed = _numbered(test_index, order).join(tested, "row_pos").drop("row_pos")
        below = gap_fill(listed, feature_width, class_width).select(
            "row_pos", "features", "onehot"
        )
    stacked = stack_blocks(known, below)
    # ascending order reads the block as stacked, gaps included
    source = below if order == "sorted" else tested
    aligned = align_test_rows(stacked, source, test_index, order)
    labelled = aligned.select("id", "features", onehot_argmax(F.col("onehot")).alias("label"))
    n_train = blocks["x"].agg(F.count("*")).scalar()
    return split_positional(labelled, n_train, test_index, CITATION_VAL)


def _numbered(test_index: DataFrame, order: str) -> DataFrame:
    if order == "file":
        return test_index.select(F.col("line").alias("row_pos"), "id")
    return with_position(test_index.select("id"), "id", name="row_pos")


def labelled_graph_nodes(table: DataFrame, first: str, seed: int = 42) -> DataFrame:
    """Nodes of a small labelled graph: ``(id, category)`` to labels and a 60/20/20 split.

    Features are the identity; they come as ``(id, col, val)`` from
    :func:`vertexmill.operators.prepare.identity_triples`, or dense with
    :func:`with_identity_features`.
    """
    typed = table.select(
        F.col("id").cast("bigint").alias("id"),
        category_label(F.col("category"), first).alias("label"),
    )
    return split_random(typed, seed)


def with_identity_features(nodes: DataFrame, size: int) -> DataFrame:
    """Dense identity features: quadratic in the node count, so for small graphs."""
    dense = densify(identity_triples(nodes), size)
    return nodes.join(dense.withColumnRenamed("vec", "features"), "id")
