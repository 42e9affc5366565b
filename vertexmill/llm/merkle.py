"""Merkle manifest of a table, its proofs gathered by a butterfly exchange.

Rows are leaves. The leaves of a group, in order, make a tree of ``fanout`` children a
node; the roots of the groups, in order, make the tree above. A digest is the lowercase
hex SHA-256 of what it covers, digests as text.

1. Leaves get their exact place in their group: a range sort, and the lengths of the
   sorted files. Aligned runs of ``fanout ** chunk_levels`` leaves are chunks.
2. A task builds the subtree of a chunk.
3. The butterfly: in each round the chunks below ``fanout`` sibling nodes swap these
   nodes' digests, one chunk with one partner from each sibling, and every chunk hashes
   the parent by itself. So each chunk knows all its ancestors and their siblings after
   as many rounds as there are levels, and no digest travels down. A sibling with fewer
   chunks than another lets its chunks stand in for the missing partners.
4. The same rounds go on over the groups, up to the root.
5. Leaves and the upper proof of their chunk meet by the chunk, whose size is fixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vertexmill.llm.tables import in_sorted_groups, join_by, sorted_runs, written
from vertexmill.runtime import drop_written, with_position, with_total_before

#: Children of a node, and levels of the tree that one task builds below a chunk's root.
FANOUT, CHUNK_LEVELS = 8, 4

#: Rounds of the exchange after which its state is written, so that plans stay short.
WRITE_EVERY = 3

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The columns of ``documents`` that its leaves cover, in order.
DOCUMENT_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]

CHUNK = ["g", "chunk", "chunks"]
_STEP = "struct<at:int,siblings:array<string>>"
_STATE = ["g", "chunk", "chunks", "node", "above", "subroot"]


def digest(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def encoded(column: Column) -> Column:
    """``-`` for null, else the length of the value's UTF-8 bytes, a colon, and the value."""
    value = column.cast("string")
    sized = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
    return F.coalesce(sized, F.lit("-"))


def leaf_digest(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(c) for c in columns]).cast("binary"), 256)


# ------------------------------------------------------------------ places and chunks


def _placed(leaves: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sorted leaves with their ``place`` in their group, groups ``(g, rows)``, and the table below both.

    Leaves ascend by ``k`` (null first), equal ones by what they are.
    """
    order = [F.col(c).asc_nulls_first() for c in ("g", "k", "leaf", "shown")]
    table = written(leaves.sort(*order), "merkle-sorted")
    placed, sizes = sorted_runs(table, "g")
    return placed, sizes, table


def levels(nodes: list[str], fanout: int, most: int | None) -> list[list[str]]:
    """All levels from ``nodes`` up: to a single node, or ``most`` levels above them."""
    out = [nodes]
    while len(out[-1]) > 1 if most is None else len(out) <= most:
        below = out[-1]
        out.append([digest(below[at : at + fanout]) for at in range(0, len(below), fanout)])
    return out


def _chunk_roots(leaves: DataFrame, fanout: int, chunk_levels: int) -> DataFrame:
    """``(g, chunk, chunks, node)``: the root of every chunk's subtree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (g, chunk, chunks), rows in in_sorted_groups(batches, CHUNK, ["leaf"]):
            top = levels(rows["leaf"], fanout, None if chunks == 1 else chunk_levels)[-1][0]
            yield pa.RecordBatch.from_pydict(
                {
                    "g": pa.array([g], pa.string()),
                    "chunk": pa.array([chunk], pa.int64()),
                    "chunks": pa.array([chunks], pa.int64()),
                    "node": pa.array([top], pa.string()),
                }
            )

    sorted_rows = leaves.select("g", "chunk", "chunks", "place", "leaf").repartition("g", "chunk")
    sorted_rows = sorted_rows.sortWithinPartitions("g", "chunk", "place")
    return sorted_rows.mapInArrow(run, "g string, chunk bigint, chunks bigint, node string")


# ------------------------------------------------------------------ the exchange


def _swap(state: DataFrame) -> DataFrame:
    """One round over rows with ``top, digit, slot, size, most`` beside their state.

    ``top`` names the parent, ``digit`` the row's node among its children, ``slot`` the
    row among the ``size`` rows below that node; ``most`` is the largest such size among
    the siblings. A row meets the rows of the same slot below the other siblings, and
    stands in for the slots ``slot + size, slot + 2 * size, ...`` below ``most``.
    """
    sent = state.withColumn("meets", F.explode(F.sequence("slot", F.col("most") - 1, "size")))
    own = F.when(F.col("meets") == F.col("slot"), F.struct(*_STATE))
    met = sent.groupBy("top", "meets").agg(F.sort_array(F.collect_list(F.struct("digit", "node", own.alias("row")))).alias("all"))
    parent = F.sha2(F.array_join(F.transform("all", lambda x: x["node"]), "").cast("binary"), 256)
    mine = met.select(parent.alias("parent"), "all", F.explode(F.filter("all", lambda x: x["row"].isNotNull())).alias("me"))
    others = F.transform(F.filter("all", lambda x: x["digit"] != F.col("me.digit")), lambda x: x["node"])
    step = F.struct(F.col("me.digit").cast("int").alias("at"), others.alias("siblings")).cast(_STEP)
    kept = [F.col(f"me.row.{c}").alias(c) for c in ("g", "chunk", "chunks", "subroot")]
    return mine.select(*kept, F.col("parent").alias("node"), F.concat("me.row.above", F.array(step)).alias("above"))


def exchange(chunks: DataFrame, groups: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``(g, chunk, chunks, above, subroot, root)`` of every chunk.

    ``chunks`` has the ``node`` of each chunk. ``groups`` has, of each group, how many
    ``chunks`` it has, its ``index`` in order, and the chunks of all groups ``before`` it.
    ``above`` lists the levels over the chunk, lowest first: the place ``at`` of its node
    in the run, and the digests of the run's others from left to right.
    """
    state = chunks.select(
        "g", "chunk", "chunks", "node", F.array().cast(f"array<{_STEP}>").alias("above"), F.lit(None).cast("string").alias("subroot")
    )
    most, count = groups.agg(F.max("chunks"), F.count("*")).first()
    rounds, width = 0, 1

    def cut(state: DataFrame) -> DataFrame:
        return written(state, "merkle-round") if rounds % WRITE_EVERY == 0 else state

    while width < (most or 0):
        run = width * fanout
        going = state.filter(F.col("chunks") > width)
        going = going.withColumn("first", F.expr(f"(chunk div {run}) * {run}"))
        going = going.withColumn("digit", F.expr(f"(chunk - first) div {width}"))
        going = going.withColumn("start", F.expr(f"first + digit * {width}"))
        going = going.withColumns(
            {
                "slot": F.col("chunk") - F.col("start"),
                "size": F.least(F.lit(width).cast("bigint"), F.col("chunks") - F.col("start")),
                "most": F.least(F.lit(width).cast("bigint"), F.col("chunks") - F.col("first")),
                "top": F.struct("g", "first"),
            }
        )
        rounds, width = rounds + 1, run
        state = cut(_swap(going).unionByName(state.filter(F.col("chunks") <= run // fanout)))
    state = state.withColumn("subroot", F.col("node"))
    width = 1
    while width < count:
        nodes = groups.select("*", F.expr(f"index div {width}").alias("of"), F.expr(f"index div {width * fanout}").alias("top"))
        sizes = nodes.groupBy("top", "of").agg(F.sum("chunks").alias("size"), F.min("before").alias("start"))
        sizes = sizes.join(sizes.groupBy("top").agg(F.max("size").alias("most")), "top").drop("top")
        places = nodes.drop("chunks").join(sizes, "of").select(
            "g", "top", (F.col("of") - F.col("top") * fanout).alias("digit"),
            "size", "most", (F.col("before") - F.col("start")).alias("ahead"),
        )
        going = join_by(state, written(places, "merkle-places"), ["g"], "inner", spread="chunk")
        rounds, width = rounds + 1, width * fanout
        state = cut(_swap(going.withColumn("slot", F.col("chunk") + F.col("ahead")).drop("ahead")))
    return state.withColumnRenamed("node", "root")


# ------------------------------------------------------------------ proofs of the leaves


def _without(run: list[str], at: int) -> str:
    return "".join(run[:at]) + "".join(run[at + 1 :])


def _proofs(fanout: int, chunk_levels: int, full: bool):
    """Proofs and checks of a chunk's leaves; its first row brings what lies above the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["k", "leaf", "shown", "above", "subroot", "root"]
        for (_, _, chunks), rows in in_sorted_groups(batches, CHUNK, names):
            above, subroot, root = rows["above"][0], rows["subroot"][0], rows["root"][0]
            leaves, shown = rows["leaf"][1:], rows["shown"][1:]
            tree = levels(leaves, fanout, None if chunks == 1 else chunk_levels)
            upper = "".join("".join(step["siblings"]) for step in above)
            out: dict[str, list] = {"proof_sha256": [], "folded_root": [], "proof": []}
            for place, leaf in enumerate(leaves):
                node, at, siblings, steps = shown[place] or leaf, place, [], []
                for level in tree[:-1]:
                    first = at - at % fanout
                    run_of = level[first : first + fanout]
                    own = at - first
                    siblings.append(_without(run_of, own))
                    if full:
                        steps.append({"at": own, "siblings": run_of[:own] + run_of[own + 1 :]})
                    run_of[own] = node
                    node, at = digest(run_of), at // fanout
                for step in above:
                    others = step["siblings"]
                    node = digest([*others[: step["at"]], node, *others[step["at"] :]])
                out["proof_sha256"].append(digest([*siblings, upper]))
                out["folded_root"].append(node)
                out["proof"].append(steps + above if full else None)
            yield pa.RecordBatch.from_pydict(
                {
                    "k": pa.array(rows["k"][1:], pa.int64()),
                    "leaf": leaves,
                    "subroot": [subroot] * len(leaves),
                    "root": [root] * len(leaves),
                    "proof_sha256": out["proof_sha256"],
                    "folded_root": out["folded_root"],
                    "verified": [node == root for node in out["folded_root"]],
                    "proof": pa.array(
                        out["proof"], pa.list_(pa.struct([("at", pa.int32()), ("siblings", pa.list_(pa.string()))]))
                    ),
                }
            )

    return run


def manifest(
    docs: DataFrame,
    columns: list[str] = DOCUMENT_COLUMNS,
    group: str = "lang",
    key: str = "doc_id",
    shown: dict[str, Column] | None = None,
    full: bool = True,
    fanout: int = FANOUT,
    chunk_levels: int = CHUNK_LEVELS,
) -> DataFrame:
    """``(<key>, leaf, subroot, root, proof_sha256, folded_root, verified, proof)`` for every row of ``docs``.

    ``proof`` (null unless ``full``) lists the levels from the leaf up: its node's place ``at``
    in the run and the digests of the run's others. ``shown`` replaces columns by what
    is shown for checking; ``folded_root`` follows from the leaf so shown (else the row's
    own) and the proof, ``verified`` tells whether it is the root.

    Nulls count as ``-``; a null ``group`` is the first group, null keys come first; rows
    with equal keys are leaves in the order of their digests, and equal rows a leaf each.
    An empty table gives no rows. Texts are hashed whole, in one pass. Columns not named
    are not looked at.
    """
    given = {c: F.col(c) for c in columns}
    leaf = leaf_digest(list(given.values()))
    other = leaf_digest(list((given | (shown or {})).values()))
    leaves = docs.select(
        F.col(group).cast("string").alias("g"), F.col(key).cast("bigint").alias("k"), leaf.alias("leaf"),
        (F.nullif(other, leaf) if shown else F.lit(None).cast("string")).alias("shown"),
    )
    hashed = written(leaves, "merkle-leaves")
    placed, sizes, table = _placed(hashed)
    in_chunk = fanout**chunk_levels
    groups = sizes.select("g", F.expr(f"(rows + {in_chunk - 1}) div {in_chunk}").alias("chunks"))
    groups = written(with_total_before(with_position(groups, "g", name="index"), "g", "chunks", "before"), "merkle-groups")
    chunked = placed.withColumn("chunk", F.expr(f"place div {in_chunk}"))
    rows = written(join_by(chunked, groups.select("g", "chunks"), ["g"], "inner", spread="place"), "merkle-placed")
    drop_written(hashed, table)
    above = exchange(_chunk_roots(rows, fanout, chunk_levels), groups, fanout)
    heads = above.withColumn("place", F.lit(-1).cast("bigint"))
    both = rows.unionByName(heads, allowMissingColumns=True)
    both = both.repartition("g", "chunk").sortWithinPartitions("g", "chunk", "place")
    out = both.mapInArrow(
        _proofs(fanout, chunk_levels, full),
        "k bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string,"
        f" verified boolean, proof array<{_STEP}>",
    )
    return out.withColumnRenamed("k", key)


def tampered_documents(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents``, checked against rows some of which were changed.

    Where 3 divides the CRC-32 of the decimal doc_id, the text shown has its ``A-Z`` in
    lower case; texts without any, and nulls, are as they were. A null doc_id is never changed.
    """
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    text = F.col("text").cast("string")
    shown = F.when(hit, F.translate(text, UPPER, LOWER)).otherwise(text)
    return manifest(docs, shown={"text": shown}, full=False).drop("proof")
