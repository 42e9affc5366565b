"""Near duplicates: fast similarity sketches, banding, exact confirmation, components.

A document's set is its distinct word shingles. Documents with equal sets are
one class, found by a 128-bit hash of the set; only class representatives are
compared. Classes that agree in a band meet in a bucket. Buckets are never
expanded into all their pairs:

1. sorted by the coordinates after the band, neighbours in a bucket are paired
   (as many pairs as rows, in range partitions that split a hot bucket);
2. pairs that can be similar by their sketches are confirmed on the full sets,
   and confirmed links are joined to components;
3. only rows outside the largest component of their bucket are then compared
   with the rest of it, by sketch and then on the full sets, inside the tasks.

So every pair that shares a band is either in one component already or compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vertexmill.llm import text
from vertexmill.llm.tables import join_by, written
from vertexmill.llm.text import fold, mix64

#: Coordinates of a sketch, as bands of so many rows. Two documents of similarity
#: 0.85 share no band with a probability of 6e-11, of 0.8 with 5e-8.
BANDS, ROWS = 32, 4
SIZE = BANDS * ROWS

#: Standard errors that a sketch's estimate may lie below the threshold.
ERRORS = 4.75

#: Rows of a bucket outside its main component, and of all its rows, in one task's block.
OUTER, INNER = 256, 1024

#: Links that one task contracts before they are shuffled.
LINKS = 200_000

#: Pairs whose values one join key brings together.
PIECE = 256

_BIN_SHIFT = np.uint64(57)  # the top 7 bits choose one of 128 bins
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def sketch(rows: np.ndarray, grams: np.ndarray, count: int) -> np.ndarray:
    """Fast similarity sketches, one row of ``SIZE`` 64-bit coordinates each; every row has grams.

    ``rows`` is sorted. In round ``i`` every element falls into a bin by its hash;
    a bin keeps the least element of the first round that fills it. From round
    ``SIZE`` on all elements fall into one given bin, so no coordinate stays empty.
    Later rounds work on the rows with empty bins only.
    """
    out = np.full(count * SIZE, _EMPTY, dtype=np.uint64)
    for i in range(2 * SIZE):
        value = mix64(grams + fold(np.array([i], dtype=np.uint64), np.array([7], dtype=np.uint64)))
        if i < SIZE:
            at = rows * SIZE + (value >> _BIN_SHIFT).astype(np.int64)
        else:
            at = rows * SIZE + (i - SIZE)
        if i:
            free = out[at] == _EMPTY
            at, value = at[free], value[free]
        np.minimum.at(out, at, value)
        open_rows = (out.reshape(count, SIZE) == _EMPTY).any(axis=1)
        if not open_rows.any():
            break
        keep = open_rows[rows]
        rows, grams = rows[keep], grams[keep]
    return out.reshape(count, SIZE)


def _sketch_batches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.chunks(batches):
            found = text.words(batch.column("text"))
            rows, grams = text.shingles(found, found.hashes(), width)
            n = np.bincount(rows, minlength=batch.num_rows)
            full = np.flatnonzero(n)
            a = np.zeros(batch.num_rows, dtype=np.uint64)
            b = np.zeros(batch.num_rows, dtype=np.uint64)
            lines = [None] * batch.num_rows
            if len(full):
                begin = (np.cumsum(n) - n)[full]
                a[full] = np.add.reduceat(mix64(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5)), begin)
                b[full] = np.add.reduceat(mix64(grams + np.uint64(0x5BD1E9955BD1E995)), begin)
                place = np.cumsum(n > 0) - 1
                made = sketch(place[rows], grams, len(full))
                small = (mix64(made) >> np.uint64(32)).astype("<u4")
                for k, row in enumerate(full):
                    lines[row] = small[k].tobytes()
            empty = n == 0
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "n_shingles": pa.array(n.astype(np.int64)),
                    "a": pa.array(a.astype(np.int64), mask=empty),
                    "b": pa.array(b.astype(np.int64), mask=empty),
                    "sketch": pa.array(lines, type=pa.binary()),
                }
            )

    return run


SKETCHES = "doc_id bigint, n_shingles bigint, a bigint, b bigint, sketch binary"


def sketches(docs: DataFrame, width: int = 5) -> DataFrame:
    """Set size, set hash ``(a, b)`` and sketch of every document; null without words."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(_sketch_batches(width), SKETCHES)


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    data, _ = text.raw_bytes(column)
    return data.view("<u4").reshape(len(column), SIZE)


def _band_keys(coords: np.ndarray) -> np.ndarray:
    """A 64-bit key per band; its low 5 bits are the band's number."""
    parts = coords.reshape(len(coords), BANDS, ROWS).astype(np.uint64)
    out = parts[:, :, 0].copy()
    for k in range(1, ROWS):
        out = fold(out, parts[:, :, k])
    return (out & ~np.uint64(31)) | np.arange(BANDS, dtype=np.uint64)


def _explode_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(key, sig, node)`` per band; ``sig`` are pieces of the coordinates of the next band."""
    for batch in batches:
        if not batch.num_rows:
            continue
        coords = _matrix(batch.column("sketch"))
        keys = _band_keys(coords)
        after = np.roll(coords.reshape(len(coords), BANDS, ROWS), -1, axis=1).astype(np.uint64) & np.uint64(0xFFFF)
        sig = np.zeros(keys.shape, dtype=np.uint64)
        for k in range(ROWS):
            sig = (sig << np.uint64(16)) | after[:, :, k]
        nodes = np.repeat(batch.column("node").to_numpy(), BANDS)
        yield pa.RecordBatch.from_pydict(
            {
                "key": pa.array(keys.reshape(-1).view(np.int64)),
                "sig": pa.array(sig.reshape(-1).view(np.int64)),
                "node": pa.array(nodes),
            }
        )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of sorted buckets with the row before; buckets of one row are left out.

    At the edges of a partition a bucket may go on in the next one, so the first
    and the last bucket stay whatever their size here.
    """
    held_key = held_node = None  # the last row so far, not given out yet
    held_prev, held_keep = None, True
    first_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, node = batch.column("key").to_numpy(), batch.column("node").to_numpy()
        if first_key is None:
            first_key = key[0]
        same = np.zeros(len(key), dtype=bool)
        same[1:] = key[1:] == key[:-1]
        before = np.concatenate([[0], node[:-1]])
        if held_key is not None:
            same[0] = key[0] == held_key
            before[0] = held_node
        keep = same.copy()
        keep[:-1] |= same[1:]
        keep |= key == first_key
        out_key, out_node = key[:-1][keep[:-1]], node[:-1][keep[:-1]]
        out_same, out_before = same[:-1][keep[:-1]], before[:-1][keep[:-1]]
        if held_key is not None and (held_keep or same[0]):
            out_key = np.concatenate([[held_key], out_key])
            out_node = np.concatenate([[held_node], out_node])
            out_same = np.concatenate([[held_prev is not None], out_same])
            out_before = np.concatenate([[held_prev or 0], out_before])
        held_key, held_node = key[-1], node[-1]
        held_prev = before[-1] if same[-1] else None
        held_keep = bool(keep[-1])
        if len(out_key):
            yield _bucket_rows(out_key, out_node, out_before, out_same)
    if held_key is not None:
        yield _bucket_rows(
            np.array([held_key]), np.array([held_node]), np.array([held_prev or 0]), np.array([held_prev is not None])
        )


def _bucket_rows(key, node, before, same) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "key": pa.array(key.astype(np.int64)),
            "node": pa.array(node.astype(np.int64)),
            "prev": pa.array(before.astype(np.int64), mask=~np.asarray(same, dtype=bool)),
        }
    )


def buckets(nodes: DataFrame) -> DataFrame:
    """``(key, node, prev)``: buckets of more than one row, each row with its neighbour."""
    exploded = nodes.select("node", "sketch").mapInArrow(
        _explode_bands, "key bigint, sig bigint, node bigint"
    )
    return (
        exploded.repartitionByRange("key", "sig", "node")
        .sortWithinPartitions("key", "sig", "node")
        .mapInArrow(_neighbours, "key bigint, node bigint, prev bigint")
    )


def with_values(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """``(a, b, va, vb)`` for ``pairs(a, b)`` and ``values(node, v)``.

    A node of many pairs has its value copied to as many join keys as it has
    ``PIECE`` pairs, so no task gets more than its share of a hot node.
    """
    ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node")))
    hot = written(
        ends.groupBy("node")
        .agg(F.ceil(F.count("*") / F.lit(PIECE)).cast("int").alias("pieces"))
        .filter("pieces > 1"),
        "hot-nodes",
    )
    copies = join_by(values, hot, ["node"]).withColumn(
        "piece", F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1))
    )

    def placed(rows: DataFrame, end: str, other: str) -> DataFrame:
        known = join_by(rows, hot.withColumnRenamed("node", end), [end], spread=other)
        piece = F.coalesce(F.pmod(F.xxhash64(other), F.col("pieces")), F.lit(0)).cast("int")
        return known.withColumn("piece", piece).drop("pieces")

    left = copies.select(F.col("node").alias("a"), "piece", F.col("v").alias("va"))
    right = copies.select(F.col("node").alias("b"), "piece", F.col("v").alias("vb"))
    one = placed(pairs, "a", "b").join(left, ["a", "piece"]).drop("piece")
    return placed(one, "b", "a").join(right, ["b", "piece"]).select("a", "b", "va", "vb")


def _estimate(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                equal = (_matrix(batch.column("va")) == _matrix(batch.column("vb"))).sum(axis=1)
                yield batch.select(["a", "b"]).filter(pa.array(equal >= least))

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                similar(
                    np.frombuffer(left.as_buffer(), dtype=np.uint64),
                    np.frombuffer(right.as_buffer(), dtype=np.uint64),
                    percent,
                )
                for left, right in zip(batch.column("va"), batch.column("vb"), strict=True)
            ]
            if any(keep):
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.chunks(batches):
            found = text.words(batch.column("text"))
            rows, grams = text.shingles(found, found.hashes(), width)
            ends = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            sets = [grams[ends[k] : ends[k + 1]].tobytes() for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_pydict(
                {"node": batch.column("doc_id"), "v": pa.array(sets, type=pa.binary())}
            )

    return run


def full_sets(ids: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """``(node, v)``: the sorted shingle hashes of the documents ``ids(doc_id)``."""
    whole = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    chosen = join_by(whole, written(ids, "near-ids"), ["doc_id"], "left_semi")
    return written(chosen.mapInArrow(_sets(width), "node bigint, v binary"), "near-sets")


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs whose full shingle sets have the similarity asked for."""
    ends = pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select(F.col("b").alias("doc_id")))
    sets = full_sets(ends.distinct(), docs, width)
    return with_values(pairs, sets).mapInArrow(_confirm(percent), "a bigint, b bigint").distinct()


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one task as stars: the same connections, every node hung on the least it reaches here."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.get(top, top)) != top:
            top = up
        while x != top:
            root[x], x = top, root.get(x, x)
        return top

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    nodes = list(root)
    if nodes:
        yield pa.RecordBatch.from_pydict({"a": pa.array(nodes), "b": pa.array([find(x) for x in nodes])})


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for all nodes of ``links(a, b)``; the component is its least node.

    Tasks first replace their own links by stars. Then, in turn, every node hangs
    its larger neighbours on its least one, and its smaller ones, until all links
    are stars. Takes few rounds, each of map-side combined minima and joins, with
    its links written.
    """

    def star(edges: DataFrame, larger: bool) -> DataFrame:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(
            both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "star-least"
        )
        side = both.filter("b > a" if larger else "b < a")
        moved = join_by(side, least, ["a"], spread="b").select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not larger:
            moved = moved.unionAll(least.select("a", F.col("m").alias("b")))
        return moved.filter("a != b").distinct()

    def settled(edges: DataFrame) -> bool:
        """No node hangs on two, or hangs on one that hangs itself."""
        ends = edges.selectExpr("inline(array(named_struct('x', a, 'up', 1, 'down', 0), named_struct('x', b, 'up', 0, 'down', 1)))")
        loose = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        return loose.filter("up > 1 OR (up > 0 AND down > 0)").isEmpty()

    edges = written(links.select("a", "b").filter("a != b"), "star")
    while True:
        tasks = max(1, -(-edges.count() // LINKS))
        own = edges.coalesce(tasks).mapInArrow(_contracted, "a bigint, b bigint")
        edges = written(own.filter("a != b"), "star")
        if settled(edges):
            break
        edges = written(star(written(star(edges, larger=True), "star"), larger=False), "star")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)


def _block_pairs(block: np.ndarray, outer: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (outer row, other row) of equal block, at most about 32,768 at a time."""
    begin = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    end = np.concatenate([begin[1:], [len(block)]])
    x = np.flatnonzero(outer)
    group = np.searchsorted(begin, x, side="right") - 1
    sizes = (end - begin)[group]
    total = np.cumsum(sizes)
    first = 0
    while first < len(x):
        done = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, done + 32768, side="right")))
        n = sizes[first:last]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(x[first:last], n), np.repeat(begin[group[first:last]], n) + at
        first = last


def _open_pairs(batch: pa.RecordBatch, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of an outer row and one of another component that can be similar, in the first band they share."""
    key, component = batch.column("key").to_numpy(), batch.column("component").to_numpy()
    inner = batch.column("inner").to_numpy(zero_copy_only=False)
    coords = _matrix(batch.column("sketch"))
    outer = batch.column("outer").to_numpy(zero_copy_only=False)
    for left, right in _block_pairs(batch.column("block").to_numpy(), outer):
        useful = inner[right] & (component[left] != component[right])
        left, right = left[useful], right[useful]
        if len(left):
            equal = coords[left] == coords[right]
            first = equal.reshape(len(left), BANDS, ROWS).all(axis=2).argmax(axis=1)
            take = (equal.sum(axis=1) >= least) & (first == (key[left] & 31))
            if take.any():
                yield left[take], right[take]


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, cut between blocks; a block is at most ``OUTER`` and ``INNER`` rows or so."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            whole = pa.Table.from_batches([*held, batch]).combine_chunks().to_batches()[0]
            block = whole.column("block").to_numpy()
            cut = int(np.searchsorted(block, block[-1]))
            held = [whole.slice(cut)]
            if cut:
                yield whole.slice(0, cut)
    yield from held


def _active(least: int):
    """``(block, node)`` of the rows that have a partner to be confirmed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_blocks(batches):
            mark = np.zeros(batch.num_rows, dtype=bool)
            for left, right in _open_pairs(batch, least):
                mark[left] = mark[right] = True
            if mark.any():
                yield batch.filter(pa.array(mark)).select(["block", "node"])

    return run


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether sorted sets share ``percent`` of their union."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirm_blocks(least: int, percent: int):
    """Links of the open pairs, confirmed on the full sets; pairs that links here already join are passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_blocks(batches):
            node, sets = batch.column("node").to_numpy(), batch.column("v")
            component = batch.column("component").to_numpy()
            root: dict[int, int] = {}

            def find(x: int) -> int:
                while (up := root.get(x, x)) != x:
                    x = up
                return x

            links = []
            for left, right in _open_pairs(batch, least):
                for i, j in zip(left.tolist(), right.tolist(), strict=True):
                    a, b = find(int(component[i])), find(int(component[j]))
                    if a == b:
                        continue
                    x = np.frombuffer(sets[i].as_buffer(), dtype=np.uint64)
                    y = np.frombuffer(sets[j].as_buffer(), dtype=np.uint64)
                    if similar(x, y, percent):
                        root[max(a, b)] = min(a, b)
                        links.append((int(node[i]), int(node[j])))
            if links:
                yield pa.RecordBatch.from_pydict(
                    {"a": pa.array([min(p) for p in links]), "b": pa.array([max(p) for p in links])}
                )

    return run


def open_blocks(members: DataFrame, found: DataFrame) -> DataFrame:
    """``(key, block, node, component, outer, inner)``: what is still to be compared, cut into blocks.

    With ``u`` of a bucket's ``n`` rows outside its main component, at most
    ``u * n`` pairs are open, in blocks of ``OUTER`` by ``INNER`` rows. A row
    stands in the blocks of its own inner part, and an outer row also in those of
    its outer part.
    """
    rows = written(
        join_by(members.select("key", "node").distinct(), found, ["node"]).select(
            "key", "node", F.coalesce("component", "node").alias("component")
        ),
        "near-members",
    )
    per = rows.groupBy("key", "component").agg(F.count("*").alias("n"))
    mixed = written(
        per.groupBy("key")
        .agg(F.sum("n").alias("size"), F.max(F.struct("n", "component")).alias("main"), F.count("*").alias("parts"))
        .filter("parts > 1")
        .select("key", "size", F.col("main.component").alias("main"), (F.col("size") - F.col("main.n")).alias("out")),
        "near-mixed",
    )
    many = lambda n, size: F.ceil(n / F.lit(size)).cast("int")
    cut = join_by(rows, mixed, ["key"], "inner", spread="node").select(
        "key",
        "node",
        "component",
        (F.col("component") != F.col("main")).alias("is_out"),
        many(F.col("out"), OUTER).alias("outs"),
        many(F.col("size"), INNER).alias("ins"),
        F.xxhash64("node").alias("h"),
    )
    own_out, own_in = F.pmod("h", "outs").cast("int"), F.pmod("h", "ins").cast("int")
    spans = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    at = F.array_distinct(
        F.concat(
            F.transform(spans("outs"), lambda o: F.struct(o.alias("o"), own_in.alias("i"))),
            F.when(F.col("is_out"), F.transform(spans("ins"), lambda i: F.struct(own_out.alias("o"), i.alias("i")))).otherwise(
                F.array().cast("array<struct<o:int,i:int>>")
            ),
        )
    )
    return cut.withColumn("at", F.explode(at)).select(
        "key",
        F.xxhash64("key", "at.o", "at.i").alias("block"),
        "node",
        "component",
        (F.col("is_out") & (own_out == F.col("at.o"))).alias("outer"),
        (own_in == F.col("at.i")).alias("inner"),
    )


def outside_links(
    members: DataFrame, found: DataFrame, nodes: DataFrame, docs: DataFrame, least: int, percent: int, width: int
) -> DataFrame:
    """Confirmed links ``(a, b)`` between rows of a bucket that are not in one component.

    Open pairs never leave their task: the first pass over the blocks only marks
    the rows that have a partner to be confirmed, the second brings these rows'
    full sets and gives out the links.
    """
    placed = written(open_blocks(members, found), "near-blocks")

    def laid(rows: DataFrame) -> DataFrame:
        with_sketch = rows.join(nodes.select("node", "sketch"), "node")
        return with_sketch.repartition("block").sortWithinPartitions("block")

    active = written(laid(placed).mapInArrow(_active(least), "block bigint, node bigint"), "near-active")
    chosen = placed.join(active.distinct(), ["block", "node"], "left_semi")
    sets = full_sets(active.select(F.col("node").alias("doc_id")).distinct(), docs, width)
    whole = laid(chosen.join(sets, "node"))
    return whole.mapInArrow(_confirm_blocks(least, percent), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, a row per row of ``docs``.

    ``component_id`` is the least doc_id that confirmed links reach; ``kept``
    marks that document. Rows without words (or with null text) link with
    nothing. Every row gets the component of its own set; where rows repeat a
    doc_id, a link is confirmed if one of their sets confirms it. A row without a doc_id belongs to the documents with its
    very set; where there are none, its component_id is null and it is kept.
    An empty table gives no rows.
    """
    share = percent / 100
    least = int(SIZE * (share - ERRORS * sqrt(share * (1 - share) / SIZE)))
    rows = written(sketches(docs, width), "near-sketches")
    classes = written(
        rows.filter("n_shingles > 0")
        .groupBy("a", "b")
        .agg(F.min("doc_id").alias("node"), F.count("*").alias("n")),
        "near-classes",
    )
    named = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("node"), "sketch")
    nodes = written(named.join(classes.select("node"), "node", "left_semi"), "near-nodes")
    members = written(buckets(nodes), "near-buckets")
    side = members.filter("prev IS NOT NULL AND prev != node").select(
        F.least("node", "prev").alias("a"), F.greatest("node", "prev").alias("b")
    )
    values = nodes.select("node", F.col("sketch").alias("v"))
    likely = written(
        with_values(written(side.distinct(), "near-side"), values)
        .mapInArrow(_estimate(least), "a bigint, b bigint")
        .distinct(),
        "near-likely",
    )
    links = written(confirmed(likely, docs, percent, width), "near-links")
    found = written(components(links), "near-components")
    more = written(outside_links(members, found, nodes, docs, least, percent, width), "near-links")
    known = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    found = written(components(known.unionAll(more)), "near-components")
    labelled = join_by(classes, found, ["node"])
    moved = written(
        labelled.filter("n > 1 OR component IS NOT NULL").select(
            "a", "b", F.coalesce("component", "node").alias("component")
        ),
        "near-classes",
    )
    whole = join_by(rows.drop("sketch"), moved, ["a", "b"], spread="doc_id")
    component = F.coalesce("component", "doc_id")
    return whole.select(
        "doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )
