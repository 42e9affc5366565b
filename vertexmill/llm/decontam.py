"""Benchmark decontamination by greedy string tiling.

Benchmark items are the stated query set: they are taken in blocks of bounded
size, each broadcast as an index of hashed word runs, and every document is held
against a block where it lies. Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vertexmill.llm import text

#: Words of the shortest tile, and the share of an item's words that tiles must cover.
LEAST_TILE, COVERAGE = 5, 0.5

#: Benchmark text in one block; its index takes about four times as much.
BLOCK_BYTES = 8 << 20


@dataclass
class Index:
    """Runs of ``least_tile`` words of a block's items, sorted by hash; items of fewer words are a run each."""

    runs: np.ndarray
    item: np.ndarray
    at: np.ndarray
    ids: list
    sizes: np.ndarray
    widths: list


def index_of(items: list, least_tile: int) -> Index:
    """``items`` are ``(item_id, text)``. An item of fewer words than a tile is one run, the whole of it."""
    found = text.words(pa.array([t for _, t in items], type=pa.string()))
    hashes = found.hashes()
    begin = np.cumsum(found.counts) - found.counts
    runs, first = text.windows(found, hashes, least_tile)
    widths = [least_tile]
    for width in range(1, least_tile):
        if (found.counts == width).any():
            widths.append(width)
            short, at = text.windows(found, hashes, width)
            whole = found.counts[found.row[at]] == width
            runs, first = np.concatenate([runs, short[whole]]), np.concatenate([first, at[whole]])
    order = np.argsort(runs, kind="stable")
    item = found.row[first]
    return Index(runs[order], item[order], (first - begin[item])[order], [i for i, _ in items], found.counts, widths)


def diagonals(places: list[np.ndarray], q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal matches ``(document run, item run, runs)`` where the item's run ``q[k]`` stands at ``places[k]`` of the document.

    The item is walked run by run. A match is held by where it is now, so memory
    follows the places of one run and the matches found, never the pairs of places.
    """
    out = []
    now = begin = since = np.zeros(0, dtype=np.int64)
    last = -2
    for k in np.argsort(q, kind="stable"):
        here, at = places[k], int(q[k])
        start, first = here.copy(), np.full(len(here), at, dtype=np.int64)
        if at != last + 1:
            out.append((begin, since, last + 1 - since))
        else:
            spot = np.searchsorted(here, now + 1)
            goes = here[np.minimum(spot, len(here) - 1)] == now + 1
            start[spot[goes]], first[spot[goes]] = begin[goes], since[goes]
            out.append((begin[~goes], since[~goes], last + 1 - since[~goes]))
        now, begin, since, last = here, start, first, at
    out.append((begin, since, last + 1 - since))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def tile(places: list[np.ndarray], q: np.ndarray, least: int, words: int) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(document word, item word, length)``; the item's run ``q[k]`` stands at ``places[k]`` of the document.

    Runs on one diagonal that follow each other are one match. The longest match
    whose words are all unmarked is marked, again and again; what marks have cut
    off goes back as shorter matches while it is a tile long. Ties: first in the
    item, then in the document.
    """
    p, q, length = diagonals(places, q)
    length = length + least - 1
    heap = [(-n, at_item, at_doc) for at_doc, at_item, n in zip(p.tolist(), q.tolist(), length.tolist(), strict=True)]
    heap.sort()
    in_item, in_doc = np.zeros(words, dtype=bool), {}
    tiles = []
    while heap:
        n, at_item, at_doc = heappop(heap)
        n = -n
        taken = in_item[at_item : at_item + n].copy()
        for k in range(n):
            taken[k] |= at_doc + k in in_doc
        if not taken.any():
            tiles.append((at_doc, at_item, n))
            in_item[at_item : at_item + n] = True
            in_doc.update(dict.fromkeys(range(at_doc, at_doc + n)))
            if in_item.all():
                break
            continue
        free = np.flatnonzero(~taken)
        for part in np.split(free, np.flatnonzero(np.diff(free) != 1) + 1):
            if len(part) >= least:
                heappush(heap, (-len(part), at_item + int(part[0]), at_doc + int(part[0])))
    return tiles


def _met(runs: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which of ``runs`` the index holds, and from where to where."""
    low = np.searchsorted(index.runs, runs)
    hit = np.flatnonzero(index.runs[np.minimum(low, len(index.runs) - 1)] == runs) if len(index.runs) else np.zeros(0, int)
    return hit, low[hit], np.searchsorted(index.runs, runs[hit], side="right")


def matches(column: pa.Array, index: Index, least_tile: int, coverage: float) -> Iterator[tuple]:
    """``(row, item, covered words, tiles)`` of the rows that hold enough of an item."""
    found = text.words(column)
    hashes = found.hashes()
    begin = np.cumsum(found.counts) - found.counts
    for width in index.widths:
        runs, first = text.windows(found, hashes, width)
        hit, low, high = _met(runs, index)
        if not len(hit):
            continue
        rows = found.row[first[hit]]
        place = first[hit] - begin[rows]
        for row in np.unique(rows):
            a, b = np.searchsorted(rows, [row, row + 1])
            yield from _row_matches(int(row), place[a:b], low[a:b], high[a:b], index, width, coverage)


def _row_matches(
    row: int, place: np.ndarray, low: np.ndarray, high: np.ndarray, index: Index, width: int, coverage: float
) -> Iterator[tuple]:
    """As :func:`matches` for one row: ``place`` of its runs, and where the index holds their equals.

    The places of a run are kept once, however many equals it has; a pair of
    places is made only for an item that may be covered, and one item at a time.
    """
    order = np.lexsort((place, low))
    place, low, high = place[order], low[order], high[order]
    kinds = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    own = [place[a:b] for a, b in zip(kinds, np.append(kinds[1:], len(low)), strict=True)]
    sizes = high[kinds] - low[kinds]
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low[kinds], sizes)
    kind = np.repeat(np.arange(len(kinds)), sizes)
    item = index.item[at]
    order = np.argsort(item, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(item[order])) + 1):
        words = int(index.sizes[item[part[0]]])
        q = np.sort(index.at[at[part]])
        # words of the item inside any run that the row has: tiles can't cover more
        most = width + np.minimum(np.diff(q), width).sum()
        if most < coverage * words:
            continue
        tiles = tile([own[k] for k in kind[part]], index.at[at[part]], width, words)
        covered = sum(t[2] for t in tiles)
        if covered >= coverage * words:
            yield row, int(item[part[0]]), covered, tiles


def blocks(benchmark: DataFrame, least_tile: int) -> Iterator:
    """The benchmark as broadcast indexes, each of about ``BLOCK_BYTES`` of text."""
    items = benchmark.select(
        F.col("item_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-size // BLOCK_BYTES))
    for k in range(n):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        block = sorted(((r["item_id"], r["text"]) for r in own.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        yield benchmark.sparkSession.sparkContext.broadcast(vars(index_of(block, least_tile)))


MATCHES = (
    "doc_id bigint, item_id bigint, item_words bigint, covered_words bigint, coverage double,"
    " tiles array<struct<doc_word:bigint,item_word:bigint,words:bigint>>"
)


def leaks(
    docs: DataFrame, benchmark: DataFrame, least_tile: int = LEAST_TILE, coverage: float = COVERAGE
) -> DataFrame:
    """A row per document row and benchmark item it holds at least ``coverage`` of.

    Passages may be cut up and reordered: tiles need ``least_tile`` words each.
    Items shorter than a tile must be held whole. Null and empty texts on either side match
    nothing. A very long text is held against the items alone. Repeated documents and repeated items each give rows of their own;
    null ids are passed through. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))

    def finder(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(**shared.value)
            for batch in text.chunks(batches):
                ids = batch.column("doc_id").to_pylist()
                out = [
                    {
                        "doc_id": ids[row],
                        "item_id": index.ids[item],
                        "item_words": int(index.sizes[item]),
                        "covered_words": covered,
                        "coverage": covered / int(index.sizes[item]),
                        "tiles": [{"doc_word": a, "item_word": b, "words": n} for a, b, n in tiles],
                    }
                    for row, item, covered, tiles in matches(batch.column("text"), index, least_tile, coverage)
                ]
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=_schema())

        return run

    found = [rows.mapInArrow(finder(shared), MATCHES) for shared in blocks(benchmark, least_tile)]
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def _schema() -> pa.Schema:
    tiles = pa.struct([("doc_word", pa.int64()), ("item_word", pa.int64()), ("words", pa.int64())])
    return pa.schema(
        [("doc_id", pa.int64()), ("item_id", pa.int64()), ("item_words", pa.int64()),
         ("covered_words", pa.int64()), ("coverage", pa.float64()), ("tiles", pa.list_(tiles))]
    )


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, least_tile: int = LEAST_TILE, coverage: float = COVERAGE
) -> DataFrame:
    """The rows of ``docs``, all their columns, that hold no benchmark item."""

    def cleaner(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(**shared.value)
            for batch in text.chunks(batches):
                clean = np.ones(batch.num_rows, dtype=bool)
                for row, *_ in matches(batch.column("text"), index, least_tile, coverage):
                    clean[row] = False
                yield batch.filter(pa.array(clean))

        return run

    for shared in blocks(benchmark, least_tile):
        docs = docs.mapInArrow(cleaner(shared), docs.schema)
    return docs
