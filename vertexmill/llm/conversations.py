"""Repair of conversations: a weighted grammar over spans of rows, combined bottom-up.

A repaired conversation has the role initials ``(s?(ua)+)?``. In Chomsky normal form the
grammar has a nonterminal ``X(p,q)`` for every pair of places that some piece of such a
sequence leads between, and the rules ``X(p,q) -> X(p,r) X(r,q)``. A cell holds, for a span of rows,
the cheapest ``(cost, audit)`` of each nonterminal; cells of single rows have the edits
Keep, Rerole and Delete, closed under Insert on both sides.

As every rule's split point may lie anywhere (``X(p,q)`` over a span is the same for each
split into two spans), a span is combined from two halves: spans of 1, 2, 4, 8, ... rows.
The least audit of a cost is kept by every combination, because among edits of the same
rows at the same cost none is a proper prefix of another: it would have fewer inserts, hence cost less.

Conversations of up to ``LONG`` rows and bytes are repaired in one task each. Longer ones are
cut into blocks of ``BLOCK`` rows; blocks are parsed and merged, ``MERGE`` at a time, in
tasks of their own, and only the hash of the repaired text runs through one task, row by row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vertexmill.llm.tables import in_sorted_groups, join_by, sorted_runs, written
from vertexmill.runtime import drop_written

#: Rows and bytes of text up to which a conversation is repaired as one group.
LONG, LONG_BYTES = 4096, 32 << 20

#: Rows of a block of a longer one, and blocks that are merged at a time.
BLOCK, MERGE = 4096, 64

#: What the edits cost, and what keeping a truncated row adds.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: Fixed value: white space, of which a blank row consists.
SPACE = " \t\n\x0b\x0c\r"

#: Places in a repaired sequence: its start, after s, after u, after a. It ends at the first or the last.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
ENDS = (START, AFTER_A)

#: Where one more turn of a role leads from each place.
TURNS = {
    "s": {START: AFTER_S},
    "u": {START: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U},
    "a": {AFTER_U: AFTER_A},
}

Cell = dict[tuple[int, int], tuple[int, str]]


def combined(left: Cell, right: Cell) -> Cell:
    """The cell of two adjacent spans."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in range(4):
            found = right.get((r, q))
            if found is not None:
                made = (cost + found[0], audit + found[1])
                best = out.get((p, q))
                if best is None or made < best:
                    out[p, q] = made
    return out


def _closure() -> Cell:
    """The cell of no row: inserts only, as many as are ever worth it."""
    one: Cell = {(p, p): (0, "") for p in range(4)}
    for role in "ua":
        one |= {(p, q): (INSERT, "I") for p, q in TURNS[role].items()}
    return combined(one, one)


INSERTS = _closure()


def row_cell(letter: str) -> Cell:
    """The closed cell of a row: its role's initial (``o`` for others), upper-case if truncated, or ``x`` to delete."""
    cell: Cell = {(p, p): (DELETE, "D") for p in range(4)}
    if letter != "x":
        extra = TRUNCATED if letter.isupper() else 0
        for role in "ua":
            cell |= {(p, q): (REROLE + extra, "R") for p, q in TURNS[role].items()}
        cell |= {(p, q): (extra, "K") for p, q in TURNS.get(letter.lower(), {}).items()}
    return combined(combined(INSERTS, cell), INSERTS)


@lru_cache(maxsize=1 << 16)
def short_span(letters: str) -> Cell:
    """The cell of up to eight rows, from its halves."""
    if len(letters) == 1:
        return row_cell(letters)
    half = 1 << ((len(letters) - 1).bit_length() - 1)
    return combined(short_span(letters[:half]), short_span(letters[half:]))


def merged(cells: list[Cell], combine=combined) -> Cell:
    """The cell of adjacent spans, pairs of neighbours first."""
    while len(cells) > 1:
        paired = [combine(cells[k], cells[k + 1]) for k in range(0, len(cells) - 1, 2)]
        cells = paired + cells[len(paired) * 2 :]
    return cells[0]


def span(letters: str) -> Cell:
    return merged([short_span(letters[at : at + 8]) for at in range(0, len(letters), 8)] or [INSERTS])


def best(cell: Cell) -> tuple[int, str]:
    """Cheapest ``(cost, audit)`` of a whole conversation."""
    return min(cell[START, end] for end in ENDS if (START, end) in cell)


def repaired(audit: str, rows: Iterable[tuple[str, str]], place: int = START) -> Iterator[list[str]]:
    """The lines ``role:text`` that each row of ``rows`` leaves, with those inserted before it; then those after all."""
    rows, lines = iter(rows), []
    for edit in audit:
        role = "assistant" if place == AFTER_U else "user"
        if edit == "I":
            lines.append(f"{role}:")
            place = TURNS[role[0]][place]
            continue
        own, text = next(rows)
        if edit != "D":
            role = own if edit == "K" else role
            lines.append(f"{role}:{text}")
            place = TURNS[role[0]][place]
        yield lines
        lines = []
    yield lines


# ------------------------------------------------------------------ damage and faults


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copies)``: null roles and texts are one space, and a twentieth each of the
    rows, by the CRC-32 of ``conv_id:turn``, is dropped (0 copies), emptied, unpunctuated, repeated or given to the user."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("bigint").cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = conversations.select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.crc32(name.cast("binary")) % 20).alias("_fault"),
    )
    fault = F.col("_fault")
    text = F.when(fault == 1, F.lit("")).when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn",
        F.when(fault == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).cast("bigint").alias("copies"),
    )


def with_letter(rows: DataFrame) -> DataFrame:
    """Adds ``blank`` and the ``letter`` of a row that is not a duplicate."""
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    first = F.substring("role", 1, 1)
    initial = F.when(first.isin("s", "u", "a"), first).otherwise(F.lit("o"))
    whole = F.right(bare, F.lit(1)).isin(".", "!", "?")
    return rows.withColumns(
        {
            "blank": bare == "",
            "letter": F.when(bare == "", F.lit("x")).when(whole, initial).otherwise(F.upper(initial)),
        }
    )


class Faults:
    """Counts over rows in order; those of two adjacent spans add up."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.least = self.most = None

    def add(self, blank: bool, duplicate: bool, truncated: bool, initial: str, turn: int | None, copies: int):
        if not copies:
            return
        # a further copy of a row that isn't blank is a duplicate
        again = 0 if blank else copies - 1
        self.blank += copies * blank
        self.duplicate += (not blank and duplicate) + again
        self.truncated += not blank and not duplicate and truncated
        self.illegal += copies - 1 + (self.last is not None and self.last + initial not in ("su", "ua", "au"))
        self.first = initial if self.first is None else self.first
        self.last = initial
        if turn is not None:
            self.turns += turn != self.most
            self.least = turn if self.least is None else self.least
            self.most = turn

    def join(self, other: Faults):
        """What lies after this span; turns ascend."""
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        if None not in (self.last, other.first):
            self.illegal += self.last + other.first not in ("su", "ua", "au")
        if self.most is not None and self.most == other.least:
            self.turns -= 1
        self.first = other.first if self.first is None else self.first
        self.last = self.last if other.last is None else other.last
        self.least = other.least if self.least is None else self.least
        self.most = self.most if other.most is None else other.most

    @property
    def gaps(self) -> int:
        # a gap beyond the range of a long counts as its largest value
        return 0 if self.most is None else min(self.most - self.least + 1 - self.turns, (1 << 63) - 1)


_RESULT = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint,"
    " cost bigint, audit string, repaired_sha256 string"
)
_NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _result(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 7 + [pa.string()] * 2
    columns = list(zip(*rows, strict=True)) or [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], _NAMES)


# ------------------------------------------------------------------ conversations of usual length


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repair of conversations whose sorted rows follow each other."""
    done = []
    for (conv_id,), rows in in_sorted_groups(batches, ["conv_id"], ["turn", "role", "text", "copies", "blank", "letter"]):
        faults, letters, kept, seen = Faults(), [], [], set()
        for turn, role, text, copies, blank, letter in zip(*rows.values(), strict=True):
            duplicate = (role, text) in seen
            faults.add(blank, duplicate, letter.isupper(), role[:1], turn, copies)
            letters.append((("x" if duplicate else letter) + "x" * (copies - 1)) if copies else "")
            if copies:
                seen.add((role, text))
                kept += [(role, text)] * copies
        cost, audit = best(span("".join(letters)))
        lines = [line for lines in repaired(audit, kept) for line in lines]
        body = sha256("\n".join(lines).encode()).hexdigest()
        done.append((conv_id, faults.gaps, faults.blank, faults.duplicate, faults.truncated, faults.illegal, cost, audit, body))
        if len(done) >= 4096:
            yield _result(done)
            done = []
    if done:
        yield _result(done)


# ------------------------------------------------------------------ long conversations

_CELLS = "array<struct<p:int,q:int,cost:bigint,audit:string,path:string>>"
_STATS = ["blank", "duplicate", "truncated", "illegal", "turns"]
_EDGES = ["first", "last", "least", "most"]
_SPAN = (
    f"conv_id bigint, block bigint, cells {_CELLS}, {' bigint, '.join(_STATS)} bigint,"
    " first string, last string, least bigint, most bigint"
)


def _span_batch(conv_id, block: int, cell: dict, faults: Faults) -> pa.RecordBatch:
    entry = pa.struct(
        [("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()), ("path", pa.string())]
    )
    cells = [{"p": p, "q": q, "cost": v[0], "audit": v[1], "path": v[2]} for (p, q), v in cell.items()]
    columns = {
        "conv_id": pa.array([conv_id], pa.int64()),
        "block": pa.array([block], pa.int64()),
        "cells": pa.array([cells], pa.list_(entry)),
    }
    columns |= {c: pa.array([getattr(faults, c)], pa.int64()) for c in _STATS}
    columns |= {c: pa.array([getattr(faults, c)], pa.string() if c in ("first", "last") else pa.int64()) for c in _EDGES}
    return pa.RecordBatch.from_pydict(columns)


def _block_letters(rows: dict[str, list]) -> str:
    pairs = zip(rows["letter"], rows["copies"], strict=True)
    return "".join((letter + "x" * (copies - 1)) if copies else "" for letter, copies in pairs)


def _parsed_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["turn", "initial", "copies", "blank", "duplicate", "letter"]
    for (conv_id, block), rows in in_sorted_groups(batches, ["conv_id", "block"], names):
        faults = Faults()
        for turn, initial, copies, blank, duplicate, letter in zip(*rows.values(), strict=True):
            faults.add(blank, duplicate, letter.isupper(), initial, turn, copies)
        cell = {k: (*v, "") for k, v in span(_block_letters(rows)).items()}
        yield _span_batch(conv_id, block, cell, faults)


def _with_path(left: dict, right: dict) -> dict:
    """As :func:`combined`, with the places between the blocks that the least edits pass through."""
    out: dict = {}
    for (p, r), (cost, audit, path) in left.items():
        for q in range(4):
            if (r, q) in right:
                other = right[r, q]
                made = (cost + other[0], audit + other[1], f"{path}{r}{other[2]}")
                if (p, q) not in out or made < out[p, q]:
                    out[p, q] = made
    return out


def _merged_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["cells", *_STATS, *_EDGES]
    for (conv_id, above), rows in in_sorted_groups(batches, ["conv_id", "above"], names):
        faults, cells = Faults(), []
        for k, cell in enumerate(rows["cells"]):
            cells.append({(e["p"], e["q"]): (e["cost"], e["audit"], e["path"]) for e in cell})
            other = Faults()
            for c in _STATS + _EDGES:
                setattr(other, c, rows[c][k])
            faults.join(other)
        yield _span_batch(conv_id, above, merged(cells, _with_path), faults)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired lines of each row of a block; its first row brings the places it starts and ends at."""
    names = ["place", "role", "text", "copies", "letter", "p", "q"]
    for (conv_id, block), rows in in_sorted_groups(batches, ["conv_id", "block"], names):
        p, q = rows["p"][0], rows["q"][0]
        rows = {c: v[1:] for c, v in rows.items()}
        kept = [(r, t) for r, t, n in zip(rows["role"], rows["text"], rows["copies"], strict=True) for _ in range(n)]
        places = [k for k, n in zip(rows["place"], rows["copies"], strict=True) for _ in range(n)]
        # lines inserted after all rows stand with the last one
        places.append(rows["place"][-1])
        _, audit = span(_block_letters(rows))[p, q]
        for k, lines in zip(places, repaired(audit, kept, p), strict=True):
            for line in lines:
                yield pa.RecordBatch.from_pydict(
                    {"conv_id": pa.array([conv_id], pa.int64()), "place": pa.array([k], pa.int64()), "line": [line]}
                )


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(conv_id, repaired_sha256)`` of lines in order; one line is held at a time."""
    key, body, some = (), None, False
    out: list[tuple] = []
    for batch in batches:
        for conv_id, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist(), strict=True):
            if (conv_id,) != key:
                if body is not None:
                    out.append((*key, body.hexdigest()))
                key, body, some = (conv_id,), sha256(), False
            if line is not None:
                body.update(("\n" + line if some else line).encode())
                some = True
    if body is not None:
        out.append((*key, body.hexdigest()))
    columns = list(zip(*out, strict=True)) or [(), ()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string())], ["conv_id", "repaired_sha256"]
    )


def _repair_long(rows: DataFrame, block: int, merge: int) -> DataFrame:
    """Results of long conversations from their damaged rows."""
    # equal rows of a turn become one, whatever their number, before anything else moves
    once = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    once = written(with_letter(once).withColumn("same", same).withColumn("timed", F.col("turn").isNotNull()), "conversation-rows")
    when = F.struct("timed", "turn")
    seen = once.filter("copies > 0 AND NOT blank").groupBy("conv_id", "same")
    seen = seen.agg(F.min(when).alias("since"), F.count("*").alias("n")).filter("n > 1").drop("n")
    marked = join_by(once, written(seen, "conversation-repeats"), ["conv_id", "same"], "left", spread="turn")
    duplicate = F.coalesce(F.struct("timed", "turn") != F.col("since"), F.lit(False)) & ~F.col("blank")
    marked = marked.withColumn("duplicate", duplicate).drop("since", "same")
    marked = marked.withColumn("letter", F.when(F.col("duplicate"), F.lit("x")).otherwise(F.col("letter")))
    # the start of the text splits the rows of one turn; whole texts would make the sample of the sort large
    marked = marked.withColumn("start", F.substring("text", 1, 32))
    spread = marked.repartitionByRange("conv_id", "timed", "turn", "role", "start")
    ordered = written(spread.sortWithinPartitions("conv_id", "timed", "turn", "role", "start", "text").drop("timed", "start"), "conversation-order")
    placed, _ = sorted_runs(ordered, "conv_id")
    placed = written(placed.withColumn("block", F.expr(f"place div {block}")), "conversation-blocks")

    narrow = placed.select("conv_id", "block", "place", "turn", F.substring("role", 1, 1).alias("initial"), "copies", "blank", "duplicate", "letter")
    narrow = narrow.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "place")
    spans = written(narrow.mapInArrow(_parsed_blocks, _SPAN), "conversation-spans")
    while spans.filter("block > 0").limit(1).count():
        above = spans.withColumn("above", F.expr(f"block div {merge}"))
        above = above.repartition("conv_id", "above").sortWithinPartitions("conv_id", "above", "block")
        spans = written(above.mapInArrow(_merged_blocks, _SPAN), "conversation-spans")

    ends = F.filter("cells", lambda x: (x["p"] == START) & x["q"].isin(*ENDS))
    least = F.array_min(F.transform(ends, lambda x: F.struct(x["cost"], x["audit"], x["path"], x["q"])))
    gaps = F.col("most").cast("decimal(38,0)") - F.col("least") + 1 - F.col("turns")
    gaps = F.when(F.col("most").isNull(), 0).otherwise(F.least(gaps, F.lit((1 << 63) - 1)).cast("bigint"))
    ended = written(spans.withColumn("end", least).withColumn("gaps", gaps), "conversation-ends")
    path = F.concat(F.lit(str(START)), "end.path", F.col("end.q").cast("string"))
    heads = ended.select("conv_id", path.alias("path"), F.explode(F.sequence(F.lit(0), F.length("end.path"))).alias("at"))
    heads = heads.select(
        "conv_id", F.col("at").cast("bigint").alias("block"), F.lit(-1).cast("bigint").alias("place"),
        F.expr("substring(path, at + 1, 1)").cast("int").alias("p"), F.expr("substring(path, at + 2, 1)").cast("int").alias("q"),
    )
    full = placed.select("conv_id", "block", "place", "role", "text", "copies", "letter")
    full = full.unionByName(heads, allowMissingColumns=True)
    full = full.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "place")
    lines = full.mapInArrow(_lines, "conv_id bigint, place bigint, line string")
    # a row without a line, so that conversations without any have a hash too
    lines = lines.unionByName(ended.select("conv_id", F.lit(-1).cast("bigint").alias("place"), F.lit(None).cast("string").alias("line")))
    lines = written(lines.withColumn("n", F.monotonically_increasing_id()), "conversation-lines")
    lines = lines.repartition("conv_id").sortWithinPartitions("conv_id", "place", "n")
    hashes = written(lines.mapInArrow(_hashes, "conv_id bigint, repaired_sha256 string"), "conversation-hashes")
    out = ended.select("conv_id", "gaps", *_STATS[:4], F.col("end.cost").alias("cost"), F.col("end.audit").alias("audit"))
    return join_by(out, hashes, ["conv_id"], "inner", spread="audit")


def repair(
    conversations: DataFrame, long: int = LONG, long_bytes: int = LONG_BYTES, block: int = BLOCK, merge: int = MERGE
) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of every conversation.

    ``conversations`` are damaged first (:func:`damaged`). Rows go by turn, null turns
    first, then by role and text; repeated rows are duplicates after the first. A null
    conv_id is a conversation too. Null roles and texts are one space, so such a row is of
    no known role, or blank. A conversation of which no row is left has zeros, an empty audit and the hash
    of nothing; an empty table gives no rows. Very long texts and conversations are
    taken whole. Other columns are not looked at.
    """
    rows = damaged(conversations)
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    lengthy = written(sizes.filter((F.col("n") > long) | (F.col("bytes") > long_bytes)).select("conv_id"), "conversation-long")
    some = lengthy.limit(1).count() > 0
    usual = join_by(rows, lengthy, ["conv_id"], "left_anti", spread="turn") if some else rows
    usual = with_letter(usual).withColumn("timed", F.col("turn").isNotNull()).repartition("conv_id")
    usual = usual.sortWithinPartitions("conv_id", "timed", "turn", "role", "text")
    out = usual.mapInArrow(_whole, _RESULT)
    if not some:
        drop_written(lengthy)
        return out
    return out.unionByName(_repair_long(join_by(rows, lengthy, ["conv_id"], "left_semi", spread="turn"), block, merge))
