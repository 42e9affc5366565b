"""Quality rules: counts of a text, and lines that too many documents of a host share."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vertexmill.llm import text
from vertexmill.llm.tables import join_by, written

#: Base rules: fewest words, words per window, and the largest share of words in repeated windows.
LEAST_WORDS, WINDOW, MOST_REPEATED = 20, 8, 30

#: A line is removed where more of its host's distinct texts hold it than this, and than this percentage of them.
MOST_TEXTS, MOST_SHARE = 10, 5

#: A document must keep this percentage of its words, and ``LEAST_WORDS``, without such lines.
LEAST_LEFT = 50

_SYMBOLS = np.zeros(256, dtype=np.int64)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = 1
_DIGITS = bytes(48 if 48 <= c <= 57 else c for c in range(256))


def normalised(line: bytes) -> bytes:
    """``A-Z`` lower-cased, digits as 0, runs of white space as one space, trimmed."""
    return b" ".join(line.lower().translate(_DIGITS).split())


def repeated_words(found: text.Words, hashes: np.ndarray) -> np.ndarray:
    """Words per row inside windows that the row holds twice or more."""
    grams, first = text.windows(found, hashes, WINDOW)
    if not len(grams):
        return np.zeros(found.rows, dtype=np.int64)
    own = text.fold(grams, found.row[first].astype(np.uint64))
    order = np.argsort(own)
    equal = own[order[1:]] == own[order[:-1]]
    again = np.zeros(len(own), dtype=bool)
    again[order[1:][equal]] = True
    again[order[:-1][equal]] = True
    cover = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.add.at(cover, first[again], 1)
    np.add.at(cover, first[again] + WINDOW, -1)
    inside = np.cumsum(cover[:-1]) > 0
    return np.bincount(found.row[inside], minlength=found.rows)


def _lines(data: bytes) -> tuple[int, dict[int, int]]:
    """Lines equal to an earlier one, and words by hash of the normalised line."""
    seen, again, lines = set(), 0, {}
    for line in data.split(b"\n"):
        plain = normalised(line)
        if plain:
            again += line in seen
            seen.add(line)
            h = int.from_bytes(blake2b(plain, digest_size=8).digest(), "little", signed=True)
            lines[h] = lines.get(h, 0) + plain.count(b" ") + 1
    return again, lines


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text.chunks(batches):
        column = batch.column("text")
        found = text.words(column, lower=False)
        data, offsets = text.raw_bytes(column)
        counts = lambda mark: np.diff(np.concatenate([[0], np.cumsum(mark)])[offsets])
        letters = ~text._SPACE[data] & ((data & 0xC0) != 0x80)
        whole = data.tobytes()
        lines = [_lines(whole[offsets[k] : offsets[k + 1]]) for k in range(batch.num_rows)]
        ends = np.cumsum([0, *(len(found) for _, found in lines)])
        hashes = [h for _, found in lines for h in found]
        sizes = [n for _, found in lines for n in found.values()]
        pairs = pa.StructArray.from_arrays(
            [pa.array(hashes, type=pa.int64()), pa.array(sizes, type=pa.int64())], names=["h", "words"]
        )
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "source": batch.column("source"),
                "key": batch.column("key"),
                "n_words": pa.array(found.counts.astype(np.int64)),
                "word_chars": pa.array(counts(letters).astype(np.int64)),
                "n_symbols": pa.array(counts(_SYMBOLS[data]).astype(np.int64)),
                "n_dup_lines": pa.array([n for n, _ in lines], type=pa.int64()),
                "n_repeat_words": pa.array(repeated_words(found, found.hashes()).astype(np.int64)),
                "lines": pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pairs),
            }
        )


MEASURES = (
    "doc_id bigint, source string, key bigint, n_words bigint, word_chars bigint, n_symbols bigint,"
    " n_dup_lines bigint, n_repeat_words bigint, lines array<struct<h:bigint,words:bigint>>"
)


def quality(
    docs: DataFrame, most_texts: int = MOST_TEXTS, most_share: float = MOST_SHARE, least_left: int = LEAST_LEFT
) -> DataFrame:
    """Counts and verdicts for every row of ``docs(doc_id, text, source)``.

    ``base_failed``: fewer than 20 words, or over 30 % of them in repeated
    8-word windows. A line that, normalised, stands in more than ``most_texts`` distinct
    texts of a source and in more than ``most_share`` percent of them is removed;
    ``lines_removed_words`` are its words. ``kept`` is false where the base rules fail or less than
    ``least_left`` percent of the words, or fewer than 20, are left.

    Copies of a text count once, so they don't make its lines common, and share a verdict
    within their source. Null or empty texts have no words and fail. Null sources are one
    source. A very long text is measured alone. An empty table gives no rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint"),
        F.col("source").cast("string"),
        F.col("text").cast("string"),
        F.xxhash64("text").alias("key"),
    )
    measured = written(rows.mapInArrow(_measure, MEASURES), "quality-rows")
    lines = measured.select("source", "key", F.inline("lines"))
    sizes = written(
        measured.filter("n_words > 0").groupBy("source").agg(F.count_distinct("key").alias("texts")), "quality-sizes"
    )
    found = lines.groupBy("source", "h").agg(F.count_distinct("key").alias("holding")).filter(F.col("holding") > most_texts)
    common = join_by(found, sizes, ["source"], "inner", spread="h")
    common = written(common.filter(100 * F.col("holding") > most_share * F.col("texts")).select("source", "h"), "quality-lines")
    removed = written(
        join_by(lines, common, ["source", "h"], "inner", spread="key")
        .groupBy("source", "key", "h")
        .agg(F.max("words").alias("words"))
        .groupBy("source", "key")
        .agg(F.sum("words").alias("lines_removed_words")),
        "quality-removed",
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    gone = F.coalesce("lines_removed_words", F.lit(0))
    left = F.col("n_words") - gone
    depleted = (left < LEAST_WORDS) | (100 * left < least_left * F.col("n_words"))
    return join_by(measured.drop("lines"), removed, ["source", "key"], spread="doc_id").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
        gone.alias("lines_removed_words"),
    )
