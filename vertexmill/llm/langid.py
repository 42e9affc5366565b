"""Language spans: script ranges narrow the candidates, Viterbi labels the words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vertexmill.llm import text

#: Documents of a language that are learned from at most (those of the lowest id hashes).
SAMPLE = 4000

#: Hash buckets of the byte trigrams of a word with its edges.
BUCKETS = 1 << 16

#: Fixed first code points of the script ranges that candidates are told by, and their names.
SCRIPTS = [
    (0x0041, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"),
    (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0E00, "Thai"), (0x10A0, "Georgian"), (0x1100, "Hangul"),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x3040, "Kana"), (0x3400, "Han"), (0xAC00, "Hangul"), (0x20000, "Han"),
]
NAMES = sorted({name for _, name in SCRIPTS})

#: A script belongs to a language that writes this share of its letters in it.
SCRIPT_SHARE = 0.001

#: What a change of language costs, and the worst that one word can say against a language, in nats.
SWITCH, WORST = 10.0, 12.0

#: Trigrams that the independent ones count for in a language's share of them.
PRIOR = 1 << 12

#: Classes of bytes: a word's edge, letters, other ASCII, later and first bytes of longer code points.
CLASSES = 5
_CLASS = np.full(256, 2, dtype=np.uint8)
_CLASS[32], _CLASS[97:123], _CLASS[128:192], _CLASS[192:] = 0, 1, 3, 4

_STARTS = np.array([first for first, _ in SCRIPTS])
_NAME_AT = np.array([NAMES.index(name) for _, name in SCRIPTS])


def lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column.cast(pa.string()))


def codes(found: text.Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every byte trigram of the words ``at``, edges included, and words' first trigrams."""
    size = (found.end - found.start)[at]
    begin = np.cumsum(size) - size
    flat = np.repeat(found.start[at] - begin, size) + np.arange(size.sum())
    here = found.data[flat].astype(np.uint32)
    left, right = np.empty_like(here), np.empty_like(here)
    left[1:], right[:-1] = here[:-1], here[1:]
    left[begin] = 32
    right[begin + size - 1] = 32
    return (left << 16) | (here << 8) | right, begin


def bucket(code: np.ndarray) -> np.ndarray:
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def classes(code: np.ndarray) -> np.ndarray:
    """``(trigram, byte)`` classes of the bytes of trigrams."""
    return _CLASS[(code[:, None] >> np.array([16, 8, 0], dtype=np.uint32)) & np.uint32(255)]


def word_scripts(found: text.Words, at: np.ndarray) -> np.ndarray:
    """``(word, script)`` counts of the letters of the words ``at``."""
    out = np.zeros((len(at), len(NAMES)), dtype=np.int64)
    if not len(at):
        return out
    size = (found.end - found.start)[at]
    plain = np.add.reduceat(found.data[np.repeat(found.start[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())] >= 128, np.cumsum(size) - size) == 0
    latin = NAMES.index("Latin")
    flat = np.repeat(found.start[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    letters = (found.data[flat] >= 97) & (found.data[flat] <= 122)
    ascii_letters = np.add.reduceat(letters.astype(np.int64), np.cumsum(size) - size)
    out[:, latin] = ascii_letters
    for k in np.flatnonzero(~plain):
        word = found.word(at[k]).decode("utf-8", errors="replace")
        for c in word:
            if ord(c) >= 128 and c.isalpha():
                out[k, _NAME_AT[max(0, np.searchsorted(_STARTS, ord(c), side="right") - 1)]] += 1
    return out


#: Places of the counted tables of a language.
KINDS = (BUCKETS, len(NAMES), 256, CLASSES**3)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(lang, kind, place, n)``: trigram buckets (kind 0), letters by script (1), bytes (2), byte classes of trigrams (3)."""
    tables: dict[str, list[np.ndarray]] = {}
    for batch in text.chunks(batches):
        found = text.words(lowered(batch.column("text")))
        if not len(found.start):
            continue
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)[found.row]
        hashes = found.hashes()
        for lang in set(langs):
            own = np.flatnonzero(langs == lang)
            _, first, times = np.unique(hashes[own], return_index=True, return_counts=True)
            one = own[first]
            letters = word_scripts(found, one)
            lettered = letters.sum(axis=1) > 0
            one, times, letters = one[lettered], times[lettered], letters[lettered]
            if not len(one):
                continue
            code, begin = codes(found, one)
            each = np.repeat(times, np.diff(np.concatenate([begin, [len(code)]])))
            patterns = classes(code) @ np.array([CLASSES**2, CLASSES, 1])
            new = [
                np.bincount(bucket(code), weights=each, minlength=BUCKETS),
                (letters * times[:, None]).sum(axis=0),
                np.bincount((code >> np.uint32(8)) & np.uint32(255), weights=each, minlength=256),
                np.bincount(patterns, weights=each, minlength=CLASSES**3),
            ]
            own = tables.setdefault(lang, [np.zeros(size, dtype=np.int64) for size in KINDS])
            for table, more in zip(own, new, strict=True):
                table += more.astype(np.int64)
    for lang, own in tables.items():
        for kind, table in enumerate(own):
            place = np.flatnonzero(table)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * len(place), type=pa.string()),
                    "kind": pa.array(np.full(len(place), kind, dtype=np.int32)),
                    "place": pa.array(place.astype(np.int32)),
                    "n": pa.array(table[place]),
                }
            )


def held_out():
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(crc % 5 == 0, F.lit(False))


def counted(docs: DataFrame) -> tuple[list[str], list[np.ndarray]]:
    """The languages, and a table of each of ``KINDS`` with a row per language, counted in Spark from a bounded sample.

    At most about ``SAMPLE`` documents a language, those with the lowest id
    hashes, that are not held out and have a ``lang``. What reaches the driver is
    at most ``sum(KINDS)`` numbers a language.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.col("lang").cast("string")
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    sizes = rows.groupBy("lang").agg(F.count("*").alias("all"))
    share = F.least(F.lit(1.0), F.lit(float(SAMPLE)) / F.col("all"))
    place = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1 << 20)) / float(1 << 20)
    chosen = rows.join(F.broadcast(sizes), "lang").filter(place < share).select("lang", "text")
    found = (
        chosen.mapInArrow(_counts, "lang string, kind int, place int, n bigint")
        .groupBy("lang", "kind", "place")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    langs = sorted({r["lang"] for r in found})
    tables = [np.zeros((len(langs), size)) for size in KINDS]
    at = {lang: k for k, lang in enumerate(langs)}
    for r in found:
        tables[r["kind"]][at[r["lang"]], r["place"]] = r["n"]
    return langs, tables


def used_scripts(scripts: np.ndarray) -> np.ndarray:
    """``(script, language)``: which languages use which scripts."""
    total = scripts.sum(axis=1, keepdims=True)
    allowed = scripts >= SCRIPT_SHARE * np.maximum(total, 1)
    return (allowed & (scripts > 0)).T.copy()


def fit(docs: DataFrame) -> dict:
    """Log shares of the trigrams of every language, and the scripts it uses; see ``counted``."""
    langs, (buckets, scripts, _, _) = counted(docs)
    smooth = 0.5
    logs = np.log((buckets + smooth) / (buckets.sum(axis=1, keepdims=True) + smooth * BUCKETS))
    return {"langs": langs, "logs": logs.T.astype(np.float32).copy(), "allowed": used_scripts(scripts)}


def independent(byte: np.ndarray, pattern: np.ndarray) -> np.ndarray:
    """Shares of the buckets where trigrams keep their classes of bytes, but not which bytes follow which."""
    share = byte + 0.5
    for c in range(CLASSES):
        share[_CLASS == c] /= share[_CLASS == c].sum()
    share[32] = 1.0
    patterns = ((pattern + 0.5) / (pattern + 0.5).sum()).reshape(CLASSES, -1)
    rest = np.arange(1 << 16, dtype=np.uint32)
    here, right = rest >> 8, rest & 255
    both, pair = share[here] * share[right], _CLASS[here] * CLASSES + _CLASS[right]
    out = np.zeros(BUCKETS)
    for left in range(256):
        weights = share[left] * both * patterns[_CLASS[left]][pair]
        out += np.bincount(bucket(np.uint32(left << 16) | rest), weights=weights, minlength=BUCKETS)
    return out


def fit_odds(docs: DataFrame) -> dict:
    """Log odds of every language's trigrams against independent bytes of all of them, and the scripts it uses.

    Texts of a language lie above 0; those of none fall below, as they put the
    letters in other orders. What was seen of a language only a little is near 0.
    """
    langs, (buckets, scripts, byte, pattern) = counted(docs)
    plain = PRIOR * independent(byte.sum(axis=0), pattern.sum(axis=0))
    odds = np.log((buckets + plain) / (buckets.sum(axis=1, keepdims=True) + PRIOR)) - np.log(plain / PRIOR)
    return {"langs": langs, "odds": odds.T.astype(np.float32).copy(), "allowed": used_scripts(scripts)}


def distinct_words(found: text.Words, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First place of each distinct word, which one every word is, letters, and the languages that use one of its scripts."""
    _, first, which = np.unique(found.hashes(), return_index=True, return_inverse=True)
    letters = word_scripts(found, first)
    candidates = (letters[:, :, None] > 0) & model["allowed"][None]
    return first, which, letters.sum(axis=1), candidates.any(axis=1)


def word_scores(found: text.Words, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Per word: log scores of the languages below the best one's, and its letters.

    A word's scripts leave the languages that use one of them; words without
    letters, and of scripts that no language uses, say nothing.
    """
    first, which, letters, candidates = distinct_words(found, model)
    scores = np.zeros((len(first), len(model["langs"])), dtype=np.float32)
    some = np.flatnonzero(candidates.any(axis=1))
    if len(some):
        code, begin = codes(found, first[some])
        own = np.add.reduceat(model["logs"][bucket(code)], begin, axis=0)
        own[~candidates[some]] = -np.inf
        own = np.maximum(own - own.max(axis=1, keepdims=True), -WORST)
        scores[some] = own
    return scores[which], letters[which]


def word_odds(found: text.Words, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word: log odds of the languages and, last, of none of them; its letters; whether a language uses its script.

    Trigrams with digits or ASCII punctuation say nothing, nor do words without
    letters and of scripts that no language uses.
    """
    first, which, letters, candidates = distinct_words(found, model)
    langs = len(model["langs"])
    odds = np.zeros((len(first), langs + 1), dtype=np.float32)
    known = candidates.any(axis=1)
    some = np.flatnonzero(known)
    if len(some):
        code, begin = codes(found, first[some])
        lettered = (classes(code) != 2).all(axis=1)
        own = np.add.reduceat(model["odds"][bucket(code)] * lettered[:, None], begin, axis=0)
        own[~candidates[some]] = -WORST
        odds[some, :langs] = np.clip(own, -WORST, WORST)
    return odds[which], letters[which], known[which]


def best_paths(scores: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """The language of every word on the best path of its row; a change costs ``SWITCH``.

    All rows are walked at once, longest first, so step ``t`` is one small
    operation over the rows that still have a word ``t``.
    """
    count = np.bincount(row, minlength=rows)
    begin = np.cumsum(count) - count
    order = np.argsort(-count, kind="stable")
    order = order[count[order] > 0]
    count, begin = count[order], begin[order]
    active = np.searchsorted(-count, -np.arange(1, (count[0] if len(count) else 0) + 1), side="right")
    came = np.zeros(len(scores), dtype=np.int16)  # where a change would come from
    stays = np.ones(scores.shape, dtype=bool)
    out = np.zeros(len(scores), dtype=np.int16)
    total = scores[begin].astype(np.float64) if len(begin) else np.zeros((0, scores.shape[1]))
    for t in range(1, len(active)):
        n = active[t]
        at = begin[:n] + t
        best = total[:n].argmax(axis=1)
        change = total[np.arange(n), best][:, None] - SWITCH
        came[at] = best
        stays[at] = total[:n] >= change
        total[:n] = np.maximum(total[:n], change) + scores[at]
    state = total.argmax(axis=1) if len(total) else np.zeros(0, dtype=np.int64)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = begin[:n] + t
        out[at] = state[:n]
        if t:
            state[:n] = np.where(stays[at, state[:n]], state[:n], came[at])
    return out


def spans(column: pa.Array, model: dict) -> tuple[text.Words, np.ndarray, np.ndarray]:
    """Words, their languages by number, and their letters."""
    found = text.words(lowered(column))
    if not len(found.start) or not model["langs"]:
        return found, np.zeros(len(found.start), dtype=np.int16), np.zeros(len(found.start), dtype=np.int64)
    scores, letters = word_scores(found, model)
    return found, best_paths(scores, found.row, found.rows), letters


def verdicts(column: pa.Array, model: dict) -> tuple[list[str], np.ndarray]:
    """Language with most letters, and its share of all letters; ``und`` without letters."""
    found, path, letters = spans(column, model)
    langs = len(model["langs"])
    lettered = np.array(pc.fill_null(pc.match_substring_regex(column.cast(pa.string()), r"\p{L}"), False).to_pylist(), dtype=bool)
    if not langs:
        return ["und"] * len(column), np.zeros(len(column))
    weights = np.bincount(found.row * langs + path, weights=letters, minlength=len(column) * langs)
    weights = weights.reshape(len(column), langs)
    total = weights.sum(axis=1)
    # letters of unknown scripts only: the path says nothing, all languages are alike
    share = np.where(total > 0, weights.max(axis=1) / np.maximum(total, 1), 1 / langs)
    best = weights.argmax(axis=1)
    names = [model["langs"][b] if ok else "und" for b, ok in zip(best, lettered, strict=True)]
    return names, np.where(lettered, share, 0.0)


def learned_shares(column: pa.Array, model: dict) -> np.ndarray:
    """Share of the letters of every text that lie in spans of learned languages; 0 without letters.

    On its best path a text may also leave all languages and come back, at the
    cost of two changes wherever the span lies, if independent bytes explain its
    words that much better. So words that say too little stay in a language.
    """
    found = text.words(lowered(column))
    if not len(found.start) or not model["langs"]:
        return np.zeros(len(column))
    odds, letters, known = word_odds(found, model)
    count = found.counts[found.counts > 0]
    for edge in (np.cumsum(count) - count, np.cumsum(count) - 1):
        odds[edge, -1] -= SWITCH
    learned = known & (best_paths(odds, found.row, found.rows) < len(model["langs"]))
    total = np.bincount(found.row, weights=letters, minlength=len(column))
    return np.bincount(found.row, weights=letters * learned, minlength=len(column)) / np.maximum(total, 1)


def languages(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every row of ``docs``.

    ``score`` is the share of the letters that lie in spans of ``lang_pred``. Null
    texts and texts without a letter are ``und`` with score 0, and so are all where
    there is nothing to learn from. Repeated rows score alike; an empty table gives
    no rows.
    """
    model = fit(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.chunks(batches):
            names, share = verdicts(batch.column("text"), model)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "held_out": batch.column("held_out"),
                    "lang_pred": pa.array(names, type=pa.string()),
                    "score": pa.array(share.astype(np.float64)),
                }
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string"), held_out().alias("held_out")
    )
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def language_spans(docs: DataFrame, model: dict) -> DataFrame:
    """``(doc_id, first_word, words, lang)``: the runs of words of one language, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.chunks(batches):
            found, path, _ = spans(batch.column("text"), model)
            if not len(path):
                continue
            new = np.ones(len(path), dtype=bool)
            new[1:] = (path[1:] != path[:-1]) | (found.row[1:] != found.row[:-1])
            first = np.flatnonzero(new)
            begin = np.cumsum(found.counts) - found.counts
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").take(pa.array(found.row[first])),
                    "first_word": pa.array((first - begin[found.row[first]]).astype(np.int64)),
                    "words": pa.array(np.diff(np.concatenate([first, [len(path)]])).astype(np.int64)),
                    "lang": pa.array([model["langs"][p] for p in path[first]], type=pa.string()),
                }
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id bigint, first_word bigint, words bigint, lang string")


#: A document is rejected where spans of learned languages fill less than this share of its letters.
LEAST_SHARE = 0.5


def with_language(docs: DataFrame, least: float = LEAST_SHARE) -> DataFrame:
    """The rows of ``docs``, all their columns, with letters of which learned languages fill ``least``."""
    model = fit_odds(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.chunks(batches):
            share = learned_shares(batch.column("text"), model)
            yield batch.filter(pa.array((share > 0) & (share >= least)))

    return docs.mapInArrow(run, docs.schema)
