"""A bigram model with interpolated modified Kneser-Ney smoothing.

Tasks count the bigrams of their training texts and send them in packed, sorted
blocks to shards by context. A shard merges its blocks and stores its bigrams as
sorted hash arrays; what it knows of single words goes on to word shards, which
are stored the same way. Scoring tasks map the arrays into memory and look up the
distinct bigrams of a few megabytes of text at a time, in sorted order.
"""

from __future__ import annotations

import mmap
import os
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vertexmill.llm import text
from vertexmill.llm.tables import scratch_path
from vertexmill.llm.text import fold

#: Words are told apart by 48 bits of their hash.
_WORD_BITS = np.uint64((1 << 48) - 1)
#: The context before the first word, and the token after the last; words have bit 2 set, these have not.
START, END = np.uint64(1), np.uint64(2)

#: Training tokens per shard, and per packed block of a task.
SHARD_TOKENS, BLOCK_TOKENS = 2_000_000, 3_000_000

#: A context with more than this share of all tokens is spread over the shards, so no
#: shard gets a hot one whole. At most 512 words can have it.
HEAVY_SHARE = 1 / 512


def held_out():
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(crc % 7 == 2, F.lit(False))


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, context and token of every position; each row ends in ``END``."""
    found = text.words(column)
    hashes = (found.hashes() & _WORD_BITS) | np.uint64(4)
    rows = found.rows
    n = found.counts
    row = np.repeat(np.arange(rows), n + 1)
    token = np.full(len(hashes) + rows, END, dtype=np.uint64)
    token[np.arange(len(hashes)) + found.row] = hashes
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[np.cumsum(n + 1) - (n + 1)] = START
    return row, context, token


def _pack_counts(n: np.ndarray) -> list[bytes]:
    """One byte a count; counts from 255 on follow in full."""
    large = n[n >= 255].astype("<i8")
    return [np.minimum(n, 255).astype(np.uint8).tobytes(), np.int64(len(large)).tobytes(), large.tobytes()]


def _six(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


class _Reader:
    """Reads back what was packed, in order."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def array(self, kind: str, n: int) -> np.ndarray:
        out = np.frombuffer(self.data, dtype=kind, count=n, offset=self.at)
        self.at += out.nbytes
        return out

    def one(self) -> int:
        return int(self.array("<i8", 1)[0])

    def six(self, n: int) -> np.ndarray:
        out = np.zeros((n, 8), dtype=np.uint8)
        out[:, :6] = self.array("u1", 6 * n).reshape(n, 6)
        return out.reshape(-1).view("<u8")

    def counts(self, n: int) -> np.ndarray:
        out = self.array("u1", n).astype(np.int64)
        large = self.array("<i8", self.one())
        out[out == 255] = large
        return out


def pack_bigrams(context: np.ndarray, word: np.ndarray, n: np.ndarray) -> bytes:
    """Rows sorted by context; a context is written once."""
    new = np.ones(len(context), dtype=bool)
    new[1:] = context[1:] != context[:-1]
    first = np.flatnonzero(new)
    runs = np.diff(np.concatenate([first, [len(context)]]))
    sizes = np.array([len(first), len(context)], dtype="<i8")
    return b"".join([sizes.tobytes(), _six(context[first]), *_pack_counts(runs), _six(word), *_pack_counts(n)])


def unpack_bigrams(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r = _Reader(data)
    contexts, total = r.one(), r.one()
    context = r.six(contexts)
    context = np.repeat(context, r.counts(contexts))
    return context, r.six(total), r.counts(total)


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, sorted, the place of the first row of each, and sums of the values."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    sums = [np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values]
    return (keys[first], order[first], *sums)


@dataclass
class Model:
    """Where the arrays are, and the numbers that hold for the whole model."""

    folder: str
    shards: int
    heavy: np.ndarray
    train_tokens: int
    vocabulary: int
    ends: int
    bigrams: int
    discounts: np.ndarray  # of bigram counts 0, 1, 2, 3 and more
    lower_discounts: np.ndarray  # of continuation counts
    lower_kept: float  # probability the word level leaves to unseen words
    sizes: dict[str, int]  # rows of every stored shard


def shard_of(context: np.ndarray, key: np.ndarray, heavy: np.ndarray, shards: int) -> np.ndarray:
    by = np.where(np.isin(context, heavy), key, text.mix64(context))
    return (by % np.uint64(shards)).astype(np.int64)


def heavy_words(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Contexts with over ``HEAVY_SHARE`` of the tokens, and the number of tokens.

    A task names the words that reach the share among its own tokens; a word
    that no task names can't reach it overall.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, words, counts = 0, np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        for batch in text.chunks(batches):
            _, context, _ = tokens(batch.column("text"))
            total += len(context)
            own, n = np.unique(context, return_counts=True)
            top = n >= HEAVY_SHARE * len(context) / 2
            words, _, counts = summed(np.concatenate([words, own[top]]), np.concatenate([counts, n[top]]))
        if total:
            named = counts >= HEAVY_SHARE * total / 2
            yield pa.RecordBatch.from_pydict(
                {
                    "word": pa.array(np.concatenate([words[named], [np.uint64(0)]]).view(np.int64)),
                    "n": pa.array(np.concatenate([counts[named], [total]]).astype(np.int64)),
                }
            )

    found = (
        docs.select("text").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    )
    total = found.filter("word = 0").agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    rows = found.filter((F.col("word") != 0) & (F.col("n") >= HEAVY_SHARE * total / 2)).orderBy("word").collect()
    return np.array([r["word"] for r in rows], dtype=np.int64).view(np.uint64), total


def local_folder(path: str) -> str:
    """The shared folder as every worker has it mounted; arrays are mapped from it."""
    parsed = urlparse(path)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"the model's folder must be mounted on all workers, not {path}")
    return parsed.path


def _store(folder: str, name: str, *arrays: np.ndarray) -> None:
    """Write arrays one after the other; a repeated task replaces the file by an equal one."""
    path = f"{folder}/{name}"
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as out:
        np.array([len(arrays[0])], dtype="<i8").tofile(out)
        for a in arrays:
            a.tofile(out)
    os.replace(part, path)


def _counter(heavy: np.ndarray, shards: int):
    def pack(context: np.ndarray, word: np.ndarray) -> Iterator[pa.RecordBatch]:
        key = fold(context, word)
        key, at, n = summed(key, np.ones(len(key), dtype=np.int64))
        context, word = context[at], word[at]
        shard = shard_of(context, key, heavy, shards)
        order = np.lexsort((context, shard))
        shard, context, word, n = shard[order], context[order], word[order], n[order]
        cut = np.searchsorted(shard, np.arange(shards + 1))
        for k in np.flatnonzero(np.diff(cut)):
            a, b = cut[k], cut[k + 1]
            data = pack_bigrams(context[a:b], word[a:b], n[a:b])
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([int(k)], type=pa.int32()), "data": pa.array([data], type=pa.binary())}
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts, words, held = [], [], 0
        for batch in text.chunks(batches):
            _, context, word = tokens(batch.column("text"))
            contexts.append(context)
            words.append(word)
            held += len(word)
            if held >= BLOCK_TOKENS:
                yield from pack(np.concatenate(contexts), np.concatenate(words))
                contexts, words, held = [], [], 0
        if held:
            yield from pack(np.concatenate(contexts), np.concatenate(words))

    return run


def count_of_counts(n: np.ndarray) -> np.ndarray:
    return np.array([(n == k).sum() for k in (1, 2, 3, 4)], dtype=np.int64)


def discounts(found: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2, 3 and more, from counts of counts 1 to 4."""
    n1, n2 = found[0], found[1]
    share = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    out = [0.0]
    for k in (1, 2, 3):
        here, above = found[k - 1], found[k]
        d = k - (k + 1) * share * above / here if here and above else 0.5
        out.append(float(np.clip(d, 0.05, k - 0.05)))
    return np.array(out)


def _merge_bigrams(folder: str, shards: int):
    """Store a shard's bigrams; pass on what it knows of contexts and words."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        shard = int(frame["shard"].iloc[0])
        parts = [unpack_bigrams(data) for data in frame["data"]]
        context, word, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        key, at, n = summed(fold(context, word), n)
        context, word = context[at], word[at]
        _store(folder, f"bigrams-{shard}", key, np.minimum(n, 0xFFFFFFFF).astype("<u4"))
        contexts, _, total, n1, n2, n3 = summed(
            context, n, (n == 1).astype(np.int64), (n == 2).astype(np.int64), (n >= 3).astype(np.int64)
        )
        words, _, before = summed(word, np.ones(len(word), dtype=np.int64))
        rows = [(-1, np.concatenate([[shard, len(n)], count_of_counts(n)]).astype("<i8").tobytes())]
        by_c, by_w = contexts % np.uint64(shards), words % np.uint64(shards)
        order_c, order_w = np.argsort(by_c, kind="stable"), np.argsort(by_w, kind="stable")
        edges = np.arange(shards + 1, dtype=np.uint64)
        cut_c, cut_w = np.searchsorted(by_c[order_c], edges), np.searchsorted(by_w[order_w], edges)
        for k in range(shards):
            c, w = order_c[cut_c[k] : cut_c[k + 1]], order_w[cut_w[k] : cut_w[k + 1]]
            if len(c) or len(w):
                sizes = np.array([len(c), len(w)], dtype="<i8").tobytes()
                counts = [x for v in (total, n1, n2, n3) for x in _pack_counts(v[c])]
                rows.append(
                    (k, b"".join([sizes, _six(contexts[c]), *counts, _six(words[w]), *_pack_counts(before[w])]))
                )
        return pd.DataFrame(rows, columns=["shard", "data"])

    return run


def _merge_words(folder: str):
    """Store a word shard: context totals, their words by count, and continuation counts."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        shard = int(frame["shard"].iloc[0])
        if shard < 0:
            each = np.stack([np.frombuffer(d, dtype="<i8") for d in frame["data"]])
            told = [*each[:, 1:].sum(axis=0).tolist(), *each[:, :2].ravel().tolist()]
            return pd.DataFrame([(shard, 0, 0, 0, 0, told)], columns=NUMBERS_NAMES)
        keys, values = [], []
        for data in frame["data"]:
            r = _Reader(data)
            contexts, words = r.one(), r.one()
            keys.append(r.six(contexts))
            mine = np.zeros((contexts, 5), dtype=np.int64)
            for k in range(4):
                mine[:, k] = r.counts(contexts)
            values.append(mine)
            keys.append(r.six(words))
            mine = np.zeros((words, 5), dtype=np.int64)
            mine[:, 4] = r.counts(words)
            values.append(mine)
        table = np.concatenate(values)
        key, _, *columns = summed(np.concatenate(keys), *(table[:, k] for k in range(5)))
        _store(folder, f"words-{shard}", key, *(c.astype("<i8") for c in columns))
        total, before = columns[0], columns[4]
        seen = before[before > 0]
        told = [int((seen > 0).sum()), *(int(x) for x in count_of_counts(seen)), int((seen >= 3).sum())]
        start = int(total[key == START].sum())
        return pd.DataFrame(
            [(shard, len(key), int(total.sum()), int(((total > 0) & (key != START)).sum()), start, told)],
            columns=NUMBERS_NAMES,
        )

    return run


NUMBERS_NAMES = ["shard", "rows", "tokens", "words", "ends", "counts"]
NUMBERS = "shard int, rows bigint, tokens bigint, words bigint, ends bigint, counts array<bigint>"


def fit(docs: DataFrame) -> Model:
    """Train on all rows of ``docs(text)``; null texts are empty and count one end."""
    rows = docs.select(F.col("text").cast("string"))
    heavy, size = heavy_words(rows)
    shards = max(1, -(-size // SHARD_TOKENS))
    folder = local_folder(scratch_path(docs.sparkSession, "bigram-model"))
    os.makedirs(folder, exist_ok=True)
    numbers = (
        rows.mapInArrow(_counter(heavy, shards), "shard int, data binary")
        .groupBy("shard")
        .applyInPandas(_merge_bigrams(folder, shards), "shard int, data binary")
        .groupBy("shard")
        .applyInPandas(_merge_words(folder), NUMBERS)
        .collect()
    )
    bigrams = next((r["counts"] for r in numbers if r["shard"] < 0), [0] * 5)
    words = [r for r in numbers if r["shard"] >= 0]
    sizes = {f"bigrams-{shard}": n for shard, n in zip(bigrams[5::2], bigrams[6::2], strict=True)}
    sizes |= {f"words-{r['shard']}": r["rows"] for r in words}
    ends = sum(r["ends"] for r in words)
    level = np.sum([r["counts"] for r in words], axis=0) if words else np.zeros(6, dtype=np.int64)
    lower = discounts(level[1:5])
    kept = (lower[1] * level[1] + lower[2] * level[2] + lower[3] * level[5]) / bigrams[0] if bigrams[0] else 1.0
    return Model(
        folder, shards, heavy, sum(r["tokens"] for r in words),
        sum(r["words"] for r in words) + (ends > 0), ends, bigrams[0],
        discounts(np.array(bigrams[1:5])), lower, float(kept), sizes,
    )


#: Python before 3.13 keeps a file open for each mapping.
_UNTRACKED = {"trackfd": False} if sys.version_info >= (3, 13) else {}

#: Shards that a worker keeps mapped.
MOST_OPEN = 1024


class _Arrays:
    """A worker's view of a stored model: arrays mapped from the folder when first asked for.

    A mapping holds no open file. A shard that should be there and is not, or is not
    whole, is an error: read as empty it would turn known words into unknown ones.
    """

    def __init__(self, folder: str, sizes: dict[str, int]):
        self.folder, self.sizes, self.open = folder, sizes, {}

    def _mapped(self, name: str, kinds: list[str]) -> list[np.ndarray]:
        n = self.sizes.get(name, 0)
        if not n:
            return [np.zeros(0, dtype=kind) for kind in kinds]
        path = f"{self.folder}/{name}"
        try:
            with open(path, "rb") as file:
                data = np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ, **_UNTRACKED), dtype=np.uint8)
        except (OSError, ValueError) as error:
            raise RuntimeError(f"the language model has no shard {name} in {self.folder} on this worker") from error
        whole = 8 + n * sum(np.dtype(kind).itemsize for kind in kinds)
        if len(data) != whole or data[:8].view("<i8")[0] != n:
            raise RuntimeError(f"shard {path} of the language model should have {n} rows in {whole} bytes")
        out, at = [], 8
        for kind in kinds:
            size = n * np.dtype(kind).itemsize
            out.append(data[at : at + size].view(kind))
            at += size
        return out

    def get(self, name: str, kinds: list[str]) -> list[np.ndarray]:
        if name not in self.open:
            while len(self.open) >= MOST_OPEN:
                del self.open[next(iter(self.open))]
            self.open[name] = self._mapped(name, kinds)
        return self.open[name]

    def look_up(self, stem: str, kinds: list[str], shard: np.ndarray, keys: np.ndarray) -> list[np.ndarray]:
        """Values of sorted distinct keys; 0 where a key is not stored."""
        out = [np.zeros(len(keys), dtype=np.int64) for _ in kinds[1:]]
        order = np.argsort(shard, kind="stable")
        cut = np.searchsorted(shard[order], np.arange(shard.max() + 2)) if len(shard) else [0]
        for k in range(len(cut) - 1):
            own = order[cut[k] : cut[k + 1]]
            if not len(own):
                continue
            stored, *columns = self.get(f"{stem}-{k}", kinds)
            if not len(stored):
                continue
            at = np.minimum(np.searchsorted(stored, keys[own]), len(stored) - 1)
            hit = stored[at] == keys[own]
            for o, c in zip(out, columns, strict=True):
                o[own[hit]] = c[at[hit]]
        return out


def score_rows(column: pa.Array, model: Model, arrays: _Arrays) -> dict[str, np.ndarray]:
    """Tokens, known tokens, base score and model score of every row."""
    row, context, token = tokens(column)
    rows = len(column)
    words, at = np.unique(np.concatenate([context, token]), return_inverse=True)
    shard = (words % np.uint64(model.shards)).astype(np.int64)
    total, n1, n2, n3, before = arrays.look_up("words", ["<u8", *["<i8"] * 5], shard, words)
    count = np.where(words == END, model.ends, np.where(words == START, 0, total))
    base = np.log10((count + 1) / (model.train_tokens + model.vocabulary + 1))
    seen = max(1, model.bigrams)
    cut = lambda n, d: np.maximum(n - d[np.minimum(n, 3)], 0)
    word_level = cut(before, model.lower_discounts) / seen + model.lower_kept / (model.vocabulary + 1)
    d = model.discounts
    kept = np.where(total > 0, (d[1] * n1 + d[2] * n2 + d[3] * n3) / np.maximum(total, 1), 1.0)

    left, right = at[: len(token)], at[len(token) :]
    keys, first, place = np.unique(fold(context, token), return_index=True, return_inverse=True)
    shard = shard_of(context[first], keys, model.heavy, model.shards)
    (n,) = arrays.look_up("bigrams", ["<u8", "<u4"], shard, keys)
    c, w = left[first], right[first]
    p = cut(n, d) / np.maximum(total[c], 1) + kept[c] * word_level[w]
    return {
        "n_tokens": np.bincount(row, minlength=rows),
        "n_known": np.bincount(row, weights=count[right] > 0, minlength=rows).astype(np.int64),
        "base_score": np.bincount(row, weights=base[right], minlength=rows),
        "score": np.bincount(row, weights=np.log10(p)[place], minlength=rows),
    }


SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint,"
    " base_score double, score double, perplexity double"
)


def score(docs: DataFrame) -> DataFrame:
    """Train on the rows that are not held out and score all rows of ``docs``.

    ``score`` is the log10 probability of the whole text and its end,
    ``base_score`` that of single words with one added to every count,
    ``perplexity`` follows from ``score``. Null and empty texts are one end token.
    A row without a doc_id is not held out; repeated rows count as often as they
    stand. With nothing to train on every token has probability 1 of 1 unknown
    word. A very long text is scored alone. An empty table gives no rows.

    Words are told apart by 48 bits of a hash: a word that was not trained on is taken
    for one of ``V`` trained ones with a chance of ``V / 2**48``, 4e-7 for a hundred million words.
    """
    model = fit(docs.filter(~held_out()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _Arrays(model.folder, model.sizes)
        for batch in text.chunks(batches):
            found = score_rows(batch.column("text"), model, arrays)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "held_out": batch.column("held_out"),
                    "n_tokens": pa.array(found["n_tokens"].astype(np.int64)),
                    "n_known": pa.array(found["n_known"]),
                    "train_tokens": pa.array(np.full(batch.num_rows, model.train_tokens, dtype=np.int64)),
                    "base_score": pa.array(found["base_score"]),
                    "score": pa.array(found["score"]),
                    "perplexity": pa.array(10 ** np.minimum(300, -found["score"] / found["n_tokens"])),
                }
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string"), held_out().alias("held_out")
    )
    return rows.mapInArrow(run, SCORES)
