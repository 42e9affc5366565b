"""Quality by compression: dictionaries of good and of bad text, and which one shortens a text more.

Two zstandard dictionaries are built from sampled pieces of good and of bad texts.
A text is cut into pieces of ``PIECE`` bytes, so that its own earlier words don't
stand in for a dictionary, and each piece is compressed with either dictionary and
with none. Summed over all pieces of the whole text, the difference of the two sizes
and what the text loses without a dictionary, both over the text's bytes, go through
a logistic curve that is fitted on labelled texts the dictionaries have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vertexmill.llm import text

#: Bytes that are compressed at a time, of a dictionary, and the compressor's level.
PIECE, DICTIONARY, LEVEL = 512, 1 << 16, 3

#: Labelled documents of a class whose pieces make its dictionary at most, as many again
#: fit the curve (those of the lowest id hashes), and pieces a dictionary is built from.
SAMPLE, PIECES = 2000, 8000

#: From this score a text counts as good.
THRESHOLD = 0.3

#: Pull of the curve's slopes to zero, in rows.
RIDGE = 1e-2


def held_out():
    """Whether a row's label may not be learned; rows without an id have none."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def chosen_rows(labels: DataFrame) -> tuple[DataFrame, dict[bool, int]]:
    """``(doc_id, good, builds)`` of at most ``4 * SAMPLE`` learned rows, and all learned rows a class.

    An id with labels of both kinds says nothing and is left out.
    """
    marked = (
        labels.select(F.col("doc_id").cast("bigint"), F.col("quality").cast("bigint"))
        .filter("quality IN (0, 1) AND doc_id IS NOT NULL")
        .filter(~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("least"), F.max("quality").alias("most"))
        .filter("least = most")
        .select("doc_id", (F.col("most") == 1).alias("good"), (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == 0).alias("builds"))
    )
    sizes = {r["good"]: r["n"] for r in marked.groupBy("good").agg(F.count("*").alias("n")).collect()}
    parts = [
        marked.filter((F.col("good") == good) & (F.col("builds") == builds)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
        for good in (True, False)
        for builds in (True, False)
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3]), sizes


def pieces(data: np.ndarray) -> list[np.ndarray]:
    """Views of ``PIECE`` bytes each, the last one shorter."""
    return [data[at : at + PIECE] for at in range(0, len(data), PIECE)]


def _sampled_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text.chunks(batches):
        data, offsets = text.raw_bytes(batch.column("text"))
        rows = [pieces(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        good = np.repeat(np.array(batch.column("good").to_pylist(), dtype=bool), [len(r) for r in rows])
        yield pa.RecordBatch.from_pydict({"good": pa.array(good), "piece": pa.array([p.tobytes() for r in rows for p in r], pa.binary())})


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; of too few samples to train on, their own bytes, the first ones last."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(reversed(samples))[-DICTIONARY:]


class Compressors:
    """Compressed bytes of texts with the good dictionary, with the bad one, and with none."""

    def __init__(self, good: bytes, bad: bytes):
        bare = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.compressors = [zstandard.ZstdCompressor(**bare)]
        for content in (bad, good):
            found = zstandard.ZstdCompressionDict(content)
            found.precompute_compress(level=LEVEL)
            self.compressors.insert(0, zstandard.ZstdCompressor(dict_data=found, **bare))

    def sizes(self, data: np.ndarray) -> list[int]:
        cut = pieces(data)
        return [sum(len(c.compress(p)) for p in cut) for c in self.compressors]


def differences(column: pa.Array, compressors: Compressors) -> np.ndarray:
    """Per row the two differences over the bytes of the text: good less bad dictionary, none less none at all."""
    data, offsets = text.raw_bytes(column)
    length = np.diff(offsets)
    out = np.zeros((len(length), 2))
    for k in np.flatnonzero(length):
        good, bad, plain = compressors.sizes(data[offsets[k] : offsets[k + 1]])
        out[k] = (good - bad) / length[k], plain / length[k] - 1.0
    return out


def curve(x: np.ndarray, good: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic fit by Newton's method: a slope for each column of ``x``, then the offset."""
    x = np.column_stack([x, np.ones(len(x))])
    pull = np.diag([RIDGE] * (x.shape[1] - 1) + [1e-9])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - good)) + pull @ w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + pull
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Dictionaries and curve from labelled rows of ``docs`` that are not held out.

    The driver gets at most ``2 * PIECES`` pieces and two figures of ``2 * SAMPLE``
    documents. Without labels of both kinds, the model knows only the share of good ones.
    """
    chosen, sizes = chosen_rows(labels)
    total = sum(sizes.values())
    model = {"share": sizes.get(True, 0) / total if total else 0.5, "good": b"", "bad": b"", "curve": None}
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).filter("text <> ''")
    # one text an id, the least, so that rows that share an id don't fill the sample
    sample = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "good", "builds").agg(F.min("text").alias("text"))
    cut = sample.filter("builds").select("good", "text").mapInArrow(_sampled_pieces, "good boolean, piece binary")
    # the same piece of many copies counts once
    cut = cut.distinct().withColumn("h", F.xxhash64("piece"))
    least = [cut.filter(F.col("good") == good).orderBy("h", "piece").limit(PIECES) for good in (True, False)]
    found: dict[bool, list[bytes]] = {True: [], False: []}
    for r in least[0].unionAll(least[1]).orderBy("h", "piece").collect():
        found[r["good"]].append(bytes(r["piece"]))
    if not found[True] or not found[False]:
        return model
    model |= {"good": dictionary(found[True]), "bad": dictionary(found[False])}
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = Compressors(shared.value["good"], shared.value["bad"])
        for batch in text.chunks(batches):
            x = differences(batch.column("text"), compressors)
            yield pa.RecordBatch.from_pydict({"good": batch.column("good"), "a": x[:, 0], "b": x[:, 1]})

    fitted = sample.filter("NOT builds").select("good", "text").mapInArrow(measured, "good boolean, a double, b double")
    points = sorted((r["good"], r["a"], r["b"]) for r in fitted.collect())
    shared.unpersist()
    good = np.array([p[0] for p in points], dtype=float)
    if 0 < good.sum() < len(good):
        share = np.where(good == 1, model["share"] / good.sum(), (1 - model["share"]) / (len(good) - good.sum()))
        # classes weigh as among all learned rows, however many the sample has of each
        model["curve"] = curve(np.array([p[1:] for p in points]), good, share * len(good))
    return model


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    ``score`` is the chance of label 1, from the whole text alone; null and empty texts
    get the share of good ones among the learned labels (0.5 where there are none), as
    all texts do where one kind of label is missing. Rows without a doc_id are scored and
    never learned; repeated rows give a row each; other columns of ``docs`` are not looked
    at. A very long text is handled alone, piece by piece.
    """
    model = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        compressors = Compressors(own["good"], own["bad"]) if own["curve"] is not None else None
        for batch in text.chunks(batches):
            _, offsets = text.raw_bytes(batch.column("text"))
            score = np.full(batch.num_rows, own["share"])
            if compressors:
                x = differences(batch.column("text"), compressors)
                fitted = 1 / (1 + np.exp(-np.clip(x @ own["curve"][:-1] + own["curve"][-1], -30, 30)))
                score = np.where(np.diff(offsets) > 0, fitted, score)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "held_out": batch.column("held_out"),
                    "score": pa.array(score),
                    "predicted": pa.array((score >= THRESHOLD).astype(np.int32)),
                }
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), held_out().alias("held_out"))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")
