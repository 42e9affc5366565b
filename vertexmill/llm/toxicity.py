"""Toxicity by a subsequence kernel machine over sentence pieces.

Words are compared with landmark words by the gap-weighted subsequence kernel,
so insults with inserted or left out characters still match. A sentence piece
has, for every landmark, the kernel value of its most similar word; the Nyström
map of the landmarks turns these into features of a linear support vector
machine, trained on pieces of labelled texts. A text scores as its worst piece.

Where no whole word tells, beginnings that many words share may: a second machine
looks at how many words of a text, and what share of them, begin with one that
toxic texts favour. It learns from the texts that the first one doesn't call toxic,
and a text scores by whichever of the two finds more.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vertexmill.llm import text
from vertexmill.llm.tables import written
from vertexmill.runtime import drop_written

#: Length of the subsequences and what a position they span weighs.
LENGTH, DECAY = 3, 0.6

#: Power of the normalised kernel, again a kernel; likenesses by chance fall off faster.
POWER = 2

#: A landmark is compared with a word that holds this share of its bytes in order; else the kernel counts as 0.
IN_ORDER = 0.6

#: Words of a sentence piece, longest word compared at once (longer ones in overlapping parts).
PIECE_WORDS, LONGEST = 16, 64

#: The documented bounds of the training sample: documents of either label, candidate
#: words, landmarks, pieces of either label.
TOXIC_DOCS, CLEAN_DOCS, SEEDS, LANDMARKS, PIECES = 3000, 6000, 2000, 48, 6000

#: Parts that the pieces of the sample are dealt to before the training rows are chosen.
PARTS = 8

#: A seed word stands at least in so many different surroundings in toxic documents.
LEAST_CONTEXTS = 4

#: Least log odds ratio of a seed word, toxic to clean surroundings.
LEAST_ODDS = 3.0

#: Nats by which a seed word's share of toxic surroundings beats the best of chance.
EVIDENCE = 3.0

#: Characters of the word beginnings that are counted, how many are kept, least log odds ratio of one.
STEM_CHARS, STEMS, STEM_ODDS = (4, 6), 500, 2.0

#: Words that a text is taken to have more when the share of its words is judged, so that short ones tell less.
SHARE_WORDS = 125

_EDGE = np.zeros(256, dtype=bool)
_EDGE[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?\n"]] = True


def subsequence_kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Kernel of each row of ``s`` with the same row of ``t`` (or its only row); 0 pads.

    Sums, over all common subsequences of ``LENGTH`` bytes, ``DECAY`` to the power
    of the positions they span in both.
    """
    n, width = s.shape
    equal = (s[:, :, None] == t[:, None, :]) & (s != 0)[:, :, None]
    wide = t.shape[1]
    total = np.zeros(n)
    before = np.ones((n, wide + 1))  # level 0 at the position before
    levels = [np.zeros((n, wide + 1)) for _ in range(LENGTH - 1)]
    for i in range(width):
        previous = before
        updates = []
        for level in range(LENGTH - 1):
            run = np.zeros(n)
            new = np.zeros((n, wide + 1))
            for j in range(wide):
                run = DECAY * run + DECAY**2 * equal[:, i, j] * previous[:, j]
                new[:, j + 1] = DECAY * levels[level][:, j + 1] + run
            updates.append(new)
            previous = levels[level]
        total += DECAY**2 * (equal[:, i, :] * previous[:, :wide]).sum(axis=1)
        levels = updates
    return total


def in_order(s: np.ndarray, landmark: bytes) -> np.ndarray:
    """Length of the longest common subsequence of each row and the landmark, bit-parallel."""
    masks = np.zeros(256, dtype=np.uint64)
    for k, c in enumerate(landmark):
        masks[c] |= np.uint64(1 << k)
    state = np.full(len(s), (1 << 63) - 1, dtype=np.uint64)
    for i in range(s.shape[1]):
        hit = state & masks[s[:, i]]
        state = (state + hit) | (state - hit)
    low = state & np.uint64((1 << len(landmark)) - 1)
    return len(landmark) - np.bitwise_count(low)


def padded(words: list[bytes] | text.Words, at: np.ndarray | None = None, width: int = 0) -> np.ndarray:
    if isinstance(words, text.Words):
        size = words.end[at] - words.start[at]
        take = words.start[at][:, None] + np.arange(width)
        inside = np.arange(width) < size[:, None]
        return np.where(inside, words.data[np.minimum(take, len(words.data) - 1)], 0)
    width = max(map(len, words))
    return np.array([list(w.ljust(width, b"\0")) for w in words], dtype=np.uint8)


def instances(column: pa.Array) -> text.Words:
    """Words without punctuation at their ends."""
    found = text.words(column)
    start, end, row = found.start.copy(), found.end.copy(), found.row
    for _ in range(4):
        start += _EDGE[found.data[np.minimum(start, len(found.data) - 1)]] & (end - start > 1)
        end -= _EDGE[found.data[end - 1]] & (end - start > 1)
    return text.Words(found.data, start, end, row, found.rows)


def beginnings(found: text.Words, chars: int) -> tuple[text.Words, np.ndarray]:
    """The first ``chars`` characters of all words that have as many, and the numbers of those words."""
    lead = np.flatnonzero((found.data & 0xC0) != 0x80)
    first = np.searchsorted(lead, found.start)
    at = np.flatnonzero(np.searchsorted(lead, found.end) - first >= chars)
    end = np.append(lead, len(found.data))[first[at] + chars]
    return text.Words(found.data, found.start[at], end, found.row[at], found.rows), at


def stem_hits(found: text.Words, stems: list[bytes]) -> np.ndarray:
    """Words per row that begin with a stem."""
    ends = np.cumsum([0, *map(len, stems)])
    data = np.frombuffer(b"".join(stems), dtype=np.uint8)
    known = text.Words(data, ends[:-1], ends[1:], np.zeros(len(stems), dtype=np.int64), 1).hashes()
    hit = np.zeros(len(found.start), dtype=bool)
    for chars in STEM_CHARS:
        begin, at = beginnings(found, chars)
        hit[at] |= np.isin(begin.hashes(), known)
    return np.bincount(found.row[hit], minlength=found.rows)


def density(hits: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Features of the second machine: how many words hit, and their share."""
    return np.stack([np.log1p(hits), np.log((hits + 0.5) / (words + SHARE_WORDS))], axis=1)


def pieces(found: text.Words) -> np.ndarray:
    """Number of the sentence piece of every word; pieces don't cross rows."""
    if not len(found.start):
        return np.zeros(0, dtype=np.int64)
    stops = np.concatenate([[0], np.cumsum(_STOP[found.data])])
    new = np.ones(len(found.start), dtype=bool)
    new[1:] = (found.row[1:] != found.row[:-1]) | (stops[found.start[1:]] != stops[found.end[:-1]])
    begin = np.flatnonzero(new)
    sentence = np.cumsum(new) - 1
    within = (np.arange(len(new)) - begin[sentence]) // PIECE_WORDS
    new[1:] |= within[1:] != within[:-1]
    return np.cumsum(new) - 1


def extra_words(found: text.Words, piece: np.ndarray) -> tuple[text.Words, np.ndarray]:
    """Add what no word shows as it stands, in the piece of the (first) word.

    Overlapping parts of words over ``LONGEST`` bytes, three or more one-byte words
    in a row as one (``i d i o t``), and words without the signs inside them.
    """
    size = found.end - found.start
    more: list[tuple[int, int, int]] = []  # start, end, piece
    for k in np.flatnonzero(size > LONGEST):
        for a in range(int(found.start[k]), int(found.end[k]), LONGEST // 2):
            more.append((a, min(a + LONGEST, int(found.end[k])), int(piece[k])))
    data = found.data
    single = np.flatnonzero(size == 1)
    spelled: list[np.ndarray] = []
    at = len(data)
    if len(single) >= LENGTH:
        cut = np.flatnonzero((np.diff(single) != 1) | (np.diff(found.row[single]) != 0)) + 1
        for run in np.split(single, cut):
            if len(run) >= LENGTH:
                for a in range(0, len(run), LONGEST // 2):
                    part = run[a : a + LONGEST]
                    spelled.append(data[found.start[part]])
                    more.append((at, at + len(part), int(piece[run[0]])))
                    at += len(part)
    inner = np.concatenate([[0], np.cumsum(_EDGE[data])])
    for k in np.flatnonzero((inner[found.end] > inner[found.start]) & (size > LENGTH) & (size <= LONGEST)):
        plain = data[found.start[k] : found.end[k]]
        plain = plain[~_EDGE[plain]]
        spelled.append(plain)
        more.append((at, at + len(plain), int(piece[k])))
        at += len(plain)
    if not more:
        return found, piece
    data = np.concatenate([data, *spelled]) if spelled else data
    a, b, p = (np.array(x, dtype=np.int64) for x in zip(*more, strict=True))
    start, end = np.concatenate([found.start, a]), np.concatenate([found.end, b])
    row = np.concatenate([found.row, np.zeros(len(a), dtype=found.row.dtype)])
    return text.Words(data, start, end, row, found.rows), np.concatenate([piece, p])


def kernel_table(found: text.Words, landmarks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Non-zero kernel values of all words as ``(word, landmark, value)``, normalised.

    Every distinct word is compared once.
    """
    size = found.end - found.start
    usable = np.flatnonzero((size >= LENGTH) & (size <= LONGEST))
    part = text.Words(found.data, found.start[usable], found.end[usable], found.row[usable], found.rows)
    _, one, which = np.unique(part.hashes(), return_index=True, return_inverse=True)
    own = [float(subsequence_kernel(padded([z]), padded([z]))[0]) for z in landmarks]
    words, marks, values = [], [], []
    lengths = (part.end - part.start)[one]
    for low in range(0, LONGEST, 8):
        group = np.flatnonzero((lengths > low) & (lengths <= low + 8))
        if not len(group):
            continue
        rows = padded(part, one[group], low + 8)
        passed = [np.flatnonzero(in_order(rows, z) >= max(LENGTH, int(np.ceil(IN_ORDER * len(z))))) for z in landmarks]
        any_of = np.unique(np.concatenate(passed)) if landmarks else np.zeros(0, dtype=np.int64)
        if not len(any_of):
            continue
        self_value = np.zeros(len(group))
        for a in range(0, len(any_of), 4096):
            block = rows[any_of[a : a + 4096]]
            self_value[any_of[a : a + 4096]] = subsequence_kernel(block, block)
        for k, hits in enumerate(passed):
            if len(hits):
                raw = subsequence_kernel(rows[hits], padded([landmarks[k]]))
                values.append((raw / np.sqrt(self_value[hits] * own[k])) ** POWER)
                words.append(group[hits])
                marks.append(np.full(len(hits), k))
    if not words:
        nothing = np.zeros(0, dtype=np.int64)
        return nothing, nothing, np.zeros(0)
    words, marks, values = np.concatenate(words), np.concatenate(marks), np.concatenate(values)
    # from distinct words to all their places
    order = np.argsort(which, kind="stable")
    count = np.bincount(which, minlength=len(one))
    begin = np.cumsum(count) - count
    n = count[words]
    at = np.repeat(begin[words], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return usable[order[at]], np.repeat(marks, n), np.repeat(values, n)


def piece_features(plain: text.Words, landmarks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, piece, features)`` of the pieces that have a non-zero feature."""
    piece = pieces(plain)
    row_of = np.zeros(int(piece[-1]) + 1 if len(piece) else 0, dtype=np.int64)
    row_of[piece] = plain.row
    found, piece = extra_words(plain, piece)
    word, mark, value = kernel_table(found, landmarks)
    own, place = np.unique(piece[word], return_inverse=True)
    features = np.zeros((len(own), len(landmarks)))
    np.maximum.at(features, (place, mark), value)
    return row_of[own], own, features


def nystrom(landmarks: list[bytes]) -> np.ndarray:
    """Inverse square root of the landmarks' own kernel matrix."""
    rows = padded(landmarks)
    gram = np.array([subsequence_kernel(rows, padded([z])) for z in landmarks])
    scale = np.sqrt(np.diag(gram))
    values, vectors = np.linalg.eigh((gram / scale[:, None] / scale[None, :]) ** POWER)
    return vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T


def train_svm(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights and, last, the intercept of a squared-hinge machine; Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    sign = np.where(y, 1.0, -1.0)
    weight = np.where(y, 0.5 / max(1, y.sum()), 0.5 / max(1, (~y).sum()))
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-9
    for _ in range(30):
        inside = sign * (x @ w) < 1
        a = x[inside] * weight[inside, None]
        new = np.linalg.solve(a.T @ x[inside] + np.diag(penalty), a.T @ sign[inside])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w


def calibrate(f: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve from decision values to probabilities."""
    a, b = 1.0, 0.0
    target = np.where(y, (y.sum() + 1) / (y.sum() + 2), 1 / ((~y).sum() + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * f + b, -30, 30)))
        d, h = p - target, p * (1 - p) + 1e-9
        g = np.array([(d * f).sum() + 1e-3 * a, d.sum()])
        hess = np.array([[(h * f * f).sum() + 1e-3, (h * f).sum()], [(h * f).sum(), h.sum()]])
        step = np.linalg.solve(hess, g)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
        if abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def text_values(plain: text.Words, model: dict) -> np.ndarray:
    """Decision value of every row: that of its worst piece."""
    out = np.full(plain.rows, model["bias"])
    if model["landmarks"]:
        row, _, features = piece_features(plain, model["landmarks"])
        np.maximum.at(out, row, features @ model["weights"] + model["bias"])
    return out


def learned_rows():
    """Rows that labels may be learned from."""
    return F.coalesce(~held_out(), F.lit(True))


def held_out():
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(crc % 5 == 0, F.lit(False))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(word, stem, context, toxic)``: a word, or the beginning of one, and the hash of its two neighbours."""
    for batch in text.chunks(batches):
        found = instances(batch.column("text"))
        n = len(found.start)
        if not n:
            continue
        h = found.hashes()
        left, right = np.roll(h, 1), np.roll(h, -1)
        edge = np.uint64(1)
        left[np.concatenate([[True], found.row[1:] != found.row[:-1]])] = edge
        right[np.concatenate([found.row[1:] != found.row[:-1], [True]])] = edge
        toxic = np.array(batch.column("toxic").to_pylist(), dtype=bool)[found.row]
        context = text.fold(left, right)
        size = found.end - found.start
        whole = np.flatnonzero((size >= LENGTH) & (size <= 32))
        kinds = [(text.Words(found.data, found.start[whole], found.end[whole], found.row[whole], found.rows), whole)]
        kinds += [beginnings(found, chars) for chars in STEM_CHARS]
        for k, (part, at) in enumerate(kinds):
            own = text.fold(text.fold(part.hashes(), context[at]), toxic[at].astype(np.uint64))
            _, first = np.unique(own, return_index=True)
            if len(first):
                yield pa.RecordBatch.from_pydict(
                    {
                        "word": pa.array([part.word(j) for j in first], type=pa.binary()),
                        "stem": pa.array(np.full(len(first), k > 0)),
                        "context": pa.array(context[at[first]].view(np.int64)),
                        "toxic": pa.array(toxic[at[first]]),
                    }
                )


def _choose_landmarks(words: list[bytes], most: int) -> list[bytes]:
    """Words in the order given that no landmark before is much like; near ones yield to shorter ones."""
    chosen: list[bytes] = []
    if not words:
        return chosen
    for word in words:
        if chosen:
            rows, one = padded(chosen), padded([word])
            near = subsequence_kernel(rows, one) / np.sqrt(
                subsequence_kernel(rows, rows) * subsequence_kernel(one, one)
            )
            k = int(near.argmax())
            if near[k] >= 0.45:
                if len(word) < len(chosen[k]):
                    chosen[k] = word
                continue
        if len(chosen) < most:
            chosen.append(word)
    return list(dict.fromkeys(chosen))


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """A model from labelled rows of ``docs`` that are not held out.

    The sample is bounded by ``TOXIC_DOCS`` and ``CLEAN_DOCS`` (lowest hashes of the
    ids), and so is all that reaches the driver: ``SEEDS`` words, ``STEMS`` beginnings, and ``PIECES``
    feature rows from each of ``PARTS`` tasks, of which twice ``PIECES`` are kept. Words count by the different surroundings they stand
    in, so copies of a text don't vote twice.
    """
    marked = (
        labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .filter(learned_rows())
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).alias("toxic"))
    )
    by_hash = F.xxhash64("doc_id")
    chosen = (
        marked.filter("toxic").orderBy(by_hash).limit(TOXIC_DOCS)
        .unionAll(marked.filter("NOT toxic").orderBy(by_hash).limit(CLEAN_DOCS))
    )
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).filter("text IS NOT NULL")
    sample = written(rows.join(F.broadcast(chosen), "doc_id"), "toxicity-sample")
    empty = {"landmarks": [], "weights": np.zeros(0), "bias": -1.0, "slope": 1.0, "shift": 0.0, "stems": []}
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(True) or not sizes.get(False):
        drop_written(sample)
        return empty | {"shift": 3.0 if sizes.get(True) else 0.0}
    counts = (
        sample.mapInArrow(_contexts, "word binary, stem boolean, context bigint, toxic boolean")
        .distinct()
        .groupBy("word", "stem")
        .agg(F.count_if("toxic").alias("p"), F.count_if(~F.col("toxic")).alias("n"))
    )
    counts = written(counts, "toxicity-counts")
    totals = counts.groupBy("stem").agg(F.sum("p").alias("p"), F.sum("n").alias("n"), F.count("*").alias("words")).collect()

    def telling(stem: bool, odds: float, most: int) -> list[tuple[bytes, int, int]]:
        """Words or beginnings that toxic texts favour, the most telling first, with their surroundings."""
        total = next((r for r in totals if r["stem"] == stem), None)
        if not total or not total["p"]:
            return []
        base = total["p"] / (total["p"] + total["n"])
        share = F.col("p") / (F.col("p") + F.col("n"))
        rest = F.when(F.col("n") > 0, F.col("n") * F.log((1 - share) / (1 - base))).otherwise(0.0)
        # how unlikely so large a share is by chance, in nats, over that of any word doing so
        evidence = F.col("p") * F.log(share / base) + rest - F.log(F.lit(float(total["words"])))
        found = (
            counts.filter(F.col("stem") == stem)
            .filter(F.col("p") >= LEAST_CONTEXTS)
            .filter(F.log(share / (1 - share + 1e-9)) > F.lit(log(base / max(1e-9, 1 - base)) + odds))
            .withColumn("evidence", evidence)
            .filter(F.col("evidence") > EVIDENCE)
            .orderBy(F.desc("evidence"), "word")
            .limit(most)
            .collect()
        )
        return [(bytes(r["word"]), r["p"], r["n"]) for r in found]

    seeds, stems = telling(False, LEAST_ODDS, SEEDS), telling(True, STEM_ODDS, STEMS)
    drop_written(counts)
    # a word that is a small part of a beginning that clean texts use too says no more than the beginning
    common = [(s, p) for s, p, n in stems if n >= LEAST_CONTEXTS]
    words = [w for w, p, _ in seeds if not any(w.startswith(s) and 2 * p < whole for s, whole in common)]
    pieces_model = _fit_pieces(sample, words)
    model = _fit_texts(sample, empty | pieces_model, [s for s, _, _ in stems])
    drop_written(sample)
    return model


def _fit_pieces(sample: DataFrame, seeds: list[bytes]) -> dict:
    """Landmarks, weights and bias of the piece machine; nothing where there is nothing to tell by."""
    landmarks = _choose_landmarks(seeds, LANDMARKS)
    if not landmarks:
        return {}
    seed_words = set(seeds)

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces with features: those of toxic texts that hold a seed, and those of clean texts."""
        for batch in text.chunks(batches):
            column = batch.column("text")
            toxic = np.array(batch.column("toxic").to_pylist(), dtype=bool)
            plain = instances(column)
            row, own, features = piece_features(plain, landmarks)
            piece = pieces(plain)
            seeded = {int(piece[k]) for k in range(len(piece)) if toxic[plain.row[k]] and plain.word(k) in seed_words}
            use = np.array([not toxic[r] or int(p) in seeded for r, p in zip(row, own, strict=True)], dtype=bool)
            if use.any():
                yield pa.RecordBatch.from_pydict(
                    {
                        "toxic": pa.array(toxic[row[use]]),
                        "top": pa.array(features[use].max(axis=1)),
                        "features": pa.array(list(features[use]), type=pa.list_(pa.float64())),
                    }
                )

    made = sample.mapInArrow(labelled, "toxic boolean, top double, features array<double>")
    # in so few parts that the driver gets at most as many times PIECES rows, however many tasks the sample has
    made = written(made.repartition(PARTS), "toxicity-pieces")
    # of clean pieces half are the most like a landmark, half any
    spread = F.xxhash64("features")
    picked = [
        made.filter("toxic").orderBy(spread).limit(PIECES),
        made.filter("NOT toxic").orderBy(F.desc("top"), spread).limit(PIECES // 2),
        made.filter("NOT toxic").orderBy(spread).limit(PIECES // 2),
    ]
    got = [r for part in picked for r in part.collect()]
    drop_written(made)
    if not any(r["toxic"] for r in got):
        return {}
    root = nystrom(landmarks)
    x = np.array([r["features"] for r in got])
    y = np.array([r["toxic"] for r in got])
    if y.all():
        x, y = np.vstack([x, np.zeros((1, len(landmarks)))]), np.append(y, False)
    w = train_svm(x @ root, y)
    return {"landmarks": landmarks, "weights": root @ w[:-1], "bias": float(w[-1])}


def _fit_texts(sample: DataFrame, model: dict, stems: list[bytes]) -> dict:
    """The model with its calibration, and with the second machine where the first leaves it something to find."""
    if not model["landmarks"] and not stems:
        return model

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.chunks(batches):
            plain = instances(batch.column("text"))
            yield pa.RecordBatch.from_pydict(
                {
                    "toxic": batch.column("toxic"),
                    "value": pa.array(text_values(plain, model)),
                    "hits": pa.array(stem_hits(plain, stems).astype(np.int64)),
                    "words": pa.array(plain.counts.astype(np.int64)),
                }
            )

    told = sample.mapInArrow(values, "toxic boolean, value double, hits bigint, words bigint").collect()
    y, value, hits, words = (np.array([r[c] for r in told]) for c in ("toxic", "value", "hits", "words"))
    if model["landmarks"]:
        slope, shift = calibrate(value, y)
        model = model | {"slope": slope, "shift": shift}
    left = (hits > 0) & (model["slope"] * value + model["shift"] < 0)
    if (y & left).sum() < LEAST_CONTEXTS:
        return model
    x, y = density(hits[left], words[left]), y[left]
    if y.all():
        x, y = np.vstack([x, density(np.zeros(1), np.zeros(1))]), np.append(y, False)
    w = train_svm(x, y)
    slope, shift = calibrate(x @ w[:-1] + w[-1], y)
    return model | {"stems": stems, "stem_weights": slope * w[:-1], "stem_shift": slope * w[-1] + shift}


def _scores(column: pa.Array, model: dict) -> np.ndarray:
    plain = instances(column)
    raw = model["slope"] * text_values(plain, model) + model["shift"]
    if model["stems"]:
        hits = stem_hits(plain, model["stems"])
        dense = density(hits, plain.counts) @ model["stem_weights"] + model["stem_shift"]
        raw = np.where(hits > 0, np.maximum(raw, dense), raw)
    return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    Null and empty texts score as a text without any likeness to a landmark.
    Without labels of both kinds every text scores the same. Repeated rows score
    alike; a null doc_id is never learned from. An empty table gives no rows.
    """
    model = fit(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.chunks(batches):
            score = _scores(batch.column("text"), model)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "held_out": batch.column("held_out"),
                    "score": pa.array(score),
                    "predicted": pa.array((score >= 0.5).astype(np.int32)),
                }
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string"), held_out().alias("held_out")
    )
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns, that score below 0.5."""
    model = fit(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.chunks(batches):
            yield batch.filter(pa.array(_scores(batch.column("text"), model) < 0.5))

    return docs.mapInArrow(run, docs.schema)
