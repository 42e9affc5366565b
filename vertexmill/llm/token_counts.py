"""Greedy longest-match piece counts by a trie automaton with failure links.

Where a word leaves the trie, the failure link says how many pieces are done and
where the rest goes on, so a word takes linear time and no piece is ever built.
The automaton walks all distinct words of a batch at once.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vertexmill.llm import text

#: Vocabulary that the query counts with: lines of base64 bytes and rank.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def read_vocabulary(path: str = VOCABULARY) -> list[bytes]:
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


def automaton(pieces: list[bytes]) -> dict[str, np.ndarray]:
    """Edges ``node * 256 + byte -> node`` sorted, failure links, and pieces done by taking one.

    ``done`` counts the pieces that a failure link closes, ``rest`` those of a word that
    ends at a node. All 256 single bytes must be pieces, so every word can be cut.
    """
    if len({p for p in pieces if len(p) == 1}) < 256:
        raise ValueError("the vocabulary must hold all single bytes")
    children: list[dict[int, int]] = [{}]
    whole = [False]
    for piece in pieces:
        node = 0
        for byte in piece:
            if byte not in children[node]:
                children[node][byte] = len(children)
                children.append({})
                whole.append(False)
            node = children[node][byte]
        whole[node] = node != 0
    link, done = [-1] * len(children), [0] * len(children)
    queue = deque([0])
    while queue:
        node = queue.popleft()
        for byte, child in children[node].items():
            if whole[child]:
                link[child], done[child] = 0, 1
            else:
                at, closed = link[node], done[node]
                while byte not in children[at]:
                    closed += done[at]
                    at = link[at]
                link[child], done[child] = children[at][byte], closed
            queue.append(child)
    rest = [0] * len(children)
    depth_first = deque([0])
    order = []
    while depth_first:
        node = depth_first.popleft()
        order.append(node)
        depth_first.extend(children[node].values())
    for node in order[1:]:  # a link goes to a node nearer to the root
        rest[node] = done[node] + rest[link[node]]
    edges = sorted((node * 256 + byte, child) for node, own in enumerate(children) for byte, child in own.items())
    keys, targets = np.array(edges, dtype=np.int64).T
    return {
        "keys": np.ascontiguousarray(keys), "targets": np.ascontiguousarray(targets),
        "link": np.array(link), "done": np.array(done), "rest": np.array(rest),
    }


def piece_counts(words: text.Words, at: np.ndarray, a: dict[str, np.ndarray]) -> np.ndarray:
    """Pieces of the words ``at``, each read with a space before it."""
    size = (words.end - words.start)[at]
    order = np.argsort(-size, kind="stable")
    start, size = words.start[at][order], size[order]
    keys, targets, link, done = a["keys"], a["targets"], a["link"], a["done"]
    count = np.zeros(len(at), dtype=np.int64)
    state = np.zeros(len(at), dtype=np.int64)
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(1, longest + 1), side="right")
    for t in range(-1, longest):
        n = len(at) if t < 0 else int(active[t])
        byte = np.full(n, 32, dtype=np.int64) if t < 0 else words.data[start[:n] + t].astype(np.int64)
        open_words = np.arange(n)
        while len(open_words):
            want = state[open_words] * 256 + byte[open_words]
            place = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            hit = keys[place] == want
            state[open_words[hit]] = targets[place[hit]]
            open_words = open_words[~hit]
            count[open_words] += done[state[open_words]]
            state[open_words] = link[state[open_words]]
    out = np.empty(len(at), dtype=np.int64)
    out[order] = count + a["rest"][state]
    return out


def token_counts(docs: DataFrame, pieces: list[bytes] | None = None) -> DataFrame:
    """``(doc_id, n_bytes, n_words, n_tokens)`` for every row of ``docs``.

    ``n_tokens`` are the greedy longest-match pieces of all words, a word being
    read with the space before it. Null and empty texts have 0. Repeated rows are
    counted alike; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(automaton(pieces or read_vocabulary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.chunks(batches):
            found = text.words(batch.column("text"), lower=False)
            _, first, which = np.unique(found.hashes(), return_index=True, return_inverse=True)
            each = piece_counts(found, first, shared.value)[which] if len(first) else np.zeros(0)
            _, offsets = text.raw_bytes(batch.column("text"))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_bytes": pa.array(np.diff(offsets)),
                    "n_words": pa.array(found.counts.astype(np.int64)),
                    "n_tokens": pa.array(np.bincount(found.row, weights=each, minlength=found.rows).astype(np.int64)),
                }
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_words bigint, n_tokens bigint")
