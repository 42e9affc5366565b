"""Quality by compression, the Merkle manifest and conversation repair against independent versions."""

import zlib
from hashlib import sha256
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vertexmill.llm import compression, conversations, merkle, warc

FOLDER = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


# ------------------------------------------------------------------ 11 quality classifier


def junk(random, n):
    return " ".join(f"{w}{s}" for w, s in zip(random.choice(["the", "and", "of", "was"], n), random.choice(["###", "&&&", "$$$"], n)))


def prose(random, n):
    return " ".join("".join(random.choice(list("aeinrst"), 4)) for _ in range(n)) + "."


def quality_tables(spark, documents):
    random = np.random.default_rng(5)
    rows = [(k, junk(random, 60) if k % 3 == 0 else prose(random, 60), "en", "s") for k in range(240)]
    rows += [(None, junk(random, 40), None, None), (900, None, "en", "s"), (901, "", "en", "s"), (0, rows[0][1], "en", "s")]
    rows += [(902, prose(random, 60_000), "en", "s"), (903, " \n\t ", "en", "s"), (904, "x", None, None)]
    labels = [(k, int(k % 3 != 0), None) for k in range(240)] + [(5, 1, 0), (6, 1, 0), (None, 0, 1), (900, 0, 0), (777, 1, 1), (8, None, 0)]
    return documents(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), rows


def test_quality_scores_every_row_and_tells_held_out_texts_apart(spark, documents):
    docs, labels, rows = quality_tables(spark, documents)
    got = compression.quality_scores(docs, labels).collect()
    assert len(got) == len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    assert all(r["held_out"] == held(r["doc_id"]) for r in got)
    by_id = {r["doc_id"]: r["score"] for r in got}
    for k in range(240):
        if held(k):
            assert (by_id[k] >= 0.5) == (k % 3 != 0), k
    assert by_id[902] > 0.5 and by_id[None] < 0.5
    # 6 has labels of both kinds and 900 no text, so neither is learned; both texts without bytes score the share of good
    marked = {k: k % 3 != 0 for k in range(240) if not held(k) and k != 6} | {777: True, 900: False}
    marked = {k: v for k, v in marked.items() if not held(k)}
    assert by_id[900] == by_id[901] == pytest.approx(sum(marked.values()) / len(marked))
    again = compression.quality_scores(docs.repartition(3), labels.repartition(2)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_quality_without_labels_of_both_kinds_or_rows(spark, documents):
    docs, labels, rows = quality_tables(spark, documents)
    none = compression.quality_scores(docs, labels.limit(0)).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.5, 1)} and len(none) == len(rows)
    good = compression.quality_scores(docs, labels.filter("quality = 1 AND doc_id <> 6")).collect()
    assert {r["score"] for r in good} == {1.0}
    assert compression.quality_scores(docs.limit(0), labels).collect() == []


def test_differences_are_those_of_pieces_compressed_alone():
    import zstandard

    random = np.random.default_rng(2)
    texts = [junk(random, 300), prose(random, 500), "", "é" * 700, None]
    good, bad = [prose(random, 400).encode() * 3, junk(random, 300).encode() * 3]
    x = compression.differences(pa.array(texts), compression.Compressors(good, bad))
    for k, t in enumerate(texts):
        data = (t or "").encode()
        want = []
        for content in (good, bad, None):
            total = 0
            for at in range(0, len(data), 512):
                options = {"level": 3, "write_content_size": False, "write_dict_id": False}
                if content is not None:
                    options["dict_data"] = zstandard.ZstdCompressionDict(content)
                total += len(zstandard.ZstdCompressor(**options).compress(data[at : at + 512]))
            want.append(total)
        expected = ((want[0] - want[1]) / len(data), want[2] / len(data) - 1) if data else (0, 0)
        assert x[k] == pytest.approx(expected, abs=0.01)


def test_curve_fits_shares():
    x = np.array([[0.0], [0.0], [0.0], [0.0], [1.0], [1.0], [1.0], [1.0]])
    good = np.array([1, 0, 0, 0, 1, 1, 1, 0.0])
    w = compression.curve(x, good, np.ones(8))
    assert 1 / (1 + np.exp(-w[1])) == pytest.approx(0.25, abs=0.01)
    assert 1 / (1 + np.exp(-w.sum())) == pytest.approx(0.75, abs=0.01)


@needs_data
def test_quality_on_held_out_rows_of_the_tables(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    got = compression.quality_scores(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    good = [r["predicted"] for r in got if r["quality"] == 1]
    bad = [r["predicted"] for r in got if r["quality"] == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.3


# ------------------------------------------------------------------ 12 Merkle manifest


def brute_manifest(rows, fanout):
    """``{(doc_id, leaf, shown)}`` of all results, level by level over whole lists."""

    def h(parts):
        return sha256("".join(parts).encode()).hexdigest()

    def leaf(doc_id, text, lang, source, n_chars):
        return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text))

    def tree(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h(out[-1][k : k + fanout]) for k in range(0, len(out[-1]), fanout)])
        return out

    lower = str.maketrans(merkle.UPPER, merkle.LOWER)
    langs = {}
    for doc_id, text, lang, source, n_chars in rows:
        change = doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        own = leaf(doc_id, text, lang, source, n_chars)
        shown = leaf(doc_id, text.translate(lower) if change else text, lang, source, n_chars)
        langs.setdefault(lang, []).append((doc_id is not None, doc_id or 0, own, "" if shown == own else shown, shown, doc_id))
    order = sorted(langs, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {lang: (sorted(langs[lang]),) for lang in order}
    trees = {lang: (v[0], tree([x[2] for x in v[0]])) for lang, v in trees.items()}
    top = tree([trees[lang][1][-1][0] for lang in order])
    out = []
    for place_of, lang in enumerate(order):
        rows_of, levels = trees[lang]
        for place, (*_, shown, doc_id) in enumerate(rows_of):
            node, proof = shown, []
            for at0, some in ((place, levels), (place_of, top)):
                at = at0
                for level in some[:-1]:
                    run = level[at - at % fanout : at - at % fanout + fanout]
                    proof += run[: at % fanout] + run[at % fanout + 1 :]
                    run[at % fanout] = node
                    node, at = h(run), at // fanout
            out.append((doc_id, rows_of[place][2], levels[-1][0], top[-1][0], h(proof), node, node == top[-1][0]))
    return sorted(out, key=str)


def manifest_rows():
    rows = [(k, f"Text {k} Ä" + "x" * (k % 7), ["de", "en", "Ünd", "zz", None][min(k % 11, 4)], f"s{k % 3}", k) for k in range(150)]
    rows += [(None, "Null id", "en", None, None), (3, None, "en", "s", 1), (3, "", "en", "s", 1), (3, "", "en", "s", 1)]
    rows += [(500 + k, "ONE", f"l{k}", None, 3) for k in range(20)] + [(900, "Long " * 100_000, "", "s", -1)]
    return rows


@pytest.mark.parametrize(("fanout", "chunk_levels"), [(2, 0), (3, 1), (8, 4)])
def test_manifest_equals_whole_lists(spark, fanout, chunk_levels):
    rows = manifest_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for clash in ("g", "k", "leaf", "place", "node", "top"):
        docs = docs.withColumn(clash, F.lit("x"))
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    shown = F.when(hit, F.translate("text", merkle.UPPER, merkle.LOWER)).otherwise(F.col("text"))
    got = merkle.manifest(docs.repartition(5), shown={"text": shown}, fanout=fanout, chunk_levels=chunk_levels).collect()
    plain = [tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in got]
    assert sorted(plain, key=str) == brute_manifest(rows, fanout)
    for r in got:
        node, siblings = r["leaf"], []
        for step in r["proof"]:
            siblings += step["siblings"]
            run = list(step["siblings"])
            run.insert(step["at"], node)
            node = sha256("".join(run).encode()).hexdigest()
        assert node == r["root"]
        assert sha256("".join(siblings).encode()).hexdigest() == r["proof_sha256"]


def test_manifest_of_few_rows(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    assert merkle.tampered_documents(spark.createDataFrame([], schema)).collect() == []
    for rows in ([(1, "A", None, None, None)], [(2, "a", "en", "s", 1)] * 9):
        got = merkle.tampered_documents(spark.createDataFrame(rows, schema)).collect()
        assert sorted(map(tuple, got), key=str) == brute_manifest(rows, 8)


# ------------------------------------------------------------------ 13 conversation repair


def brute_repair(rows):
    """All results by a walk over rows and states that keeps every cheapest edit list; ``rows`` of one conversation."""
    after = []
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fault == 4:
            role = "user"
        after += [(turn is not None, turn or 0, role, text, turn)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    after = [(role, text, turn) for _, _, role, text, turn in sorted(after, key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))]
    blank = duplicate = truncated = 0
    seen, kinds = set(), []
    for role, text, _ in after:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        if not bare:
            kinds.append("x")
            blank += 1
        elif (role, text) in seen:
            kinds.append("x")
            duplicate += 1
        elif bare[-1] not in ".!?":
            kinds.append("t")
            truncated += 1
        else:
            kinds.append("")
        seen.add((role, text))
    # shortest paths by (cost, audit) over (row, place), inserts as edges
    steps = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    best, todo = {}, [(0, "", 0, 0, ())]
    import heapq

    while todo:
        cost, audit, i, place, lines = heapq.heappop(todo)
        if (i, place) in best:
            continue
        best[i, place] = (cost, audit, lines)
        for role in ("user", "assistant"):
            if role[0] in steps[place]:
                heapq.heappush(todo, (cost + 5, audit + "I", i, steps[place][role[0]], (*lines, f"{role}:")))
        if i < len(after):
            role, text, _ = after[i]
            heapq.heappush(todo, (cost + 2, audit + "D", i + 1, place, lines))
            extra = 5 * (kinds[i] == "t")
            if kinds[i] != "x":
                if role[:1] in steps[place] and role[:1]:
                    heapq.heappush(todo, (cost + extra, audit + "K", i + 1, steps[place][role[0]], (*lines, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    if new[0] in steps[place]:
                        heapq.heappush(todo, (cost + extra + 1, audit + "R", i + 1, steps[place][new[0]], (*lines, f"{new}:{text}")))
    cost, audit, lines = min(best[len(after), end] for end in (0, 3) if (len(after), end) in best)
    turns = [t for _, _, t in after if t is not None]
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(after, after[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (rows[0][0], gaps, blank, duplicate, truncated, illegal, cost, audit, sha256("\n".join(lines).encode()).hexdigest())


def conversation_rows():
    random = np.random.default_rng(9)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "sally", "User"]
    texts = ["Yes.", "No", "Why?", " ", None, "ok!", "Well, . ", "Größe.", "a\nb."]
    rows = []
    for conv in [*range(60), None, 1000]:
        n = int(random.integers(1, 9)) if conv != 1000 else 150
        for turn in range(n):
            own = None if random.random() < 0.05 else int(turn + (random.random() < 0.1) * random.integers(0, 4))
            rows.append((conv, own, roles[random.integers(0, len(roles))], texts[random.integers(0, len(texts))] if random.random() < 0.6 else f"t{conv}.{turn}."))
    rows += [(2000, 7, "user", "Same.")] * 40 + [(2001, None, None, None)] * 3 + [(2002, 1, "user", "Long " * 200_000 + ".")]
    rows += [(2003, t, ["user", "assistant"][t % 2], f"fine {t}.") for t in range(64)]
    return rows


@pytest.mark.parametrize("limits", [{}, {"long": 6, "block": 4, "merge": 3}, {"long": 0, "block": 1, "merge": 2}])
def test_repair_equals_shortest_paths(spark, limits):
    rows = conversation_rows()
    if limits.get("long") == 0:
        rows = [r for r in rows if r[0] in (1, 2, 3, None, 1000, 2000, 2001)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for clash in ("copies", "block", "place", "letter", "fault", "cells"):
        table = table.withColumn(clash, F.lit("x"))
    got = sorted(map(tuple, conversations.repair(table.repartition(5), **limits).collect()), key=str)
    by_id = {}
    for r in rows:
        by_id.setdefault(r[0], []).append(r)
    assert got == sorted((brute_repair(v) for v in by_id.values()), key=str)


def test_repair_of_nothing_and_of_dropped_rows(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    assert conversations.repair(spark.createDataFrame([], schema)).collect() == []
    dropped = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    for limits in ({}, {"long": 0, "block": 2}):
        got = conversations.repair(spark.createDataFrame([(dropped, 0, "user", "Hi.")], schema), **limits).collect()
        assert [tuple(r) for r in got] == [(dropped, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())]


def test_halves_give_the_cells_of_every_split():
    """The chart over all spans and all splits has the same cells as spans combined from halves."""
    random = np.random.default_rng(4)
    for _ in range(20):
        letters = "".join(random.choice(list("suaoSUAOx"), int(random.integers(1, 13))))
        chart = {(k, k + 1): conversations.row_cell(c) for k, c in enumerate(letters)}
        for size in range(2, len(letters) + 1):
            for i in range(len(letters) - size + 1):
                cells = [conversations.combined(chart[i, k], chart[k, i + size]) for k in range(i + 1, i + size)]
                assert all(c == cells[0] for c in cells)
                chart[i, i + size] = cells[0]
        assert chart[0, len(letters)] == conversations.span(letters)


def test_records_of_a_hot_payload_meet_in_several_tasks(spark, tmp_path):
    rows = [(k, "u", "" if k % 3 else f"<p>{k}</p>") for k in range(300)] + [(7, "u", ""), (7, "u", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    archive = warc.write_archive(warc.to_records(pages), str(tmp_path / "a"))
    hot = warc.hot_digests(spark.read.parquet(archive.headers), floor=50).collect()
    assert [r["copies"] for r in hot] == [5]  # 202 records at 50 a key
    shown = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "header", "payload"]
    plain = sorted(map(tuple, warc.read_archive(spark, archive).select(*shown).collect()), key=str)
    spread = warc.read_archive(spark, archive, floor=50)
    assert sorted(map(tuple, spread.select(*shown).collect()), key=str) == plain
    assert len(plain) == len(rows)
