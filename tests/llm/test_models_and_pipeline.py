"""Near duplicates, toxicity, languages and the pipeline against brute force and held-out rows."""

import zlib
from itertools import combinations
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vertexmill.llm import decontam, langid, minhash, mixing, text, toxicity

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")


def shingle_set(t, width=5):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute_components(rows, percent):
    ids = {d for d, _ in rows if d is not None}
    parent = {d: d for d in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(d, shingle_set(t)) for d, t in rows if d is not None]
    for (a, x), (b, y) in combinations(sets, 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {d: find(d) for d in ids}


# ------------------------------------------------------------------ 6 near duplicates


def test_sketches_fill_and_estimate():
    random = np.random.default_rng(1)
    for size in (1, 3, 40, 2000):
        both = random.integers(0, 1 << 62, size, dtype=np.uint64)
        other = both.copy()
        change = max(1, size // 10)
        other[:change] = random.integers(0, 1 << 62, change, dtype=np.uint64)
        rows = np.repeat([0, 1], size)
        made = minhash.sketch(rows, np.concatenate([both, other]), 2)
        assert (made != minhash._EMPTY).all()
        want = len(np.intersect1d(both, other)) / len(np.union1d(both, other))
        assert abs((made[0] == made[1]).mean() - want) < 0.2


def variants(random, base, n, edits):
    for _ in range(n):
        w = list(base)
        for _ in range(int(random.integers(0, edits + 1))):
            w[int(random.integers(len(w)))] = f"z{random.integers(1 << 30)}"
        yield " ".join(w)


def test_components_equal_brute_force(documents):
    """Chains, hot groups whose members are not all alike, copies, and odd rows."""
    random = np.random.default_rng(2)
    base = [f"b{k}" for k in range(120)]
    rows = [(k, t) for k, t in enumerate(variants(random, base, 120, 4), start=100)]
    rows += [(k, " ".join(f"u{k}x{j}" for j in range(30))) for k in range(300, 330)]
    rows += [(k, "exact copy of a text that is short") for k in (7, 5, 900)]
    chain = [f"c{k}" for k in range(100)]
    for k in range(8):  # neighbours alike, ends not
        chain[k * 12] = f"changed{k}"
        rows.append((500 + k, " ".join(chain)))
    rows += [(1, None), (2, ""), (3, " \n"), (4, "one two"), (6, "ONE two"), (8, "one"), (9, "w " * 30_000)]
    rows += [(None, "exact copy of a text that is short"), (None, "stands alone here"), (4, "one two")]
    for percent in (85, 80):
        want = brute_components(rows, percent)
        got = minhash.near_duplicates(documents([(d, t, "en", "s") for d, t in rows]), percent).collect()
        assert len(got) == len(rows)
        named = [r for r in got if r["doc_id"] is not None]
        assert {r["doc_id"]: r["component_id"] for r in named} == want
        assert all(r["kept"] == (r["component_id"] == r["doc_id"]) for r in named)
        sizes = {r["doc_id"]: r["n_shingles"] for r in named}
        assert all(sizes[d] == len(shingle_set(t)) for d, t in rows if d is not None)
        nameless = {(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None}
        assert nameless == {(5, False), (None, True)}


def test_rows_outside_a_component_are_all_compared(spark, documents):
    """Blocks smaller than a bucket still bring every outer row to every other one."""
    random = np.random.default_rng(4)
    coords = random.integers(0, 1 << 30, (60, minhash.SIZE)).astype("<u4")
    coords[:, :100] = coords[0, :100]  # all estimates lie above 100 of 128
    nodes = spark.createDataFrame([(k, bytearray(coords[k].tobytes())) for k in range(60)], "node bigint, sketch binary")
    key = int(minhash._band_keys(coords)[0, 0].astype(np.int64))
    members = spark.range(60).select(F.lit(key).alias("key"), F.col("id").alias("node"), F.lit(None).cast("bigint").alias("prev"))
    found = spark.range(40).selectExpr("id AS node", "0L AS component")
    docs = documents([(k, f"one two three four five six {k // 50}", "en", "s") for k in range(60)])
    old = minhash.OUTER, minhash.INNER
    minhash.OUTER, minhash.INNER = 7, 9
    try:
        blocks = minhash.open_blocks(members, found).collect()
        links = minhash.outside_links(members, found, nodes, docs, 90, 85, 5).collect()
    finally:
        minhash.OUTER, minhash.INNER = old
    met = set()
    for block in {r["block"] for r in blocks}:
        own = [r for r in blocks if r["block"] == block]
        met |= {frozenset((x["node"], y["node"])) for x in own for y in own if x["outer"] and y["inner"] and x["node"] != y["node"]}
    assert met == {frozenset(p) for p in combinations(range(60), 2) if max(p) >= 40}
    assert len(blocks) < 60 * 12
    parent = {k: 0 if k < 40 else k for k in range(60)}
    for r in links:
        assert (r["a"] // 50) == (r["b"] // 50)
        a, b = parent[r["a"]], parent[r["b"]]
        parent = {k: min(a, b) if v in (a, b) else v for k, v in parent.items()}
    assert {parent[k] for k in range(50)} == {0} and {parent[k] for k in range(50, 60)} == {50}


@pytest.mark.parametrize("per_task", [200_000, 9])
def test_components_of_long_chains_and_stars(spark, monkeypatch, per_task):
    monkeypatch.setattr(minhash, "LINKS", per_task)
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(300, 200), (200, 300)]
    got = minhash.components(spark.createDataFrame(links, "a bigint, b bigint").repartition(20)).collect()
    found = {r["node"]: r["component"] for r in got}
    assert len(got) == len(found) == 61 + 60 + 2
    assert {found[k] for k in range(61)} == {0} and {found[k] for k in range(100, 160)} == {100}
    assert found[200] == found[300] == 200


def test_no_documents_have_no_duplicates(documents):
    assert minhash.near_duplicates(documents([(1, "a", "en", "s")]).limit(0)).count() == 0
    assert minhash.near_duplicates(documents([(1, None, "en", "s")])).collect()[0]["component_id"] == 1


# ------------------------------------------------------------------ 9 toxicity


def brute_kernel(s, t, p=toxicity.LENGTH, decay=toxicity.DECAY):
    total = 0.0
    for a in combinations(range(len(s)), p):
        for b in combinations(range(len(t)), p):
            if all(s[i] == t[j] for i, j in zip(a, b, strict=True)):
                total += decay ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
    return total


def test_kernel_equals_its_definition():
    words = [b"idiot", b"id-iot", b"idxiot", b"toidi", b"abc"]
    for t in words:
        got = toxicity.subsequence_kernel(toxicity.padded(words), toxicity.padded([t]))
        assert np.allclose(got, [brute_kernel(s, t) for s in words])
    got = toxicity.in_order(toxicity.padded([b"xixdxixoxtx", b"toidi"]), b"idiot")
    assert got.tolist() == [5, 3]


def toxic_rows(n=400):
    random = np.random.default_rng(8)
    words = ["".join(random.choice(list("aehnorst"), random.integers(2, 8))) for _ in range(400)]
    insults = ["blockhead", "dimwit", "numbskull"]
    out = []
    for k in range(n):
        w = [words[int(x)] for x in random.integers(0, len(words), random.integers(20, 120))]
        bad = k % 4 == 0
        if bad:
            w[int(random.integers(len(w)))] = insults[k % 3]
        out.append((k, " ".join(w), int(bad)))
    return out


def test_toxic_words_are_learned_with_gaps(spark):
    rows = toxic_rows()
    held = [k for k, *_ in rows if zlib.crc32(str(k).encode()) % 5 == 0]
    extra = [(10_000, "then a dim-wit came"), (10_001, "then a d i m w i t came"), (10_002, None), (10_003, ""), (None, "a numbskull"), (10_004, "plain words " * 5000), (10_005, "x" * 3000 + "blockhead" + "y" * 90)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows] + extra, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, 1, y) for k, _, y in rows] + [(None, 1, 1), (3, 1, None)], "doc_id bigint, quality int, toxic int")
    docs = docs.withColumn("toxic", F.lit(9)).withColumn("score", F.lit("x"))
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    truth = {k: y for k, _, y in rows}
    assert len(got) == len(rows) + len(extra)
    assert all(got[k]["held_out"] for k in held)
    assert np.mean([got[k]["predicted"] == truth[k] for k in held]) >= 0.95
    assert [got[k]["predicted"] for k in (10_000, 10_001, None)] == [1, 1, 1]
    assert [got[k]["predicted"] for k in (10_002, 10_003, 10_004)] == [0, 0, 0]
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_beginnings_that_toxic_texts_favour_are_learned(spark):
    """No toxic word comes twice; toxic texts hold more words that begin alike, clean ones now and then one."""
    random = np.random.default_rng(9)
    tail = lambda n: "".join(random.choice(list("aehnorst"), n))
    rows = []
    for k in range(400):
        w = [tail(random.integers(2, 8)) for _ in range(random.integers(150, 300))]
        bad = k % 4 == 0
        for at in random.choice(len(w), random.integers(4, 8) if bad else int(k % 4 == 1), replace=False):
            w[at] = "réeux" + tail(5)
        rows.append((k, " ".join(w), int(bad)))
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id bigint, toxic int")
    told = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(docs, labels).collect()}
    held = [(told[k], y) for k, _, y in rows if zlib.crc32(str(k).encode()) % 5 == 0]
    assert np.mean([p for p, y in held if y]) >= 0.9
    assert np.mean([p for p, y in held if not y]) <= 0.05


def test_beginnings_are_cut_between_characters():
    found = toxicity.instances(pa.array(["réeuxle, abc ABCD", None, "ñññññ"]))
    begin, at = toxicity.beginnings(found, 4)
    assert [begin.word(k).decode() for k in range(len(at))] == ["réeu", "abcd", "ññññ"]
    assert toxicity.stem_hits(found, ["réeu".encode(), b"abc", b"abcd"]).tolist() == [2, 0, 0]


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a text"), (2, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    for given in (labels, labels.limit(0)):
        assert [r["predicted"] for r in toxicity.toxicity(docs, given).collect()] == [0, 0]
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


# ------------------------------------------------------------------ 10 languages


def brute_path(scores):
    """Best path by trying every change at every word."""
    n, langs = scores.shape
    best = [[float(x) for x in scores[0]]]
    back = []
    for t in range(1, n):
        row, came = [], []
        for lang in range(langs):
            options = [best[-1][o] - (0 if o == lang else langid.SWITCH) for o in range(langs)]
            came.append(int(np.argmax(options)))
            row.append(max(options) + float(scores[t, lang]))
        best.append(row)
        back.append(came)
    return max(best[-1])


def path_value(scores, path):
    change = sum(a != b for a, b in zip(path[:-1], path[1:], strict=True))
    return sum(float(scores[k, p]) for k, p in enumerate(path)) - langid.SWITCH * change


def test_paths_are_best():
    random = np.random.default_rng(6)
    sizes = [1, 40, 7, 40, 2]
    row = np.repeat(np.arange(len(sizes)), sizes)
    scores = -random.exponential(4, (len(row), 3)).astype(np.float32)
    path = langid.best_paths(scores, row, len(sizes) + 1)
    for k in range(len(sizes)):
        own = row == k
        assert np.isclose(path_value(scores[own], path[own]), brute_path(scores[own]), atol=1e-3)


def language_rows():
    random = np.random.default_rng(9)
    syllables = {"aa": ["ka", "mo", "ti", "ro"], "bb": ["sch", "ung", "ein", "lich"], "cc": ["ди", "но", "ва", "ты"]}
    out = []
    for k in range(300):
        lang = ("aa", "bb", "cc")[k % 3]
        w = ["".join(random.choice(syllables[lang], random.integers(1, 4))) for _ in range(int(random.integers(3, 40)))]
        out.append((k, " ".join(w), lang))
    return out


def test_languages_are_told_and_spans_found(spark):
    rows = language_rows()
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "123 !?", None), (1003, "日本語", None), (None, "kamotiro kaka momo titi", None), (1004, "KAMO " * 20_000, None)]
    docs = spark.createDataFrame(rows + odd, "doc_id bigint, text string, lang string").withColumn("held_out", F.lit("x"))
    got = {r["doc_id"]: r for r in langid.languages(docs).collect()}
    held = [(k, lang) for k, _, lang in rows if zlib.crc32(str(k).encode()) % 5 == 0]
    assert np.mean([got[k]["lang_pred"] == lang for k, lang in held]) >= 0.98
    assert [(got[k]["lang_pred"], got[k]["score"]) for k in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[1003]["lang_pred"] in ("aa", "bb", "cc") and got[1004]["lang_pred"] == got[None]["lang_pred"] == "aa"
    mixed = "kamo tiro kati moro tika roka " + "schein unglich einsch lichung scheinung einein " + "дино ваты ноди тыва"
    model = langid.fit(docs)
    found = langid.language_spans(spark.createDataFrame([(1, mixed)], "doc_id bigint, text string"), model).collect()
    assert [(r["first_word"], r["words"], r["lang"]) for r in found] == [(0, 6, "aa"), (6, 6, "bb"), (12, 4, "cc")]
    assert langid.languages(docs.limit(0)).count() == 0
    kept = langid.with_language(docs)
    assert kept.columns == docs.columns and not {1000, 1001, 1002} & {r["doc_id"] for r in kept.collect()}


# ------------------------------------------------------------------ pipeline


@needs_data
def brute_leak(doc, item):
    """Plain greedy tiling: the longest match of unmarked words first, then the item's share that is marked."""
    doc, item = (doc or "").lower().split(), (item or "").lower().split()
    least = min(decontam.LEAST_TILE, len(item))
    runs = {tuple(item[k : k + least]) for k in range(len(item) - least + 1)}
    starts = [p for p in range(len(doc) - least + 1) if tuple(doc[p : p + least]) in runs]
    marked_doc, marked_item = set(), set()
    while item and starts:
        best = (0, 0, 0)
        for q in range(len(item)):
            for p in starts:
                n = 0
                while (
                    p + n < len(doc) and q + n < len(item) and doc[p + n] == item[q + n]
                    and p + n not in marked_doc and q + n not in marked_item
                ):
                    n += 1
                if n > best[0]:
                    best = (n, p, q)
        n, p, q = best
        if n < least:
            break
        marked_doc.update(range(p, p + n))
        marked_item.update(range(q, q + n))
        # what a mark has cut off may begin anywhere
        starts = sorted({*starts, *(s + 1 for s in marked_doc if s + 1 < len(doc) and s + 1 not in marked_doc)})
    return bool(item) and len(marked_item) >= decontam.COVERAGE * len(item)


def test_every_stage_keeps_what_brute_force_keeps(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r for r in docs.collect()}
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        kept = {r["doc_id"]: r for r in after.collect()}
        assert after.count() == len(kept)
        if name != "mixing":
            assert after.columns == columns
            assert all(kept[d] == before[d] for d in kept)
        if name == "toxicity":
            told = toxicity.toxicity(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()
            want = {r["doc_id"] for r in told if not r["predicted"]}
        elif name == "language":
            want = {r["doc_id"] for r in langid.languages(docs).collect() if r["lang_pred"] != "und" and r["score"] >= 0.5}
        elif name == "near_duplicates":
            found = brute_components([(d, r["text"]) for d, r in before.items()], corpus_pipeline.SIMILARITY)
            want = {d for d, c in found.items() if d == c}
        elif name == "decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
            want = {d for d, r in before.items() if not any(brute_leak(r["text"], t) for _, t in items)}
        else:
            want = {r["doc_id"] for r in mixing.mix(docs).filter("copies > 0").collect()}
            assert after.columns == [*columns, "copies", "taken"]
        assert set(kept) == want, name
        docs = after


def test_stages_bear_odd_documents(spark, documents, tmp_path):
    body = " ".join(f"wort{k}" for k in range(40))
    rows = [(k, f"{body} nummer{k} " + " ".join(f"x{k}y{j}" for j in range(40)), "de", f"s{k % 3}") for k in range(30)]
    rows += [(1, rows[1][1], "de", "s1"), (None, rows[2][1], "de", None), (None, rows[2][1], "de", None), (50, None, None, None), (51, "", "de", "s"), (52, "12 34", "de", "s")]
    docs = documents(rows)
    spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, rows[5][1])], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for start in (docs, docs.limit(0)):
        at = start
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, at, str(tmp_path)).write.mode("overwrite").parquet(str(tmp_path / f"o-{name}-{start is docs}"))
            at = spark.read.parquet(str(tmp_path / f"o-{name}-{start is docs}"))
        if start is docs:
            assert at.filter("doc_id = 5").count() == 0 and at.count() > 5
            assert at.filter("doc_id = 1").count() <= 1
        else:
            assert at.count() == 0


def test_texts_in_three_languages_stay(spark):
    random = np.random.default_rng(4)
    letters = {"aa": "abcde", "bb": "fghij", "cc": "klmno"}
    made = lambda lang, n: " ".join("".join(random.choice(list(letters[lang]), 6)) for _ in range(n))
    rows = [(k, made(lang, 60), lang) for k, lang in enumerate(list(letters) * 20)]
    rows += [(1000, " ".join(made(lang, 40) for lang in letters), None), (1001, "12 34", None), (1002, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = {r["doc_id"] for r in langid.with_language(docs).collect()}
    assert kept == set(range(60)) | {1000}


def test_texts_in_no_learned_language_go(spark):
    random = np.random.default_rng(12)
    own, other = ["ka", "mo", "ti", "ro"], ["wyx", "guf", "pez", "akb", "itm", "ork"]
    made = lambda of, n: ["".join(random.choice(of, int(random.integers(2, 4)))) for _ in range(n)]
    greek, han = ["λο", "γος", "και", "την"], ["日本語の文章", "漢字かな交じり"]
    kept = {
        1000: made(own, 60), 1001: ["kamotiro"], 1002: [w + "@@@" for w in made(own, 60)],
        1003: made(own, 40) + made(other, 10), 1004: made(greek, 10) + made(own, 40), 1005: made(own, 30) + ["12", "x9"] * 90,
    }
    gone = {
        2000: made(other, 60), 2001: made(greek, 60), 2002: han * 9, 2003: made(own, 10) + made(other, 40),
        2004: made(greek, 40) + made(own, 10), 2005: ["12", "34"], 2006: [], 2007: [w + "." for w in made(other, 3000)],
    }
    odd = [(k, " ".join(words), None) for k, words in (kept | gone).items()] + [(3000, None, "aa")]
    docs = spark.createDataFrame(language_rows() + odd, "doc_id bigint, text string, lang string")
    got = {r["doc_id"] for r in langid.with_language(docs).collect()}
    assert got == set(range(300)) | set(kept)


def test_rows_that_share_or_lack_a_doc_id_keep_their_texts(spark, documents):
    body = lambda name: " ".join(f"{name}{k}" for k in range(40))
    rows = [
        (2, body("copied")), (5, body("copied")), (5, body("other")),  # 5 is a copy of 2, and something else
        (7, body("one")), (7, body("two")), (8, body("twice")), (8, body("twice")),
        (None, body("copied")), (None, body("lone")), (None, body("lone") + " end"), (None, ""), (None, " "), (9, ""),
    ]
    docs = documents([(d, t, "en", "s") for d, t in rows])
    docs = docs.withColumns({c: F.lit("x") for c in ("_key", "_salt", "_side_stays", "stays", "rows", "component_id")})
    left = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert left.columns == docs.columns
    assert left.filter("_key <> 'x' OR _salt <> 'x' OR component_id <> 'x'").count() == 0
    got = sorted((r["doc_id"] or 0, r["text"].removesuffix(" end")) for r in left.collect())
    want = [(2, "copied"), (5, "other"), (7, "one"), (7, "two"), (8, "twice"), (0, "lone")]
    assert got == sorted([(d, body(t)) for d, t in want] + [(0, ""), (0, " "), (9, "")])


def test_text_helpers_agree_with_python():
    texts = ["a b c d e f", "a b", None, "A\tB c d e f"]
    found = text.words(pa.array(texts))
    rows, grams = text.shingles(found, found.hashes(), 5)
    assert np.bincount(rows, minlength=4).tolist() == [len(shingle_set(t)) for t in texts]
    assert grams[rows == 0].tolist() == grams[rows == 3].tolist()
