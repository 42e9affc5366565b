"""Operators against plain Python on small tables with every odd case."""

import hashlib
import html
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from vertexmill.llm import decontam, html_extract, mixing, ngram_lm, quality, text, token_counts, warc

LONG = " ".join(f"w{k % 977}" for k in range(30_000))
ODD = [
    (1, "the cat sat on the mat\nthe cat sat on the mat", "en", "s1"),
    (2, "The CAT sat\ton the mat", "en", "s1"),
    (2, "The CAT sat\ton the mat", "en", "s1"),
    (3, None, None, None),
    (4, "", "en", "s2"),
    (5, " \n\t ", "en", ""),
    (None, "a b c d e f g", "en", "s2"),
    (6, LONG, "de", "s3"),
    (7, "über ÉCOLE naïve 123 !!! é", "fr", None),
    (8, "12345 --- 999", None, "s1"),
]


def words(t):
    return (t or "").encode().lower().split()


# ------------------------------------------------------------------ words


def test_words_and_hashes_tell_words_apart():
    texts = ["ab cd", "", None, "ab", "a" * 40 + " " + "a" * 41, "x\x0by z ", "cd"]
    found = text.words(pa.array(texts))
    assert [found.word(k) for k in range(len(found.start))] == [w for t in texts for w in words(t)]
    assert found.counts.tolist() == [len(words(t)) for t in texts]
    h = found.hashes()
    by_word = defaultdict(set)
    for k in range(len(h)):
        by_word[found.word(k)].add(int(h[k]))
    assert all(len(v) == 1 for v in by_word.values())
    assert len({next(iter(v)) for v in by_word.values()}) == len(by_word)


def test_chunks_keep_every_row():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (10, 5 << 20, 0, 3 << 20, 3 << 20, 1)]})
    parts = list(text.chunks([batch]))
    assert len(parts) > 1
    assert pa.Table.from_batches(parts)["text"].to_pylist() == batch["text"].to_pylist()


def test_sliced_columns_are_read_from_their_offset():
    column = pa.array(["aa bb", "cc", None, "dd ee"]).slice(1, 3)
    found = text.words(column)
    assert [found.word(k) for k in range(len(found.start))] == [b"cc", b"dd", b"ee"]


# ------------------------------------------------------------------ 1 WARC


def test_archive_gives_back_the_exact_records(spark):
    rows = [(5, "u5", "same"), (3, "u3", "same"), (9, None, "sämë"), (1, "u1", None), (2, "u2", ""), (None, "u", "same")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r["page_id"]: r for r in warc.archive_pages(pages).collect()}
    assert got[3]["record_type"] == "response" and got[3]["refers_to"] is None
    assert (got[5]["record_type"], got[5]["refers_to"]) == ("revisit", 3)
    assert (got[None]["record_type"], got[None]["refers_to"]) == ("revisit", 3)
    assert (got[2]["record_type"], got[2]["refers_to"]) == ("revisit", 1)
    import base64

    for page_id, _, source in rows:
        payload = (source or "").encode()
        assert got[page_id]["payload_bytes"] == len(payload)
        assert got[page_id]["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
    records = warc.record_bytes(warc.archive_pages(pages)).collect()
    for r in records:
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert int(fields[b"Content-Length"]) == len(rest) - 4
        if fields[b"WARC-Type"] == b"response":
            payload = rest.split(b"\r\n\r\n", 1)[1][:-4]
            assert base64.b32encode(hashlib.sha1(payload).digest()) == fields[b"WARC-Payload-Digest"][5:]


def test_archive_stores_a_payload_once_and_finds_damage(spark, tmp_path):
    pages = spark.range(40).selectExpr("id AS page_id", "'u' AS url", "concat('p', id % 3) AS html")
    archive = warc.write_archive(warc.to_records(pages.repartition(5)), str(tmp_path / "a"))
    assert spark.read.parquet(archive.payloads).count() == 3
    broken = spark.read.parquet(archive.payloads).selectExpr("digest", "encode(concat(decode(payload, 'UTF-8'), '!'), 'UTF-8') AS payload")
    broken.write.parquet(str(tmp_path / "b"))
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_archive(spark, warc.Archive(archive.headers, str(tmp_path / "b"))).collect()


def test_small_payloads_are_not_revisited(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id bigint, url string, html string")
    assert {r["record_type"] for r in warc.archive_pages(pages, least=3).collect()} == {"response"}
    assert warc.archive_pages(pages.limit(0)).count() == 0


# ------------------------------------------------------------------ 2 language model


def brute_scores(rows):
    held = [zlib.crc32(str(d).encode()) % 7 == 2 if d is not None else False for d, *_ in rows]
    seqs = [[*words(t), "end"] for _, t, *_ in rows]
    uni, bi = Counter(), Counter()
    for s, h in zip(seqs, held, strict=True):
        if not h:
            uni.update(s)
            bi.update(zip(["start", *s[:-1]], s, strict=True))
    total, kinds, cont = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
    for (c, w), n in bi.items():
        total[c] += n
        kinds[c][min(n, 3) - 1] += 1
        cont[w] += 1
    d = ngram_lm.discounts(np.array([sum(x == k for x in bi.values()) for k in (1, 2, 3, 4)]))
    e = ngram_lm.discounts(np.array([sum(x == k for x in cont.values()) for k in (1, 2, 3, 4)]))
    kept = sum(e[min(n, 3)] for n in cont.values()) / len(bi) if bi else 1.0
    low = lambda w: max(cont[w] - e[min(cont[w], 3)], 0) / max(1, len(bi)) + kept / (len(uni) + 1)

    def prob(c, w):
        if not total[c]:
            return low(w)
        back = sum(d[k + 1] * kinds[c][k] for k in range(3)) / total[c]
        return max(bi[c, w] - d[min(bi[c, w], 3)], 0) / total[c] + back * low(w)

    n, v = sum(uni.values()), len(uni)
    out = []
    for s, h in zip(seqs, held, strict=True):
        score = sum(math.log10(prob(c, w)) for c, w in zip(["start", *s[:-1]], s, strict=True))
        base = sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in s)
        out.append((h, len(s), sum(uni[w] > 0 for w in s), n, base, score))
    vocabulary = [*uni, "none such"]
    return out, [sum(prob(c, w) for w in vocabulary) for c in ["start", *list(total)[:5], "none"]]


@pytest.mark.parametrize("shard_tokens", [2_000_000, 900])
def test_language_model_equals_brute_force(documents, monkeypatch, shard_tokens):
    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", shard_tokens)
    monkeypatch.setattr(ngram_lm, "BLOCK_TOKENS", 3 * shard_tokens)
    rows = [*ODD, *[(k, f"the cat {k % 5} sat on a mat {k}", "en", "s") for k in range(20, 60)]]
    want, sums = brute_scores(rows)
    assert np.allclose(sums, 1)
    got = ngram_lm.score(documents(rows)).collect()
    key = lambda x: tuple(round(float(v), 6) for v in x)
    have = [(r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got]
    assert sorted(map(key, have)) == sorted(map(key, want))


def test_language_model_of_nothing(documents):
    assert ngram_lm.score(documents(ODD).limit(0)).count() == 0


def test_packed_bigrams_round_trip():
    c = np.array([5, 5, 9, 9, 9], dtype=np.uint64) | np.uint64(1 << 47)
    w = np.array([1, 2, 1, 4, 7], dtype=np.uint64)
    n = np.array([1, 254, 255, 256, 10**10])
    for a, b in zip(ngram_lm.unpack_bigrams(ngram_lm.pack_bigrams(c, w, n)), (c, w, n), strict=True):
        assert a.tolist() == b.tolist()


# ------------------------------------------------------------------ 3 mixing


def test_mix_takes_about_the_targets(documents, spark):
    rows = [(k, "w " * (1 + k * 7919 % 50), "en", f"s{k % 4}" if k % 9 else None) for k in range(800)]
    got = mixing.mix(documents(rows)).collect()
    total = sum(len(words(t)) for _, t, *_ in rows)
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len(words(t))
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, free, left = {}, set(names), total
    while True:
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] >= 3 * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = 3 * sizes[s]
            free.discard(s)
        left = total - sum(target.values())
    target |= share
    taken = Counter()
    for r in got:
        assert r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        assert math.isclose(r["target"], target[r["source"]])
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 50 for s in names)
    again = mixing.mix(documents(rows).repartition(3)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)


def test_mix_odd_rows_and_extra_columns(documents):
    got = mixing.mix(documents(ODD)).collect()
    assert len(got) == len(ODD)
    assert {r["size"] for r in got if r["doc_id"] in (3, 4, 5)} == {0}
    kept = mixing.mixed_rows(documents(ODD))
    assert kept.columns[:4] == ["doc_id", "text", "lang", "source"] and kept.filter("copies < 1").count() == 0
    assert mixing.mix(documents(ODD).limit(0)).count() == 0
    assert {r["taken"] for r in mixing.mix(documents(ODD[3:6])).collect()} == {0}


# ------------------------------------------------------------------ 4 decontamination


def test_reordered_passages_are_found_and_chance_is_not(documents, spark):
    item = [f"q{k}" for k in range(40)]
    halves = " ".join(["x"] * 7 + item[20:] + ["y"] * 3 + item[:20] + ["z"])
    rows = [
        (1, " ".join(item).upper(), "en", "s"),
        (2, halves, "en", "s"),
        (3, " ".join(item[:12]) + " other", "en", "s"),
        (None, LONG + " " + " ".join(item), "en", "s"),
        (4, None, "en", "s"),
        (5, "the " * 500, "en", "s"),
        (1, " ".join(item), "en", "s"),
    ]
    bench = spark.createDataFrame(
        [(7, " ".join(item)), (8, None), (9, "too short"), (None, "the " * 300)], "item_id bigint, text string"
    )
    got = decontam.leaks(documents(rows), bench).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"] or 0) for r in got) == [(0, 7), (1, 7), (1, 7), (2, 7), (5, 0)]
    two = next(r for r in got if r["doc_id"] == 2)
    assert two["coverage"] == 1.0 and sorted((t["doc_word"], t["item_word"], t["words"]) for t in two["tiles"]) == [(7, 20, 20), (30, 0, 20)]
    clean = decontam.without_leaks(documents(rows), bench)
    assert clean.columns == documents(rows).columns
    assert sorted(r["doc_id"] for r in clean.collect()) == [3, 4]
    assert decontam.leaks(documents(rows).limit(0), bench).count() == 0
    assert decontam.leaks(documents(rows), bench.limit(0)).count() == 0


def brute_tiles(doc, item, least):
    marked_d, marked_i, tiles = set(), set(), []
    while True:
        best = None
        for q in range(len(item)):
            for p in range(len(doc)):
                n = 0
                while (
                    p + n < len(doc) and q + n < len(item) and doc[p + n] == item[q + n]
                    and p + n not in marked_d and q + n not in marked_i
                ):
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (p, q, n)
        if best is None:
            return sum(t[2] for t in tiles)
        tiles.append(best)
        marked_d.update(range(best[0], best[0] + best[2]))
        marked_i.update(range(best[1], best[1] + best[2]))


def test_tiles_cover_as_much_as_the_plain_greedy_search():
    random = np.random.default_rng(5)
    for _ in range(60):
        item = [f"v{x}" for x in random.integers(0, 4, 30)]
        doc = [f"v{x}" for x in random.integers(0, 4, 60)]
        index = decontam.index_of([(1, " ".join(item))], 5)
        found = list(decontam.matches(pa.array([" ".join(doc)]), index, 5, 0.0))
        want = brute_tiles(doc, item, 5)
        assert (found[0][2] if found else 0) == want


def test_short_items_must_be_held_whole(documents, spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma"), (2, "Delta"), (3, " "), (4, None)], "item_id bigint, text string")
    rows = [(1, "x ALPHA beta gamma y", "en", "s"), (2, "alpha beta y gamma", "en", "s"), (3, "a delta", "en", "s"), (4, None, "en", "s")]
    got = decontam.leaks(documents(rows), bench).collect()
    assert sorted((r["doc_id"], r["item_id"], r["covered_words"]) for r in got) == [(1, 1, 3), (3, 2, 1)]


def test_repetitive_texts_need_little_memory():
    import tracemalloc

    index = decontam.index_of([(1, "a " * 800), (2, "a b " * 300)], 5)
    column = pa.array(["a " * 80_000 + "a b " * 20_000])
    tracemalloc.start()
    found = {item: (covered, tiles) for _, item, covered, tiles in decontam.matches(column, index, 5, 0.5)}
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 300e6
    assert found[0][0] == 800 and found[0][1] == [(0, 0, 800)]
    # the text goes over from one to the other in "a a b"
    assert found[1][0] == 600 and found[1][1] == [(80_000, 0, 600)]


def test_benchmark_blocks_give_the_same_matches(documents, spark, monkeypatch):
    items = [(k, " ".join(f"i{k}x{j}" for j in range(20))) for k in range(12)]
    rows = [(k, "a b " + items[k][1] + " c", "en", "s") for k in range(12)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 300)
    got = decontam.leaks(documents(rows), bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(k, k) for k in range(12)]


# ------------------------------------------------------------------ 5 quality


def brute_quality(rows, limit, share):
    lines, texts = defaultdict(set), defaultdict(set)
    plain = lambda x: " ".join(quality.normalised(x.encode()).decode().split())
    for _, t, _, s in rows:
        if (t or "").encode().split():
            texts[s].add(t)
        for x in (t or "").split("\n"):
            if plain(x):
                lines[s, plain(x)].add(t)
    common = {k for k, v in lines.items() if len(v) > limit and 100 * len(v) > share * len(texts[k[0]])}
    out = []
    for _, t, _, s in rows:
        w = (t or "").encode().split()
        n = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        cover = {k + j for k in range(len(w) - 7) if n[tuple(w[k : k + 8])] > 1 for j in range(8)}
        full = [x for x in (t or "").split("\n") if plain(x)]
        gone = sum(len(plain(x).split()) for x in full if (s, plain(x)) in common)
        failed = len(w) < 20 or 100 * len(cover) > 30 * len(w)
        left = len(w) - gone
        kept = not failed and left >= 20 and 100 * left >= 50 * len(w)
        out.append(
            (len(w), len(b"".join(w).decode()), sum(c in "#*$%&|<>" for c in t or ""), len(full) - len(set(full)),
             len(cover), failed, kept)
        )
    return out


def test_quality_equals_brute_force(documents):
    body = lambda k: " ".join(f"t{k}x{j}" for j in range(25))
    rows = [
        *ODD,
        *[(100 + k, f"Read  MORE 12 here\n{body(k)}\nread more 34 here", "en", "s1") for k in range(5)],
        *[(200 + k, f"{body(k)}\n" + "same long footer line " * 20, "en", "s9") for k in range(5)],
        *[(300 + k, f"{body(k)}\n" + "same long footer line " * 20, "en", None) for k in range(2)],
        (400, "#*$ % & | <> é", "en", "s1"),
    ]
    rows += [(500 + k, rows[-2][1], "en", "s9") for k in range(4)]
    for limit, share in ((3, 5), (1, 60)):
        got = quality.quality(documents(rows), limit, share).collect()
        have = [
            (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"], r["kept"])
            for r in got
        ]
        assert sorted(have) == sorted(brute_quality(rows, limit, share))
        assert any(r["lines_removed_words"] for r in got)
    assert quality.quality(documents(rows).limit(0)).count() == 0


def test_copies_and_table_size_leave_the_verdict(documents):
    name = lambda k: chr(97 + k % 26) + chr(97 + k // 26)
    body = lambda k: " ".join(f"t{name(k)}x{name(j)}" for j in range(25))
    for copies in (90, 110):
        rows = [(k, body(99), "en", "s") for k in range(copies)] + [(1000 + k, body(k), "en", "s") for k in range(30)]
        assert all(r["kept"] for r in quality.quality(documents(rows)).collect())


# ------------------------------------------------------------------ 7 HTML


def test_main_text_without_the_rest(spark):
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><header>top</header><nav><a>menu</a></nav>"
        "<div class='ad-box ad'>buy</div><div class='content post-12'><h1>A &amp; B</h1><p>One\n two<br>three <b>four"
        "<p>five &lt;six&gt; &eacute;</p><ul><li>x<li>y</ul><form>mail</form><div class=comments>hi</div></div>"
        "<!-- <p>no</p> --><script>var a='<p>no</p>'</script><footer>&copy; x</footer></body></html>"
    )
    rows = [
        (1, "http://h/1", page), (2, "http://h/2", page.replace("12", "34").replace("One", "Uno")),
        (3, None, None), (4, "http://h/3", ""), (5, "no host", "plain &am"), (None, "http://h/1", "<p>cut <a href='x"),
        (6, "http://h/4", "<article><header><h1>T</h1></header><p>body</p><aside>no</aside></article>"),
    ]
    got = {r["page_id"]: r["text"] for r in html_extract.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[1] == "A & B\nOne two three four\nfive <six> é\nx\ny"
    assert got[2] == got[1].replace("One", "Uno")
    assert (got[3], got[4], got[5], got[None], got[6]) == ("", "", "plain &am", "cut", "T\nbody")


def test_hosts_settle_which_container_is_the_text(spark):
    """A page whose largest container is a teaser list follows the path its host agrees on."""
    usual = "<div class=story><p>{0}</p></div><div class=list><p>short</p></div>"
    odd = "<div class=story><p>brief</p></div><div class=list><p>{0}</p></div>"
    rows = [(k, f"http://h.x/{k}", usual.format("long story " * 30)) for k in range(5)]
    rows.append((9, "http://h.x/9", odd.format("teaser " * 60)))
    got = html_extract.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    texts = {r["page_id"]: r["text"] for r in got.collect()}
    assert texts[9] == "brief" and texts[0] == html.unescape(("long story " * 30).strip())


def own_text(source):
    return html_extract.Page(source).extract([])


def test_elements_without_end_cut_nothing():
    for tag in ("<svg class='i'/>", "<svg/>", "<svg>", "<iframe src='x'>", "<noscript>", "<object data=x>", "<iframe src='x' />"):
        for after in ("", "<svg><text>no</text></svg>"):
            assert own_text(f"<article><p>one</p>{tag}<p>two</p><p>three</p></article>{after if tag != '<svg>' else ''}") == "one\ntwo\nthree"
    assert own_text("<p>one<script>var a = '<p>no</p>'") == "one"
    assert own_text("<p>one<svg><text>no</text></svg> two<textarea>no</textarea><select><option>no</select>") == "one two"
    assert own_text("<title>no<article><p>one</p></article>") == "one"


def test_wrappers_of_the_article_are_not_aside():
    for name in ("content with-sidebar", "content-sidebar-wrap", "no-comments", "has-side-menu", "sidebar", "side-menu-page"):
        for inner in ("article", "main"):
            page = f"<body><div class='{name}'><{inner}><p>one</p></{inner}><div class=sidebar>no</div></div></body>"
            assert own_text(page) == "one", (name, inner)
    assert own_text("<body><form id=aspnet><div class=story><p>" + "one " * 50 + "</p></div></form><p>x</p></body>").startswith("one")
    thread = "<div class=comments><article><p>" + "no " * 90 + "</p></article></div>"
    assert own_text(f"<body><article><p>one</p></article>{thread}</body>") == "one"
    for name in ("ad-box", "site-footer", "comments", "sidebar left", "sidebar-left", "post-comments"):
        assert own_text(f"<article><p>one</p><div class='{name}'>no</div></article>") == "one", name


def test_nested_and_split_articles_stay_whole(spark):
    body = lambda k: f"story{k} " * 60
    shapes = {
        "nested": "<article><h1>T{k}</h1><p>lede{k}</p><div class=body><p>{b}</p></div></article>",
        "split": "<article><section class=a><p>{b}</p></section><section class=b><p>end{k}</p></section></article>",
        "main": "<main><h1>T{k}</h1><article><p>{b}</p></article></main>",
        "plain": "<div class=post><h1>T{k}</h1><div class=intro>lede{k}</div><div class=body><p>{b}</p></div></div>",
        "title": "<h1>T{k}</h1><div class=body><p>{b}</p></div>",
    }
    around = "<body><div class=top>Same slogan</div>{0}<div class=rail><p>Same box on each page</p></div></body>"
    names = "abcd"  # digits don't tell texts apart
    rows = [
        (f"{shape}{k}", around.format(made.format(k=k, b=body(k)))) for shape, made in shapes.items() for k in names
    ]
    pages = spark.createDataFrame([(n, f"http://{name[:-1]}.x/{n}", h) for n, (name, h) in enumerate(rows)], "page_id bigint, url string, html string")
    got = {rows[r["page_id"]][0]: r["text"].split("\n") for r in html_extract.main_text(pages).collect()}
    for k in names:
        story = body(k).strip()
        assert got[f"nested{k}"] == [f"T{k}", f"lede{k}", story]
        assert got[f"split{k}"] == [story, f"end{k}"]
        assert got[f"main{k}"] == [f"T{k}", story]
        assert got[f"plain{k}"] == [f"T{k}", f"lede{k}", story]
        assert got[f"title{k}"] == [f"T{k}", story]


# ------------------------------------------------------------------ 8 token counts


def test_piece_counts_equal_longest_match():
    random = np.random.default_rng(3)
    pieces = [bytes([b]) for b in range(256)]
    pieces += [bytes(random.choice(list(b"abc "), random.integers(2, 6)).tolist()) for _ in range(60)]
    known, a = set(pieces), token_counts.automaton(pieces)

    def count(word):
        at = n = 0
        while at < len(word):
            at += next(k for k in range(min(6, len(word) - at), 0, -1) if word[at : at + k] in known)
            n += 1
        return n

    texts = ["".join(random.choice(list("abcd"), random.integers(1, 30))) for _ in range(300)]
    found = text.words(pa.array(texts), lower=False)
    got = token_counts.piece_counts(found, np.arange(len(found.start)), a)
    assert got.tolist() == [count(b" " + t.encode()) for t in texts]
    with pytest.raises(ValueError):
        token_counts.automaton([b"a"])


def test_token_counts_odd_rows(documents):
    pieces = [bytes([b]) for b in range(256)] + [b" the", b"the", b" cat", b"at"]
    got = {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in token_counts.token_counts(documents(ODD), pieces).collect()}
    assert got[3] == got[4] == got[5] == (0, 0)
    assert got[2] == (6, 4 + 4 + 3 + 3 + 1 + 3)


# ------------------------------------------------------------------ 2 shards of the language model


def test_a_missing_or_short_shard_is_an_error(documents, monkeypatch):
    import os

    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", 20)
    rows = [(k, f"the cat {k} sat on the mat {k % 3}", "en", "s") for k in range(20)]
    model = ngram_lm.fit(documents(rows))
    assert model.shards > 1 and {f"{model.folder}/{name}" for name in model.sizes} == {
        f"{model.folder}/{name}" for name in os.listdir(model.folder)
    }
    column = pa.array([r[1] for r in rows])
    whole = ngram_lm.score_rows(column, model, ngram_lm._Arrays(model.folder, model.sizes))["score"]
    assert np.isfinite(whole).all()
    with pytest.raises(RuntimeError, match="no shard"):
        ngram_lm.score_rows(column, model, ngram_lm._Arrays(model.folder + "-elsewhere", model.sizes))
    name = max(model.sizes, key=model.sizes.get)
    with open(f"{model.folder}/{name}", "r+b") as file:
        file.truncate(os.path.getsize(file.name) - 4)
    with pytest.raises(RuntimeError, match="should have"):
        ngram_lm.score_rows(column, model, ngram_lm._Arrays(model.folder, model.sizes))
    os.remove(f"{model.folder}/{name}")
    with pytest.raises(RuntimeError, match="no shard"):
        ngram_lm.score_rows(column, model, ngram_lm._Arrays(model.folder, model.sizes))


def test_many_shards_need_few_open_files(tmp_path):
    import os

    sizes = {}
    for k in range(1500):
        ngram_lm._store(str(tmp_path), f"bigrams-{k}", np.array([k], dtype="<u8"), np.array([k + 1], dtype="<u4"))
        sizes[f"bigrams-{k}"] = 1
    arrays = ngram_lm._Arrays(str(tmp_path), sizes)
    before = len(os.listdir("/proc/self/fd"))
    keys = np.arange(1500, dtype=np.uint64)
    (n,) = arrays.look_up("bigrams", ["<u8", "<u4"], keys.astype(np.int64), keys)
    assert (n == np.arange(1500) + 1).all()
    assert len(os.listdir("/proc/self/fd")) - before < 50
    assert len(arrays.open) <= ngram_lm.MOST_OPEN


# ------------------------------------------------------------------ 7 the whole article


def blocks_of(page):
    return [whole for whole, *_ in html_extract.Page(page).blocks]


def test_a_quote_counts_only_after_an_equals_sign():
    page = "<article><p title=it's>ONE</p><p>TWO</p><p title=that's>THREE</p><p title='a>b' id=\"c>d\">FOUR</p></article>"
    assert blocks_of(page) == ["ONE", "TWO", "THREE", "FOUR"]
    assert blocks_of("<p " + '="x' * 50_000 + ">") == []


def test_names_are_judged_by_what_they_name():
    inside = ["side-effects", "menu-of-the-day", "notice-period", "no-comments", "content-sidebar-wrap", "with-sidebar", "market-share"]
    aside = [
        "reader-comments", "article-comments", "userComments", "google-ad", "l-sidebar", "ad-box", "sidebar-left",
        "comment-list", "related-posts", "share-buttons", "site-nav", "cookie-notice", "side", "menu-items", "main-menu",
    ]
    for attribute in ("class", "id"):
        for name in inside:
            assert blocks_of(f"<article><div {attribute}='{name}'>Kept.</div><p>Text.</p></article>") == ["Kept.", "Text."], name
        for name in aside:
            assert blocks_of(f"<article><div {attribute}='{name}'>Gone.</div><p>Text.</p></article>") == ["Text."], name


def test_formulas_are_text():
    page = "<p>Let <math><mi>x</mi><annotation encoding='t'>\\x</annotation></math> be 1.</p>"
    assert blocks_of(page) == ["Let x be 1."]


def test_long_comments_don_t_replace_a_short_article():
    long = "<p>" + "long " * 500 + "</p>"
    assert blocks_of(f"<body><div class=story><p>Short.</p></div><div id=comments>{long}</div></body>") == ["Short."]
    assert blocks_of(f"<body><form><div>{long}</div></form></body>") == [("long " * 500).strip()]
