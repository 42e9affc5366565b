"""The registered queries of this folder, with the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexmill.llm import (
    compression,
    conversations,
    decontam,
    html_extract,
    langid,
    merkle,
    minhash,
    mixing,
    ngram_lm,
    quality,
    token_counts,
    toxicity,
    warc,
)
from vertexmill.llm.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return keep


OP1_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (
  SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS x,
         min(page_id) OVER (PARTITION BY html) AS owner
  FROM p),
b AS (
  SELECT *, list_aggregate(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
                  ((CAST('0x' || substr(x, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31), 1)
         ), 'string_agg', '') AS payload_digest
  FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = owner THEN NULL ELSE owner END AS refers_to
FROM b
"""


@query(OP1_SQL)
def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    read = warc.archive_pages(table(spark, folder, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), md5(text), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight
  FROM d GROUP BY source),
o AS (
  SELECT *, (sum(source_size) OVER ())::HUGEINT
           - coalesce(sum(3 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS left_over,
         (sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::HUGEINT AS weights,
         row_number() OVER w AS place
  FROM s WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST)),
c AS (SELECT *, 3 * source_size::HUGEINT * weights <= left_over * weight AS capped FROM o),
f AS (SELECT arg_min(left_over, place) AS l, arg_min(weights, place) AS w FROM c WHERE NOT capped),
t AS (
  SELECT source, source_size,
         CASE WHEN capped THEN (3 * source_size)::DOUBLE
              ELSE f.l::DOUBLE * weight::DOUBLE / f.w::DOUBLE END AS target
  FROM c LEFT JOIN f ON true),
k AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS copies
  FROM t),
r AS (
  SELECT d.doc_id, d.size, k.source_size, k.target, k.copies,
         k.target - (k.copies * k.source_size)::DOUBLE AS budget,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.h) AS own
  FROM d JOIN k ON d.source IS NOT DISTINCT FROM k.source)
SELECT doc_id, size, source_size, target,
       (size * (copies + CASE WHEN upto <= budget
                              OR (upto - own <= budget AND upto - budget < budget - (upto - own))
                         THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""


@query(OP3_SQL)
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark item, with the items."""
    found = decontam.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.withColumn("n_tiles", F.size("tiles").cast("bigint")).drop("tiles")


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source, text, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (
  SELECT doc_id, i, list_aggregate(list_slice(w, i, i + 7), 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
raw AS (
  SELECT doc_id, source, text, line,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
         list_aggregate(regexp_extract_all(translate(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '123456789', '000000000'), '[^\x20\x09-\x0D]+'), 'string_agg', ' ') AS plain
  FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM d)),
full_lines AS (SELECT * FROM raw WHERE n > 0),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM full_lines GROUP BY doc_id),
sizes AS (SELECT source, count(DISTINCT text) AS texts FROM d WHERE len(w) > 0 GROUP BY source),
common AS (
  SELECT l.source, l.plain
  FROM (SELECT source, plain, count(DISTINCT text) AS holding FROM full_lines GROUP BY source, plain) l
  JOIN sizes s ON l.source IS NOT DISTINCT FROM s.source
  WHERE holding > 10 AND 100 * holding > 5 * texts),
gone AS (
  SELECT f.doc_id, sum(n) AS gone FROM full_lines f JOIN common c
    ON f.plain = c.plain AND f.source IS NOT DISTINCT FROM c.source
  GROUP BY f.doc_id),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words,
         coalesce(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')), 0)::BIGINT AS word_chars,
         coalesce(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')), 0)::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(w) - coalesce(gone, 0) AS words_left
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND words_left >= 20 AND 100 * words_left >= 50 * n_words AS kept
FROM f
"""


@query(OP5_SQL)
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents")).drop("lines_removed_words")


@query()
def op6_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"), percent=85)


@query()
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.languages(table(spark, folder, "documents"))


@query()
def op2_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_lm.score(table(spark, folder, "documents"))


@query()
def op7_html(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.main_text(table(spark, folder, "pages"))


@query()
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"))


@query()
def op11_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return compression.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


OP12_SQL = r"""
WITH RECURSIVE c AS (
  SELECT *, CAST(doc_id AS VARCHAR) AS d,
         CASE WHEN doc_id IS NULL THEN '-' ELSE octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id END
         || CASE WHEN source IS NULL THEN '-' ELSE octet_length(encode(source)) || ':' || source END
         || CASE WHEN lang IS NULL THEN '-' ELSE octet_length(encode(lang)) || ':' || lang END
         || CASE WHEN n_chars IS NULL THEN '-' ELSE octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars END AS front
  FROM documents),
crc AS (
  SELECT *, list_reduce([4294967295] || list_transform(range(1, len(d) + 1), lambda i: ascii(substr(d, i, 1))::BIGINT),
            lambda a, b: list_reduce([xor(a, b)] || range(8),
              lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS rest
  FROM c),
l AS (
  SELECT doc_id, lang, sha256(front || CASE WHEN text IS NULL THEN '-' ELSE octet_length(encode(text)) || ':' || text END) AS leaf,
         sha256(front || CASE WHEN text IS NULL THEN '-' ELSE octet_length(encode(text)) || ':'
           || CASE WHEN xor(rest, 4294967295) % 3 = 0
                THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END END) AS shown
  FROM crc),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, shown) - 1 AS place FROM l),
tree(lang, level, nodes) AS (
  SELECT lang, 0, list(leaf ORDER BY place) FROM p GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range((len(nodes) + 7) // 8),
         lambda i: sha256(array_to_string(list_slice(nodes, 8 * i + 1, 8 * i + 8), '')))
  FROM tree WHERE len(nodes) > 1),
s AS (
  SELECT lang, nodes[1] AS subroot, level AS height, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS place
  FROM tree WHERE len(nodes) = 1),
top(level, nodes) AS (
  SELECT 0, list(subroot ORDER BY place) FROM s
  UNION ALL
  SELECT level + 1, list_transform(range((len(nodes) + 7) // 8),
         lambda i: sha256(array_to_string(list_slice(nodes, 8 * i + 1, 8 * i + 8), '')))
  FROM top WHERE len(nodes) > 1),
walk(doc_id, lang, leaf, shown, pos, level, folded, proof) AS (
  SELECT doc_id, lang, leaf, shown, place, 0, shown, '' FROM p
  UNION ALL
  SELECT w.doc_id, w.lang, leaf, shown, pos // 8, w.level + 1,
         sha256(array_to_string(list_slice(nodes, pos - pos % 8 + 1, pos), '') || folded
                || array_to_string(list_slice(nodes, pos + 2, pos - pos % 8 + 8), '')),
         proof || array_to_string(list_slice(nodes, pos - pos % 8 + 1, pos), '')
               || array_to_string(list_slice(nodes, pos + 2, pos - pos % 8 + 8), '')
  FROM walk w JOIN tree t ON t.lang IS NOT DISTINCT FROM w.lang AND t.level = w.level AND len(t.nodes) > 1),
mid AS (
  SELECT w.doc_id, w.leaf, w.shown, s.subroot, s.place, w.folded, w.proof
  FROM walk w JOIN s ON s.lang IS NOT DISTINCT FROM w.lang AND s.height = w.level),
up(doc_id, leaf, subroot, pos, level, folded, proof) AS (
  SELECT doc_id, leaf, subroot, place, 0, folded, proof FROM mid
  UNION ALL
  SELECT doc_id, leaf, subroot, pos // 8, u.level + 1,
         sha256(array_to_string(list_slice(nodes, pos - pos % 8 + 1, pos), '') || folded
                || array_to_string(list_slice(nodes, pos + 2, pos - pos % 8 + 8), '')),
         proof || array_to_string(list_slice(nodes, pos - pos % 8 + 1, pos), '')
               || array_to_string(list_slice(nodes, pos + 2, pos - pos % 8 + 8), '')
  FROM up u JOIN top t ON t.level = u.level AND len(t.nodes) > 1)
SELECT doc_id, leaf, subroot, r.nodes[1] AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
       folded = r.nodes[1] AS verified
FROM up JOIN top r ON len(r.nodes) = 1 AND up.level = r.level
"""


@query(OP12_SQL)
def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.tampered_documents(table(spark, folder, "documents"))


OP13_SQL = r"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations),
crc AS (
  SELECT *, xor(list_reduce([4294967295] || list_transform(range(1, len(name) + 1), lambda i: ascii(substr(name, i, 1))::BIGINT),
            lambda a, b: list_reduce([xor(a, b)] || range(8),
              lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 20 AS fault
  FROM named),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN fault = 0 THEN 0 WHEN fault = 3 THEN 2 ELSE 1 END))
  FROM crc),
ordered AS (
  SELECT *, substr(role, 1, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ending
  FROM damaged),
counted AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM ordered),
faulty AS (
  SELECT *, ending = '' AS blank, ending <> '' AND nth > 1 AS duplicate,
         ending <> '' AND nth = 1 AND ending NOT IN ('.', '!', '?') AS truncated,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal
  FROM counted),
walk(conv_id, i, b0, b1, b2, b3) AS (
  SELECT conv_id, 0, {'c': 0, 'a': '', 'o': ''}, {'c': 1000000000, 'a': '', 'o': ''},
         {'c': 1000000000, 'a': '', 'o': ''}, {'c': 1000000000, 'a': '', 'o': ''}
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i + 1,
    {'c': b0.c + 2, 'a': b0.a || 'D', 'o': b0.o},
    list_sort([{'c': b1.c + 2, 'a': b1.a || 'D', 'o': b1.o},
               {'c': b0.c + keep_s, 'a': b0.a || 'K', 'o': b0.o || own}])[1],
    list_sort([{'c': c2.c + 2, 'a': c2.a || 'D', 'o': c2.o},
               {'c': b0.c + keep_u, 'a': b0.a || 'K', 'o': b0.o || own},
               {'c': b1.c + keep_u, 'a': b1.a || 'K', 'o': b1.o || own},
               {'c': c3.c + keep_u, 'a': c3.a || 'K', 'o': c3.o || own},
               {'c': b0.c + rerole, 'a': b0.a || 'R', 'o': b0.o || chr(10) || 'user:' || text},
               {'c': b1.c + rerole, 'a': b1.a || 'R', 'o': b1.o || chr(10) || 'user:' || text},
               {'c': c3.c + rerole, 'a': c3.a || 'R', 'o': c3.o || chr(10) || 'user:' || text}])[1],
    list_sort([{'c': c3.c + 2, 'a': c3.a || 'D', 'o': c3.o},
               {'c': c2.c + keep_a, 'a': c2.a || 'K', 'o': c2.o || own},
               {'c': c2.c + rerole, 'a': c2.a || 'R', 'o': c2.o || chr(10) || 'assistant:' || text}])[1]
  FROM (
    SELECT w.*, f.text, chr(10) || f.role || ':' || f.text AS own,
      CASE WHEN blank OR duplicate THEN 1000000000 WHEN truncated THEN 6 ELSE 1 END AS rerole,
      CASE WHEN blank OR duplicate OR initial <> 's' THEN 1000000000 WHEN truncated THEN 5 ELSE 0 END AS keep_s,
      CASE WHEN blank OR duplicate OR initial <> 'u' THEN 1000000000 WHEN truncated THEN 5 ELSE 0 END AS keep_u,
      CASE WHEN blank OR duplicate OR initial <> 'a' THEN 1000000000 WHEN truncated THEN 5 ELSE 0 END AS keep_a,
      list_sort([b2, {'c': b0.c + 5, 'a': b0.a || 'I', 'o': b0.o || chr(10) || 'user:'},
                     {'c': b1.c + 5, 'a': b1.a || 'I', 'o': b1.o || chr(10) || 'user:'},
                     {'c': b3.c + 5, 'a': b3.a || 'I', 'o': b3.o || chr(10) || 'user:'}])[1] AS c2,
      list_sort([b3, {'c': b2.c + 5, 'a': b2.a || 'I', 'o': b2.o || chr(10) || 'assistant:'},
                     {'c': b0.c + 10, 'a': b0.a || 'II', 'o': b0.o || chr(10) || 'user:' || chr(10) || 'assistant:'},
                     {'c': b1.c + 10, 'a': b1.a || 'II', 'o': b1.o || chr(10) || 'user:' || chr(10) || 'assistant:'}])[1] AS c3
    FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1)),
totals AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
         count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal, count(*) AS n
  FROM faulty GROUP BY conv_id),
ended AS (
  SELECT w.conv_id, t.*  EXCLUDE (conv_id),
         list_sort([b0, b3, {'c': b2.c + 5, 'a': b2.a || 'I', 'o': b2.o || chr(10) || 'assistant:'},
                    {'c': b1.c + 10, 'a': b1.a || 'II', 'o': b1.o || chr(10) || 'user:' || chr(10) || 'assistant:'}])[1] AS e
  FROM walk w LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM w.conv_id
  WHERE w.i = coalesce(t.n, 0))
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, e.c::BIGINT AS cost, e.a AS audit,
       sha256(substr(e.o, 2)) AS repaired_sha256
FROM ended
"""


@query(OP13_SQL)
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair(table(spark, folder, "conversations"))
