"""Registered queries of the operators of this subpackage and their DuckDB statements.

Each query applies its operator with production parameters to its whole table and derives the
columns that are compared from the operator's own output.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chain import document_labels, score_documents
from .jaccard import jaccard_components
from .merkle import verified_manifest
from .mixing import mix
from .naming import exact_groups
from .ordermin import edited_fingerprints
from .packing import pack
from .prefixtrie import conversation_trie
from .rules import line_rules
from .sharding import byte_shards
from .substrings import remove_repeated_windows
from .template import extract_main_text
from .tokenfile import token_files
from .tokens import vocabulary


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return byte_shards(docs, 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op2_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return line_rules(docs, distinct=True).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                   "n_repeat_words", "base_failed", "kept", "n_words_left")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"), k=4, percent=85)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_windows(_table(spark, sf_dir, "documents"), k=35)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_documents(docs, document_labels(_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.round("scores.low_quality", 6).alias("p_low_quality"),
                         F.round("scores.toxic", 6).alias("p_toxic"),
                         F.col("rejected").alias("toxic"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), vocabulary(), end_id=1, capacity=4096)


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(_table(spark, sf_dir, "documents"), vocabulary(), end_id=2)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified_manifest(_table(spark, sf_dir, "documents"),
                             ["doc_id", "source", "lang", "n_chars", "text"])


def op12_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(_table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_line_rules": op2_line_rules,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_packing": op7_packing,
    "op8_main_text": op8_main_text,
    "op9_source_mix": op9_source_mix,
    "op10_token_files": op10_token_files,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_order_minhash": op12_order_minhash,
    "op13_prefix_trie": op13_prefix_trie,
}

SQL: dict[str, str] = {
    "op2_line_rules": r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
           FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS p, w FROM d WHERE len(w) >= 3),
r AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w[p], w[p + 1], w[p + 2]) AS n FROM g),
rep AS (SELECT doc_id, count(DISTINCT p + o) AS n_repeat_words
        FROM r, (VALUES (0), (1), (2)) AS t(o) WHERE n >= 2 GROUP BY doc_id),
l AS (SELECT doc_id, source, line,
             trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm,
             len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
      FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM l GROUP BY doc_id),
h AS (SELECT source, count(*) AS host_docs FROM d GROUP BY source),
f AS (SELECT l.source, norm FROM l JOIN h ON l.source IS NOT DISTINCT FROM h.source
      GROUP BY l.source, norm, host_docs
      HAVING count(DISTINCT doc_id) >= 20 AND count(DISTINCT doc_id) >= host_docs * 0.02),
rem AS (SELECT doc_id, sum(n) AS removed FROM l JOIN f
        ON l.source IS NOT DISTINCT FROM f.source AND l.norm = f.norm GROUP BY doc_id),
s AS (SELECT d.doc_id, len(w)::BIGINT AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
             coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             (len(w) - coalesce(removed, 0))::BIGINT AS n_words_left
      FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN rem USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND n_words_left >= 0.3 * n_words AS kept
FROM s
""",
    "op3_jaccard_join": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS q, unnest(w) AS word, len(w) AS n FROM d),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(l, ' ')) AS s FROM (
        SELECT doc_id, q, n, list(word) OVER (PARTITION BY doc_id ORDER BY q
               ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS l FROM x)
      WHERE len(l) = 4 OR (n < 4 AND q = 1)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
      FROM s AS a JOIN s AS b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN c AS ca ON ca.doc_id = a JOIN c AS cb ON cb.doc_id = b
      WHERE 100 * shared >= 85 * (ca.n + cb.n - shared)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS seen FROM documents
      UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.seen = e.a)
SELECT d.doc_id, coalesce(any_value(c.n), 0)::BIGINT AS n_shingles, min(r.seen) AS component_id
FROM d LEFT JOIN c USING (doc_id) JOIN r ON r.doc_id = d.doc_id GROUP BY d.doc_id
""",
    "op4_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
           FROM documents),
x AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS q, unnest(w) AS word FROM d),
h AS (SELECT doc_id, q, md5(array_to_string(list(word) OVER r, ' ')) AS k, count(*) OVER r AS n
      FROM x WINDOW r AS (PARTITION BY doc_id ORDER BY q ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
s AS (SELECT doc_id, q FROM (SELECT doc_id, q, count(*) OVER (PARTITION BY k) AS times
                             FROM h WHERE n = 35) WHERE times > 1),
c AS (SELECT x.doc_id, x.q, x.word, max(s.q) OVER (PARTITION BY x.doc_id ORDER BY x.q
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last
      FROM x LEFT JOIN s ON x.doc_id = s.doc_id AND x.q = s.q),
k AS (SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY q) AS kept
      FROM c WHERE last IS NULL OR last + 34 < q GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
""",
    "op5_exact_dedup": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
           FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
""",
    "op9_source_mix": r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         -ln((('0x' || left(md5(doc_id::VARCHAR), 12))::BIGINT::DOUBLE + 1) / 281474976710656.0)
         / CASE WHEN length(text) > 0 THEN greatest(0.05::DOUBLE,
             length(translate(text, '#*$%&|<>', ''))::DOUBLE / length(text)::DOUBLE)
           ELSE 0.05::DOUBLE END AS draw
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, 1 + (row_number() OVER (
        ORDER BY source IS NULL, encode(source)) - 1) % 3 AS weight FROM d GROUP BY source),
f AS (SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS all_size,
             sum(weight) OVER () AS all_weight,
             coalesce(sum(3 * source_size) OVER a, 0) AS cap_ahead,
             coalesce(sum(weight) OVER a, 0) AS weight_ahead
      FROM s WINDOW a AS (ORDER BY 3 * source_size / weight, source IS NULL, source
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (all_size - cap_ahead)::DOUBLE / (all_weight - weight_ahead)::DOUBLE AS level
      FROM f),
h AS (SELECT arg_min(level, cap_ahead) AS held FROM l WHERE level * weight <= cap),
t AS (SELECT source, source_size, CASE WHEN held IS NULL THEN cap::DOUBLE
             ELSE least(cap::DOUBLE, held * weight) END AS target FROM l, h),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY draw, d.doc_id, d.size
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((epochs + CASE WHEN before + size / 2 < target - epochs * source_size THEN 1 ELSE 0 END)
        * size)::BIGINT AS taken
FROM p
""",
    "op11_merkle_manifest": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, text, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
         || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-')
         || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
  FROM documents),
f AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
             sha256(head || coalesce(strlen(low) || ':' || low, '-')) AS low_leaf,
             xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(
                   string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                 lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                   lambda e, z: xor(e >> 1, 3988292384::BIGINT * (e & 1)))), 4294967295) AS crc
      FROM (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                'abcdefghijklmnopqrstuvwxyz') AS low FROM d)),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
      FROM f),
t AS (SELECT 0 AS lvl, lang, pos, leaf AS digest, count(*) OVER (PARTITION BY lang) AS n FROM r
      UNION ALL
      SELECT lvl, lang, pos, digest, n FROM (
        SELECT lvl + 1 AS lvl, lang, pos // 8 AS pos, sha256(string_agg(digest, '' ORDER BY pos))
               AS digest, (any_value(n) + 7) // 8 AS n
        FROM t WHERE n > 1 GROUP BY lvl, lang, pos // 8)),
u AS (SELECT lang, digest, lvl AS height,
             row_number() OVER (ORDER BY lang IS NOT NULL, encode(lang)) - 1 AS pos,
             count(*) OVER () AS n FROM t WHERE n = 1),
g AS (SELECT 0 AS lvl, pos, digest, n FROM u
      UNION ALL
      SELECT lvl, pos, digest, n FROM (
        SELECT lvl + 1 AS lvl, pos // 8 AS pos, sha256(string_agg(digest, '' ORDER BY pos)) AS digest,
               (any_value(n) + 7) // 8 AS n
        FROM g WHERE n > 1 GROUP BY lvl, pos // 8)),
a AS (SELECT lvl, lang, pos, digest, n, 0 AS high FROM t WHERE n > 1
      UNION ALL SELECT height + lvl, u.lang, g.pos, g.digest, g.n, 1 FROM g, u WHERE g.n > 1),
s AS (SELECT lvl, lang, pos, high,
             coalesce(string_agg(digest, '' ORDER BY pos) OVER (PARTITION BY lvl, lang, high, pos // 8
               ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
             coalesce(string_agg(digest, '' ORDER BY pos) OVER (PARTITION BY lvl, lang, high, pos // 8
               ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
      FROM a),
w AS (SELECT r.doc_id, r.lang, r.pos AS leaf_pos, leaf, r.pos, u.pos AS group_pos, u.height, 0 AS lvl,
             CASE WHEN crc % 3 = 0 THEN low_leaf ELSE leaf END AS node, '' AS proof
      FROM r JOIN u ON r.lang IS NOT DISTINCT FROM u.lang
      UNION ALL
      SELECT w.doc_id, w.lang, leaf_pos, leaf,
             CASE WHEN w.lvl + 1 = height THEN group_pos ELSE w.pos // 8 END, group_pos, height,
             w.lvl + 1, sha256(s.l || node || s.r), proof || s.l || s.r
      FROM w JOIN s ON s.lvl = w.lvl AND s.lang IS NOT DISTINCT FROM w.lang
        AND s.high = (w.lvl >= height)::INT
        AND s.pos = CASE WHEN w.lvl = 0 AND height = 0 THEN group_pos ELSE w.pos END),
z AS (SELECT *, row_number() OVER (PARTITION BY lang, leaf_pos ORDER BY lvl DESC) AS last FROM w),
top AS (SELECT digest AS root FROM g WHERE n = 1)
SELECT z.doc_id, leaf, u.digest AS subroot, root, sha256(proof) AS proof_sha256,
       node AS folded_root, node = root AS verified
FROM z JOIN u ON z.lang IS NOT DISTINCT FROM u.lang, top WHERE last = 1
""",
    "op12_order_minhash": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, count(*) AS times FROM documents GROUP BY ALL),
o AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, md5(text)) AS r, count(*) OVER () AS n
      FROM d),
e AS (SELECT a.doc_id, a.times, a.r, b.r AS next_r, a.text, length(a.text)::BIGINT AS n_chars,
             left(a.text, length(a.text) - length(a.text) // 4) || left(b.text, length(a.text) // 4)
             AS edited
      FROM o AS a JOIN o AS b ON b.r = a.r % a.n + 1),
w AS (SELECT r, kind, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w
      FROM (SELECT r, 0 AS kind, text FROM e UNION ALL SELECT r, 1, edited FROM e)),
k AS (SELECT r, kind, unnest(range(1, greatest(1, len(w) - 1) + 1)) AS p, w FROM w WHERE len(w) > 0),
h AS (SELECT r, kind, p, ('0x' || left(md5(array_to_string(w[p:p + 1], ' ')), 15))::BIGINT AS h
      FROM k),
u AS (SELECT *, CASE WHEN occ = 0 THEN h ELSE ('0x' || left(md5(h || '#' || occ), 15))::BIGINT END AS u
      FROM (SELECT *, row_number() OVER (PARTITION BY r, kind, h ORDER BY p) - 1 AS occ FROM h)),
m AS (SELECT j, ('0x' || left(md5(j::VARCHAR), 15))::BIGINT AS mask FROM range(16) AS t(j)),
b AS (SELECT r, kind, j, list_sort(min_by({'p': p, 'h': h}, xor(u, mask), 2)) AS t
      FROM u, m GROUP BY r, kind, j),
s AS (SELECT r, kind, list(left(md5(array_to_string(list_transform(t, lambda x: x.h::VARCHAR), ',')),
                                8) ORDER BY j) AS parts
      FROM b GROUP BY r, kind),
f AS (SELECT w.r, w.kind, coalesce(parts, list_transform(range(16), lambda j: left(md5(''), 8)))
             AS parts
      FROM w LEFT JOIN s ON s.r = w.r AND s.kind = w.kind)
SELECT e.doc_id, n_chars, sha256(edited) AS edited_sha256,
       array_to_string(a.parts, '') AS fingerprint, array_to_string(c.parts, '') AS edited_fingerprint,
       len(list_filter(range(1, 17), lambda j: a.parts[j] = c.parts[j])) / 16.0::DOUBLE AS near_edited,
       len(list_filter(range(1, 17), lambda j: a.parts[j] = b.parts[j])) / 16.0::DOUBLE AS near_next
FROM e JOIN f AS a ON a.r = e.r AND a.kind = 0 JOIN f AS c ON c.r = e.r AND c.kind = 1
JOIN f AS b ON b.r = e.next_r AND b.kind = 0, range(times)
""",
    "op13_prefix_trie": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT conv_id, turn, md5(strlen(role) || ':' || role || text) AS k, length(text) AS chars FROM t),
o AS (SELECT conv_id, k, chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k)
             - 1 AS i FROM k),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS base,
             xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(
                   string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                 lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                   lambda e, z: xor(e >> 1, 3988292384::BIGINT * (e & 1)))), 4294967295) % 6 AS h
      FROM t),
b AS (SELECT c.conv_id, 0 AS part, i, k, chars FROM c JOIN o ON o.conv_id = c.base AND i < h
      UNION ALL SELECT c.conv_id, 1, i, k, chars FROM c JOIN o ON o.conv_id = c.conv_id AND i >= h),
d AS (SELECT conv_id, 0 AS depth, '' AS p, 0 AS chars FROM c UNION ALL
      SELECT conv_id, row_number() OVER w, md5(array_to_string(list(k) OVER w, ',')), chars
      FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY part, i
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
l AS (SELECT *, lag(p) OVER (PARTITION BY conv_id ORDER BY depth) AS up,
             max(depth) OVER (PARTITION BY conv_id) = depth AS ends FROM d),
n AS (SELECT p, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(up) AS up,
             any_value(chars) AS chars, count(*) AS n_convs,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), ''))
             AS ends_sha256 FROM l GROUP BY p),
q AS (SELECT up AS p, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
s AS (SELECT l.p, sum((n.n_convs - 1) * n.chars) AS saved_tokens,
             count(*) FILTER (q.n_children IS NULL) AS n_leaves
      FROM n LEFT JOIN q ON q.p = n.p JOIN l ON l.conv_id = n.conv_id AND l.depth <= n.depth
      GROUP BY l.p)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens,
       n.ends_sha256
FROM n JOIN s ON s.p = n.p LEFT JOIN q ON q.p = n.p LEFT JOIN n AS u ON u.p = n.up
""",
}
