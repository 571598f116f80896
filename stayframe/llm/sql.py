"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

from .quality_rules import BITS, PRIOR, RULES

#: Jump consistent hashing step by step; crc32 from its polynomial.
JUMP_SHARD = r"""
WITH RECURSIVE keys AS (SELECT DISTINCT coalesce(doc_id, 0) AS k FROM documents),
jump AS (
  SELECT k, n, CAST(CASE WHEN k < 0 THEN 18446744073709551616::HUGEINT + k ELSE k END AS UHUGEINT) AS s,
         CAST(-1 AS BIGINT) AS b, CAST(0 AS BIGINT) AS j FROM keys, (VALUES (8), (9)) v(n)
  UNION ALL
  SELECT k, n, (s * 2862933555777941757::UHUGEINT + 1::UHUGEINT) % 18446744073709551616::UHUGEINT, j,
         CAST(floor((j + 1) * (2147483648.0::DOUBLE / CAST(CAST(((s * 2862933555777941757::UHUGEINT + 1::UHUGEINT)
              % 18446744073709551616::UHUGEINT) // 8589934592::UHUGEINT AS BIGINT) + 1 AS DOUBLE))) AS BIGINT)
  FROM jump WHERE j < n),
shards AS (SELECT k, n, b AS shard FROM jump WHERE j >= n),
crc_table AS (SELECT list(list_reduce([i] || range(8), lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
              FROM range(256) r(i)),
texts AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
sums AS (
  SELECT doc_id, size, xor(list_reduce([4294967295] || list_transform(range(1, length(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT)),
         lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS text_crc32 FROM texts, crc_table)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, CAST(a.shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY a.shard ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), 'null:' || text_crc32)), doc_id, text_crc32, size) - 1 AS slot,
       CAST(g.shard AS INTEGER) AS grown_shard
FROM sums JOIN shards a ON a.n = 8 AND a.k = coalesce(doc_id, 0) JOIN shards g ON g.n = 9 AND g.k = coalesce(doc_id, 0)"""

#: Every 50-byte string (100 hexadecimal digits) and the least doc_id that has it.
SUFFIX_REPEATS = r"""
WITH d AS (SELECT coalesce(doc_id, 9223372036854775807) AS id, row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT id, row, unnest(range(0, length(h) // 2 - 49)) AS p, h FROM d WHERE length(h) >= 100),
strings AS (SELECT id, row, p, md5(substr(h, 2 * p + 1, 100)) AS s FROM starts),
first AS (SELECT s, min(id) AS least FROM strings GROUP BY s),
hits AS (SELECT row, p, max(p + 50) OVER (PARTITION BY row ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto
         FROM strings JOIN first USING (s) WHERE least < id),
runs AS (SELECT row, p, sum(CASE WHEN upto IS NULL OR upto < p THEN 1 ELSE 0 END) OVER (PARTITION BY row ORDER BY p) AS run FROM hits),
spans AS (SELECT row, min(p) AS a, max(p) + 50 AS b FROM runs GROUP BY row, run),
gaps AS (SELECT d.row, coalesce(lag(s.b) OVER (PARTITION BY d.row ORDER BY s.a), 0) AS a, s.a AS b FROM d JOIN spans s USING (row)
         UNION ALL SELECT d.row, coalesce(max(s.b), 0), any_value(length(d.h)) // 2 FROM d LEFT JOIN spans s USING (row) GROUP BY d.row),
kept AS (SELECT g.row, string_agg(substr(d.h, 2 * g.a + 1, 2 * (g.b - g.a)), '' ORDER BY g.a) AS k FROM gaps g JOIN d USING (row) GROUP BY g.row),
found AS (SELECT row, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY row)
SELECT d.doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(kept.k)) AS kept_sha256
FROM d JOIN kept USING (row) LEFT JOIN found USING (row)"""


def _quantiles(name: str, keys: str) -> str:
    by = f"PARTITION BY {keys}, rule" if keys else "PARTITION BY rule"
    group = f"{keys}, " if keys else ""
    return f"""{name}_bins AS (SELECT {group}rule, low, high, bin, sum(n) AS n FROM sketch GROUP BY {group}rule, low, high, bin),
{name}_ranked AS (SELECT *, sum(n) OVER ({by}) AS total, sum(n) OVER ({by} ORDER BY bin) AS upto FROM {name}_bins),
{name} AS (SELECT {group}rule, max(total) AS total, min(bin) FILTER (1000 * upto >= low * total) AS lo, min(bin) FILTER (1000 * upto >= high * total) AS hi
           FROM {name}_ranked GROUP BY {group}rule)"""


def _drawn(side: str) -> str:
    lang = f"((l.total * l.{side} + {PRIOR} * e.{side}) // (l.total + {PRIOR}))"
    return f"(o.total * o.{side} + {PRIOR} * {lang}) // (o.total + {PRIOR})"


_VALUES = "\n  UNION ALL ".join(
    f"SELECT row, lang, source, base_failed, '{r.name}' AS rule, {r.value.replace(' div ', ' // ')} AS value, {r.low} AS low, {r.high} AS high, {r.least} AS least, "
    f"{r.reach} AS reach, {r.two_sided} AS two_sided FROM judged"
    for r in RULES)

ADAPTIVE_RULES = rf"""
WITH d AS (SELECT *, row_number() OVER () AS row, coalesce(text, '') AS t FROM documents),
w AS (SELECT row, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
windows AS (SELECT row, i, array_to_string(words[i:i + 7], ' ') AS g FROM (SELECT row, words, unnest(range(1, len(words) - 6)) AS i FROM w)),
twice AS (SELECT row, i, count(*) OVER (PARTITION BY row, g) AS c FROM windows),
covered AS (SELECT row, sum(least(8, after - i)) AS n FROM (
  SELECT row, i, coalesce(lead(i) OVER (PARTITION BY row ORDER BY i), i + 8) AS after FROM twice WHERE c > 1) z GROUP BY row),
lines AS (SELECT row, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM (
    SELECT d.row, d.doc_id, d.lang, d.source, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
           CAST(len(l) AS BIGINT) AS n_lines, CAST(length(regexp_replace(t, '[^!-/:-@\[-`{{-~0-9]+', '', 'g')) AS BIGINT) AS n_marks
    FROM d JOIN w USING (row) JOIN lines USING (row) LEFT JOIN covered USING (row)) y),
measured AS ({_VALUES}),
binned AS (SELECT *, greatest(length(bin(value)) - {BITS}, 0) AS shift FROM measured WHERE NOT base_failed),
sketch AS (SELECT lang, source, rule, low, high, (value >> shift) << shift AS bin, count(*) AS n FROM binned GROUP BY ALL),
{_quantiles("own", "lang, source")},
{_quantiles("by_lang", "lang")},
{_quantiles("every", "")},
fenced AS (
  SELECT m.row, value, least, reach, two_sided, {_drawn("lo")} AS lo, {_drawn("hi")} AS hi
  FROM measured m JOIN own o ON m.rule = o.rule AND m.lang IS NOT DISTINCT FROM o.lang AND m.source IS NOT DISTINCT FROM o.source
  JOIN by_lang l ON m.rule = l.rule AND m.lang IS NOT DISTINCT FROM l.lang JOIN every e ON m.rule = e.rule),
verdict AS (SELECT row, bool_and(value <= hi + reach * greatest(hi - lo, least) AND (NOT two_sided OR value >= lo - reach * greatest(hi - lo, least))) AS passed
            FROM fenced GROUP BY row)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(passed, false) AS kept
FROM judged LEFT JOIN verdict USING (row)"""

#: Every node of the rebuilt conversations by the digest of its path; sums over
#: its subtree from the path of each node's smallest member.
PREFIX_TRIE = r"""
WITH crc_table AS (SELECT list(list_reduce([i] || range(8), lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
              FROM range(256) r(i)),
turns AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || '/' || coalesce(role, '') || coalesce(text, '')), length(text)) AS pos
          FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, count(*) AS n, hex(encode(CAST(c AS VARCHAR))) AS x FROM turns GROUP BY c),
heads AS (SELECT c, n, xor(list_reduce([4294967295] || list_transform(range(1, length(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT)),
                               lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 6 AS h FROM ids, crc_table),
lifted AS (SELECT a.c, a.h, least(coalesce(b.n, 0), a.h) AS m FROM heads a LEFT JOIN heads b ON b.c = a.c - a.c % 100),
rebuilt AS (SELECT l.c, t.pos AS d, t.role, t.text FROM lifted l JOIN turns t ON t.c = l.c - l.c % 100 AND t.pos <= l.h
            UNION ALL SELECT l.c, t.pos - l.h + l.m, t.role, t.text FROM lifted l JOIN turns t ON t.c = l.c AND t.pos > l.h),
paths AS (SELECT c, d, length(text) AS chars, md5(string_agg(md5(length(role) || '/' || role || text), '') OVER (PARTITION BY c ORDER BY d)) AS node FROM rebuilt
          UNION ALL SELECT c, 0, 0, '' FROM ids),
steps AS (SELECT *, lag(node) OVER (PARTITION BY c ORDER BY d) AS parent, d = max(d) OVER (PARTITION BY c) AS ends FROM paths),
nodes AS (SELECT node, any_value(d) AS depth, any_value(parent) AS parent, any_value(chars) AS chars, min(c) AS c, count(*) AS n,
                 coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '') AS own FROM steps GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS k FROM nodes WHERE parent IS NOT NULL GROUP BY 1),
below AS (SELECT s.node, sum((v.n - 1) * v.chars) AS saved, sum(CASE WHEN k.k IS NULL THEN 1 ELSE 0 END) AS leaves
          FROM nodes v JOIN steps s ON s.c = v.c AND s.d <= v.depth LEFT JOIN kids k ON k.node = v.node GROUP BY s.node)
SELECT v.c AS conv_id, CAST(v.depth AS BIGINT) AS depth, u.c AS parent_conv_id, v.n AS n_convs, coalesce(k.k, 0) AS n_children,
       CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(v.own) AS ends_sha256
FROM nodes v JOIN below b USING (node) LEFT JOIN kids k USING (node) LEFT JOIN nodes u ON u.node = v.parent"""


def _vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Rounds written one after another; distances by component, in whole numbers."""
    near = """SELECT r, p, min(d * 256 + e) % 256 AS e, min(d * 256 + e) // 256 AS d FROM (
  SELECT a.r, a.p, b.e, CAST(sum((a.x - b.x) * (a.x - b.x)) AS HUGEINT) AS d FROM cells a JOIN book{k} b ON a.p = b.p AND a.j = b.j GROUP BY 1, 2, 3) z GROUP BY 1, 2"""
    steps = "".join(f"""near{k} AS MATERIALIZED ({near.format(k=k)}),
mean{k} AS (SELECT n.p, n.e, c.j, CAST(sum(c.x) AS BIGINT) AS s, count(*) AS n FROM near{k} n JOIN cells c ON n.r = c.r AND n.p = c.p GROUP BY 1, 2, 3),
book{k + 1} AS MATERIALIZED (SELECT b.p, b.e, b.j, CASE WHEN m.n IS NULL THEN b.x ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS x
  FROM book{k} b LEFT JOIN mean{k} m ON b.p = m.p AND b.e = m.e AND b.j = m.j),
""" for k in range(rounds))
    return f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
ranked AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS r FROM kept),
flat AS (SELECT r, unnest(v) AS x, unnest(range(len(v))) AS i, len(v) // {parts} AS w FROM ranked),
cells AS MATERIALIZED (SELECT r, x, i // w AS p, i % w AS j FROM flat),
book0 AS MATERIALIZED (SELECT p, r AS e, j, x FROM cells WHERE r < {entries}),
{steps}last AS (SELECT r, string_agg(printf('%02x', CAST(e AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM ({near.format(k=rounds)}) z GROUP BY r)
SELECT v.vec_id, l.code, l.error, CAST(sum(l.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, j)) FROM book{rounds}) AS codebooks_sha256
FROM ranked v JOIN last l USING (r)"""


SQL = {"op3_jump_shard": JUMP_SHARD, "op6_suffix_repeats": SUFFIX_REPEATS, "op7_adaptive_rules": ADAPTIVE_RULES, "op11_prefix_trie": PREFIX_TRIE, "op13_vector_codes": _vector_codes()}
