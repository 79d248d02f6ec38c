"""DuckDB statements for the registered queries that SQL can express."""

from __future__ import annotations

_URL_PARTS = """
  SELECT page_id, url,
         coalesce(translate(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path,
         regexp_replace('&' || coalesce(regexp_extract(url, '://[^?#]*\\?([^#]*)', 1), ''), '&(?:utm_[a-z]+|ref|gclid|fbclid)=[^&]*', '', 'g') AS q0
  FROM pages"""

OP10 = f"""
WITH u AS ({_URL_PARTS}),
c AS (
  SELECT *, regexp_replace(regexp_replace(q0, '&+', '&', 'g'), '^&|&$', '', 'g') AS q FROM u),
k AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/+$', '')
                 || CASE WHEN q <> '' THEN '?' || q ELSE '' END END AS canon
  FROM c),
names AS (
  SELECT DISTINCT canon FROM k
  WHERE regexp_extract(host, '([^.]+)\\.example\\.[a-z]+$', 1)
        IN ('ads-track', 'adult-x', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm')),
j AS (
  SELECT page_id, host, path,
         CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
              WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
              WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
              WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
              WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule,
         coalesce(canon IN (SELECT canon FROM names WHERE canon IS NOT NULL), false) AS listed
  FROM k)
SELECT page_id, host, path, rule, listed,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM j
"""

OP3 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
r AS (SELECT row_number() OVER () AS k, * FROM d),
win AS (
  SELECT k, unnest(range(1, len(w) - 1)) AS p, w FROM r WHERE len(w) >= 3),
win2 AS (SELECT k, p, [w[p], w[p + 1], w[p + 2]] AS g FROM win),
rep AS (SELECT k, p FROM (SELECT k, p, count(*) OVER (PARTITION BY k, g) AS n FROM win2) WHERE n >= 2),
cov AS (
  SELECT k, sum(least(3, p - q)) AS c
  FROM (SELECT k, p, coalesce(lag(p) OVER (PARTITION BY k ORDER BY p), p - 3) AS q FROM rep) GROUP BY k),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         (length(t) - length(replace(t, '!', '')))::BIGINT AS n_exclaims,
         coalesce(c, 0)::BIGINT AS n_repeat_words
  FROM r LEFT JOIN cov USING (k)),
b AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
           + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
           + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
           + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
           + CASE WHEN 10 * n_exclaims > 3 * n_words THEN 16 ELSE 0 END
           + CASE WHEN word_chars < 2 * n_words THEN 32 ELSE 0 END
           + CASE WHEN word_chars > 15 * n_words THEN 64 ELSE 0 END)::BIGINT AS fail_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits,
       CASE fail_bits WHEN 1 THEN 'few_words' WHEN 2 THEN 'repeated_windows' WHEN 4 THEN 'symbols' WHEN 8 THEN 'duplicate_lines'
                      WHEN 16 THEN 'exclamations' WHEN 32 THEN 'short_words' WHEN 64 THEN 'long_words' END AS sole_rule,
       CASE WHEN fail_bits IN (1, 2, 4, 8, 16, 32, 64) THEN count(*) OVER (PARTITION BY fail_bits) END AS ablation_gain
FROM b
"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP4 = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT item_id, least(13, len(w)) AS m, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p, w FROM b WHERE len(w) > 0),
pat AS (SELECT DISTINCT item_id, m, array_to_string(w[p:p + m - 1], ' ') AS g FROM bw),
lens AS (SELECT DISTINCT m FROM pat),
dw AS (SELECT k, m, unnest(range(1, len(w) - m + 2)) AS p, w FROM d, lens WHERE len(w) >= m),
hit AS (
  SELECT dw.k, dw.p, dw.m, pat.item_id
  FROM (SELECT k, p, m, array_to_string(w[p:p + m - 1], ' ') AS g FROM dw) dw JOIN pat ON pat.m = dw.m AND pat.g = dw.g),
words AS (SELECT k, count(DISTINCT q) AS n_hit FROM (SELECT k, unnest(range(p, p + m)) AS q FROM hit) GROUP BY k),
items AS (
  SELECT k, count(*) AS n_items, sha256(string_agg(i, ',' ORDER BY i)) AS s
  FROM (SELECT DISTINCT k, item_id::VARCHAR AS i FROM hit) GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN words USING (k) LEFT JOIN items USING (k)
"""

OP6 = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT k, unnest(range(1, len(w) - 33)) AS p, w FROM d WHERE len(w) >= 35),
g AS (SELECT k, p, sha256(array_to_string(w[p:p + 34], ' ')) AS h FROM win),
rep AS (SELECT k, p FROM (SELECT k, p, count(*) OVER (PARTITION BY h) AS n FROM g) WHERE n > 1),
gone AS (SELECT DISTINCT k, unnest(range(p, p + 35)) AS q FROM rep),
words AS (SELECT k, unnest(range(1, len(w) + 1)) AS q, unnest(w) AS x FROM d),
kept AS (
  SELECT k, count(*) AS n, string_agg(x, ' ' ORDER BY q) AS s
  FROM words ANTI JOIN gone USING (k, q) GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (k)
"""

OP7 = """
WITH tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, k:
           CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS t),
d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
         xor(list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
               lambda x: ('0x' || x)::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS crc
  FROM documents, tab),
s AS (
  SELECT *, floor(coalesce(sum(size) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT * 16
                  // sum(size) OVER ())::INT AS shard
  FROM d)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'bytes' AS law, shard,
       (row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1)::BIGINT AS slot, NULL::INT AS grown_shard
FROM s
"""

#: CRC-32 of a blob by its table, for short values
_CRC_TABLE = """tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, k:
           CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS t)"""


def _crc(blob: str) -> str:
    return f"""xor(list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all(hex({blob}), '..'), lambda x: ('0x' || x)::BIGINT),
                  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)"""


OP11 = f"""
WITH {_CRC_TABLE},
d AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT {_WORDS} AS w FROM benchmark),
df AS (SELECT k, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM d),
bf AS (SELECT unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM b),
grams AS (
  SELECT g, {_crc("encode(g)")} % 10000 AS bucket FROM (SELECT g FROM df UNION SELECT g FROM bf), tab),
s AS (SELECT bucket, count(*) AS n FROM df JOIN grams USING (g) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bf JOIN grams USING (g) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE
                       / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s FULL JOIN t USING (bucket)),
f AS (SELECT k, count(*) AS n, sum(gain) AS total FROM df JOIN grams USING (g) JOIN gain USING (bucket) GROUP BY k),
m AS (
  SELECT k, doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features,
         coalesce((total - ((total % n) + n) % n) // n, 0)::BIGINT AS weight,
         ('0x' || sha256('7:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT AS h
  FROM d LEFT JOIN f USING (k)),
r AS (SELECT *, weight + floor(-1000.0 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM m),
o AS (
  SELECT *, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) END AS p,
         count(*) FILTER (WHERE n_words >= 20) OVER () AS n
  FROM r)
SELECT doc_id, n_features, weight, score, CASE WHEN p <= 25 * n // 100 THEN p END AS rank, n_words::BIGINT AS n_words
FROM o
"""


def _field(c: str) -> str:
    return f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}, '-')"


_LEAF = "sha256({0} || {1} || {2} || {3} || {4})"

OP12 = f"""
WITH RECURSIVE {_CRC_TABLE},
leaves AS (
  SELECT row_number() OVER () AS k, doc_id, lang,
         {_LEAF.format(*map(_field, ("doc_id", "source", "lang", "n_chars", "text")))} AS leaf,
         {_LEAF.format(*map(_field, ("doc_id", "source", "lang", f"(n_chars + CASE WHEN {_crc('encode(doc_id::VARCHAR)')} % 7 = 0 THEN 1 ELSE 0 END)", "text")))} AS shown
  FROM documents, tab),
trees AS (SELECT lang, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT lang FROM leaves)),
placed AS (
  SELECT l.*, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
  FROM leaves l JOIN trees ON l.lang IS NOT DISTINCT FROM trees.lang),
nodes AS (
  SELECT tree, 0 AS level, pos, leaf AS h, n FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 2, n),
tops AS (
  SELECT 0 AS level, tree AS pos, h, (SELECT count(*) FROM trees) AS n FROM nodes WHERE n = 1
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM tops WHERE n > 1 GROUP BY level, pos // 2, n),
sides AS (
  SELECT tree, false AS top, level, pos, h, n FROM nodes
  UNION ALL SELECT -1, true, level, pos, h, n FROM tops),
climb AS (
  SELECT k, tree, false AS top, 0 AS level, pos, n, '' AS proof, shown AS f, NULL::VARCHAR AS subroot FROM placed
  UNION ALL
  SELECT k, c.tree, CASE WHEN c.n > 1 THEN c.top ELSE true END, CASE WHEN c.n > 1 THEN c.level + 1 ELSE 0 END,
         CASE WHEN c.n > 1 THEN c.pos // 2 ELSE c.tree END, CASE WHEN c.n > 1 THEN (c.n + 1) // 2 ELSE (SELECT count(*) FROM trees) END,
         CASE WHEN c.n > 1 THEN proof || coalesce(s.h, '') ELSE proof END,
         CASE WHEN c.n > 1 THEN sha256(CASE WHEN c.pos % 2 = 1 THEN s.h || f ELSE f || coalesce(s.h, '') END) ELSE f END,
         coalesce(subroot, CASE WHEN c.n = 1 THEN me.h END)
  FROM climb c
  LEFT JOIN sides s ON s.top = c.top AND s.tree = CASE WHEN c.top THEN -1 ELSE c.tree END AND s.level = c.level AND s.pos = xor(c.pos, 1)
  LEFT JOIN sides me ON me.top = c.top AND me.tree = CASE WHEN c.top THEN -1 ELSE c.tree END AND me.level = c.level AND me.pos = c.pos
  WHERE c.n > 1 OR NOT c.top),
done AS (SELECT * FROM climb WHERE top AND n = 1)
SELECT doc_id, leaf, subroot, (SELECT h FROM tops WHERE n = 1) AS root, sha256(proof) AS proof_sha256, f AS folded_root,
       f = (SELECT h FROM tops WHERE n = 1) AS verified
FROM placed JOIN done USING (k)
"""

ORACLES = {
    "op3_quality_rules": OP3,
    "op4_decontaminate": OP4,
    "op6_substring_dedup": OP6,
    "op7_shards": OP7,
    "op10_url_filter": OP10,
    "op11_importance": OP11,
    "op12_merkle": OP12,
}
