"""DuckDB statements for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

OP5 = rf"""
WITH base AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size,
         coalesce('+' || source, '-') AS src, source IS NULL AS src_null,
         md5('mix-1|' || coalesce(doc_id::VARCHAR, '-') || '|' || md5(coalesce(text, ''))) AS k
  FROM documents),
tot AS (SELECT greatest(1, least(8192, ceil(sum(size) / 65536)))::BIGINT AS n_shards FROM base),
sharded AS (SELECT base.*, ('0x' || substr(k, 1, 8))::BIGINT % n_shards AS shard FROM base, tot),
shards AS (SELECT src, src_null, shard, sum(size)::BIGINT AS t FROM sharded GROUP BY ALL),
sizes AS (SELECT src, src_null, sum(t)::BIGINT AS source_size FROM shards GROUP BY ALL),
weighed AS (
  SELECT src, source_size, 3 * source_size AS cap,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY src_null, src) - 1) % 3] AS w FROM sizes),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM weighed),
tgt AS (
  SELECT src, source_size,
         least(cap::DOUBLE, (SELECT arg_min(lev, (cap / w, src)) FROM levels WHERE lev * w <= cap) * w) AS target FROM levels),
-- seats by rounding, then the difference by highest quotients
r1 AS (
  SELECT src, source_size, target, target / sum(target) OVER () AS share,
         round(sum(target) OVER () / 64)::BIGINT AS n FROM tgt),
r2 AS (SELECT *, CASE WHEN target > 0 THEN floor(share * n + 0.5) ELSE 0 END AS s0 FROM r1),
r3 AS (SELECT *, (n - sum(s0) OVER ())::BIGINT AS diff FROM r2),
qs AS (
  SELECT src, s0, diff, CASE WHEN diff > 0 THEN target / (2 * (s0 + j) + 1)
                             WHEN s0 - j >= 1 THEN target / (2 * (s0 - j) - 1) END AS q
  FROM r3, range(0, 200) AS g(j) WHERE diff <> 0 AND target > 0 AND j < abs(diff)),
qr AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN diff > 0 THEN -q ELSE q END, src) AS pos FROM qs WHERE q IS NOT NULL),
blocks AS (
  SELECT r3.*, s0 + sign(diff) * (SELECT count(*) FROM qr WHERE qr.src = r3.src AND pos <= abs(r3.diff)) AS blocks FROM r3),
h1 AS (
  SELECT s.src, s.shard, s.t, b.source_size, b.target, b.blocks,
         CASE WHEN sum(s.t) OVER (PARTITION BY s.src) > 0 THEN s.t / sum(s.t) OVER (PARTITION BY s.src) ELSE 0 END AS share
  FROM shards s JOIN blocks b USING (src)),
h2 AS (SELECT *, floor(share * blocks + 0.5) AS s0 FROM h1),
h3 AS (SELECT *, (blocks - sum(s0) OVER (PARTITION BY src))::BIGINT AS diff FROM h2),
hq AS (
  SELECT src, shard, diff, CASE WHEN diff > 0 THEN t / (2 * (s0 + j) + 1)
                                WHEN s0 - j >= 1 THEN t / (2 * (s0 - j) - 1) END AS q
  FROM h3, range(0, 200) AS g(j) WHERE diff <> 0 AND t > 0 AND j < abs(diff)),
hr AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY CASE WHEN diff > 0 THEN -q ELSE q END, shard) AS pos
       FROM hq WHERE q IS NOT NULL),
hw AS (SELECT src, shard, count(*) AS won FROM hr WHERE pos <= abs(diff) GROUP BY ALL),
quota AS (
  SELECT h3.*, least((s0 + sign(diff) * coalesce(won, 0))::BIGINT * 64, 3 * t)::BIGINT AS take,
         greatest(t, 1) AS t1 FROM h3 LEFT JOIN hw USING (src, shard)),
plan AS (
  SELECT *, take // t1 AS turns, take - (take // t1) * t AS rest,
         ('0x' || substr(md5('mix-1|' || src || '|' || shard::VARCHAR), 1, 8))::BIGINT % ceil(t1 / 64)::BIGINT * 64 AS start FROM quota),
runs AS (
  SELECT doc_id, size, src, shard,
         sum(size) OVER (PARTITION BY src, shard ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS hi FROM sharded)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
       (turns * size + greatest(least(hi, least(start + rest, t)) - greatest(hi - size, start), 0)
        + greatest(least(hi, start + rest - t) - greatest(hi - size, 0), 0))::BIGINT AS taken
FROM runs JOIN plan USING (src, shard)
"""

OP2 = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
win AS (SELECT *, [ws[i:i + 2] FOR i IN range(1, len(ws) - 1)] AS wins FROM w),
rep AS (SELECT *, [x FOR x IN map_entries(list_histogram(wins)) IF x.value > 1] AS twice FROM win),
pos AS (
  SELECT *, [x.key FOR x IN twice] AS tw,
         [l FOR l IN string_split(t, chr(10)) IF regexp_matches(l, '{_WORD}')] AS lines FROM rep),
cov AS (
  SELECT *, CASE WHEN len(tw) = 0 THEN [] ELSE [i FOR i IN range(1, len(ws) - 1) IF list_contains(tw, ws[i:i + 2])] END AS hits FROM pos),
m AS (
  SELECT doc_id, len(ws) AS n_words, list_sum([length(x) FOR x IN ws])::BIGINT AS word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         len(list_distinct(flatten([[i, i + 1, i + 2] FOR i IN hits]))) AS n_repeat_words,
         length(t) - length(translate(t, '0123456789', '')) AS n_digits FROM cov),
f AS (
  SELECT *, coalesce(word_chars, 0) AS wc,
         (n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (100 * n_symbols > 60 * n_words)::INT
         + 8 * (100 * n_dup_lines > 50 * n_lines)::INT
         + 16 * (coalesce(word_chars, 0) > 15 * n_words OR 2 * n_words > coalesce(word_chars, 0))::INT
         + 32 * (100 * n_digits > 30 * coalesce(word_chars, 0))::INT AS fail_bits FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, wc::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits::BIGINT AS fail_bits
FROM f
"""

OP7 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
                      ELSE list_distinct([ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FOR i IN range(1, len(ws) - 1)]) END AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
sym AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS id, doc_id AS root FROM s UNION SELECT sym.y, reach.root FROM reach JOIN sym ON reach.id = sym.x)
SELECT s.doc_id, len(sh)::BIGINT AS n_shingles, (SELECT min(root) FROM reach WHERE id = s.doc_id) AS component_id FROM s
"""

#: CRC-32 of the decimal digits of an id: each character is a step and seven more.
_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '{_LETTERS}') AS ws FROM documents),
items AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_LETTERS}') AS ws FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, unnest([array_to_string(ws[k:k + 9], ' ') FOR k IN range(1, greatest(len(ws) - 9, 1) + 1)]) AS win
  FROM items WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT n FROM wins),
grams AS (
  SELECT rid, n, unnest([{{'p': k, 'win': array_to_string(ws[k:k + n - 1], ' ')}} FOR k IN range(1, len(ws) - n + 2)]) AS g
  FROM docs, sizes WHERE len(ws) >= n),
occ AS (SELECT rid, g.p AS p, grams.n, item_id FROM grams JOIN wins ON grams.n = wins.n AND g.win = wins.win),
hits AS (SELECT rid, count(DISTINCT w) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS w FROM occ) GROUP BY rid),
named AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM occ WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (rid) LEFT JOIN named USING (rid)
"""


def _crc32(id_: str) -> str:
    steps = f"[[ord(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0] FOR x IN string_split({id_}::VARCHAR, '')]"
    step = "xor(xor(crc, x) >> 1, (xor(crc, x) & 1) * 3988292384)"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten({steps})), lambda crc, x: {step}))"


OP12 = rf"""
WITH raw AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws,
         coalesce({_crc32('doc_id')}, 1) AS h FROM documents),
par AS (SELECT *, len(ws) AS n, h // 10 AS g FROM raw),
cut AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM par),
new AS (
  SELECT rid, doc_id, n, CASE WHEN a >= n THEN ws
    ELSE ws[1:a] || [ws[a + 1 + k % (1 + (n - a) // (3 + g % 8))] FOR k IN range(0, n - a)] END AS ws FROM cut),
w AS (SELECT rid, n, unnest(ws) AS word, unnest(range(0, n)) AS i FROM new),
eq AS (SELECT x.rid, y.i - x.i AS q, x.i FROM w x JOIN w y ON x.rid = y.rid AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
isl AS (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS grp FROM eq),
cand AS (SELECT rid, q, min(i) AS s, count(*) + q AS len FROM isl GROUP BY rid, q, grp HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT rid, s, len, min(q) AS q FROM cand GROUP BY ALL),
agg AS (
  SELECT rid, count(*) AS n_runs, arg_min({{'s': s, 'len': len, 'q': q}}, (-len, s, q)) AS top,
         sha256(string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q)) AS runs_sha256 FROM runs GROUP BY rid),
gone AS (SELECT DISTINCT rid, unnest(range(s + q, s + len)) AS i FROM runs),
kept AS (
  SELECT w.rid, string_agg(word, ' ' ORDER BY w.i) AS t FROM w ANTI JOIN gone ON w.rid = gone.rid AND w.i = gone.i GROUP BY w.rid)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, top.s::BIGINT AS start, top.len::BIGINT AS length, top.q::BIGINT AS period,
       (1000 * top.len // top.q)::BIGINT AS exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256,
       sha256(coalesce(t, '')) AS collapsed_sha256
FROM new LEFT JOIN agg USING (rid) LEFT JOIN kept USING (rid)
"""

# a prefix is named by the MD5 of its turns' digests
OP13 = f"""
WITH t AS (
  SELECT conv_id AS c, md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) AS e, length(coalesce(text, '')) AS len,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS r FROM conversations WHERE conv_id IS NOT NULL),
conv AS (
  SELECT c, max(r) + 1 AS n, {_crc32('c')} % 6 AS h, c - c % 100 AS base FROM t GROUP BY c),
parts AS (
  SELECT conv.c, 0 AS half, t.r, e, len FROM conv JOIN t ON t.c = base AND t.r < h
  UNION ALL SELECT conv.c, 1, t.r, e, len FROM conv JOIN t ON t.c = conv.c AND t.r >= h),
seq AS (SELECT c, list(e ORDER BY half, r) AS es, list(len ORDER BY half, r) AS lens FROM parts GROUP BY c),
conv2 AS (SELECT conv.c, coalesce(es, []) AS es, coalesce(lens, []) AS lens FROM conv LEFT JOIN seq USING (c)),
pre AS (
  SELECT c, len(es) AS n, unnest([{{'d': d, 'k': md5(array_to_string(es[1:d], ' ')), 'p': md5(array_to_string(es[1:d - 1], ' ')),
         'len': CASE WHEN d = 0 THEN 0 ELSE lens[d] END}} FOR d IN range(0, len(es) + 1)], recursive := true) FROM conv2),
node AS (
  SELECT d, k, any_value(p) AS p, min(c) AS conv_id, count(*) AS n_convs, max(len) AS len, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d) AS ends
  FROM pre GROUP BY d, k),
kids AS (SELECT d - 1 AS d, p AS k, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
full_ AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (d, k)),
-- every node under each prefix of its smallest member
under AS (
  SELECT a.d, a.k, sum((f.n_convs - 1) * f.len) AS saved, count(*) FILTER (f.n_children = 0) AS n_leaves
  FROM full_ f JOIN pre a ON a.c = f.conv_id AND a.d <= f.d GROUP BY a.d, a.k)
SELECT f.conv_id, f.d::BIGINT AS depth, up.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(f.ends, '')) AS ends_sha256
FROM full_ f JOIN under USING (d, k) LEFT JOIN full_ up ON up.d = f.d - 1 AND up.k = f.p
"""


def statements() -> dict[str, str]:
    return {"op2_quality_ledger": OP2, "op5_mix_apportion": OP5, "op7_jaccard_join": OP7, "op11_set_decontam": OP11, "op12_periodic_runs": OP12,
            "op13_prefix_trie": OP13}
