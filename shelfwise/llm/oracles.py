"""DuckDB statements for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"
_ALNUM_WORDS = r"regexp_extract_all(coalesce(" + _LOWER + r", ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = f"""
WITH d AS (SELECT doc_id, {_ALNUM_WORDS.format('text')} AS ws FROM documents),
i AS (SELECT item_id, {_ALNUM_WORDS.format('text')} AS ws FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS n, array_to_string(ws[s : s + least(13, len(ws)) - 1], ' ') AS w
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS s FROM i WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, n, p, array_to_string(ws[p : p + n - 1], ' ') AS w
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM d, sizes WHERE len(ws) >= n)),
occ AS (SELECT doc_id, p, dw.n, item_id FROM dw JOIN iw USING (n, w)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM occ) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP2 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                   (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
s AS (
  SELECT *, length('<|im_start|>') + length(replace(replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), '%', '%25'), chr(10), '%0A')) + 1
         + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + length('<|im_end|>') + 1 AS seg,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM t),
c AS (SELECT *, sum(seg) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM s)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (WHERE role = 'assistant' OR k = n) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

OP10 = rf"""
WITH d AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS t, {_SPACE_WORDS.format('text')} AS ws FROM documents),
m AS (
  SELECT doc_id, host, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
         len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
           - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines, ws
  FROM d),
w AS (SELECT doc_id, p, array_to_string(ws[p : p + 4], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS p FROM m WHERE len(ws) >= 5)),
r AS (SELECT doc_id, p FROM w QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT q) AS n_repeat_words FROM (SELECT doc_id, unnest(range(p, p + 5)) AS q FROM r) GROUP BY doc_id),
b AS (
  SELECT m.* EXCLUDE (ws), coalesce(n_repeat_words, 0) AS n_repeat_words,
         n_words < 10 OR 100 * coalesce(n_repeat_words, 0) > 20 * n_words AS base_failed
  FROM m LEFT JOIN rep USING (doc_id)),
h AS (SELECT host, count(*) AS hd, sum(CAST(base_failed AS INT)) AS hf FROM b GROUP BY host),
mo AS (SELECT avg(hf / hd) AS m, var_pop(hf / hd) AS v FROM h),
pr AS (SELECT m, least(greatest(CASE WHEN v = 0 THEN 1e6 ELSE m * (1 - m) / v - 1 END, 1.0), 1e6) AS k FROM mo),
hr AS (SELECT host, (hf + m * k) / (hd + k) AS host_rate FROM h, pr)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND host_rate <= 0.5 AS kept, b.host, round(host_rate, 9) AS host_rate
FROM b JOIN hr ON b.host IS NOT DISTINCT FROM hr.host
"""

OP6 = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest
"""



def _discounts(n: str) -> str:
    """The discounts of counts 1 to 5 as a list, from a row ``n`` with n1 to n6."""
    out = "CASE"
    for k in range(5, 0, -1):
        a = f"({k + 1} * {n}.n{k + 1} / {n}.n1)"
        d = [f"(({r + 1} * {n}.n{r + 1} / ({r} * {n}.n{r}) - {a}) / (1 - {a}))" for r in range(1, k + 1)]
        some = " AND ".join(f"{n}.n{r} > 0" for r in range(1, k + 2))
        out += f" WHEN {some} AND {a} < 1 AND " + " AND ".join(f"{x} > 0 AND {x} <= 1" for x in d)
        out += f" THEN [{', '.join(d + ['1.0'] * (5 - k))}]"
    off = f"(CASE WHEN {n}.n1 > 0 THEN least(0.9, {n}.n1 / ({n}.n1 + 2 * {n}.n2)) ELSE 0.5 END)"
    return out + f" ELSE [{', '.join(f'({r} - {off}) / {r}' for r in range(1, 6))}] END"


_COUNTS_OF_COUNTS = ", ".join(f"CAST(count(*) FILTER (c = {r}) AS DOUBLE) AS n{r}" for r in range(1, 7))
_KEPT = "(CASE WHEN {0}.c <= 5 THEN {1}[{0}.c] * {0}.c ELSE {0}.c END)"

OP3 = rf"""
WITH tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: CASE WHEN x % 2 = 1 THEN xor(3988292384, x // 2) ELSE x // 2 END)) AS t),
crc AS (
  SELECT doc_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda x, y: xor(t[CAST(xor(x, y) & 255 AS INTEGER) + 1], x >> 8)), 4294967295) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), tab),
d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(crc % 7 = 2, false) AS held, {_SPACE_WORDS.format(_LOWER.format('text'))} AS ws
  FROM documents LEFT JOIN crc USING (doc_id)),
tok AS (SELECT r, held, unnest(list_prepend(' start', ws)) AS h, unnest(list_append(ws, ' end')) AS w FROM d),
uni AS (SELECT w, count(*) AS c FROM tok WHERE NOT held GROUP BY w),
bi AS (SELECT h, w, count(*) AS c FROM tok WHERE NOT held GROUP BY h, w),
nu AS (SELECT {_COUNTS_OF_COUNTS}, CAST(coalesce(sum(c), 0) AS BIGINT) AS total, count(*) AS types FROM uni),
nb AS (SELECT {_COUNTS_OF_COUNTS} FROM bi),
du AS (SELECT {_discounts('nu')} AS d, total, types FROM nu),
db AS (SELECT {_discounts('nb')} AS d FROM nb),
p1 AS (SELECT w, c, {_KEPT.format('uni', 'd')} / (total + 1) AS p FROM uni, du),
unk AS (SELECT 1 - coalesce(sum(p), 0) AS p FROM p1),
ctx AS (
  SELECT h, sum(bi.c) AS c, (1 - sum({_KEPT.format('bi', 'd')}) / (sum(bi.c) + 1)) / (1 - sum(p1.p)) AS alpha
  FROM bi JOIN p1 USING (w), db GROUP BY h),
s AS (
  SELECT r, count(*) AS n_tokens, count(p1.c) AS n_known,
    sum(log10((coalesce(p1.c, 0) + 1) / (total + types + 1))) AS base,
    sum(log10(CASE WHEN bi.c IS NOT NULL THEN {_KEPT.format('bi', 'db.d')} / (ctx.c + 1) ELSE coalesce(alpha, 1) * coalesce(p1.p, unk.p) END)) AS score
  FROM tok LEFT JOIN p1 USING (w) LEFT JOIN ctx USING (h) LEFT JOIN bi ON bi.h = tok.h AND bi.w = tok.w, du, db, unk GROUP BY r)
SELECT doc_id, held AS held_out, n_tokens, n_known, total AS train_tokens, round(base, 6) AS base_score, round(score, 6) AS score
FROM d JOIN s USING (r), du
"""

OP12 = """
WITH b AS (SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT row, doc_id, p, substr(h, 2 * p + 1, 100) AS g
  FROM (SELECT row, doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS p FROM b WHERE len(h) >= 100)),
m AS (SELECT g, min(doc_id) AS first FROM w GROUP BY g),
hit AS (SELECT row, p, lag(p) OVER (PARTITION BY row ORDER BY p) AS before FROM w JOIN m USING (g) WHERE first < doc_id),
isl AS (SELECT row, p, sum(CASE WHEN p <= before + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY row ORDER BY p) AS k FROM hit),
sp AS (SELECT row, k, min(p) AS a, max(p) + 50 AS z FROM isl GROUP BY ALL),
pre AS (SELECT *, coalesce(lag(z) OVER (PARTITION BY row ORDER BY k), 0) AS y FROM sp),
kept AS (
  SELECT row, sum(z - a) AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * y + 1, 2 * (a - y)), '' ORDER BY k) || substr(any_value(h), 2 * max(z) + 1) AS h
  FROM pre JOIN b USING (row) GROUP BY row)
SELECT doc_id, len(b.h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept.h, b.h))) AS kept_sha256
FROM b LEFT JOIN kept USING (row)
"""

OP13 = r"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: CASE WHEN x % 2 = 1 THEN xor(3988292384, x // 2) ELSE x // 2 END)) AS t),
conv AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS k FROM (SELECT DISTINCT conv_id FROM conversations)),
own AS (
  SELECT k, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(c.conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations c JOIN conv ON c.conv_id IS NOT DISTINCT FROM conv.conv_id),
crc AS (
  SELECT name, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(name, ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda x, y: xor(t[CAST(xor(x, y) & 255 AS INTEGER) + 1], x >> 8)), 4294967295) % 20 AS kind
  FROM (SELECT DISTINCT name FROM own), tab),
dam AS (
  SELECT k, turn, CASE WHEN kind = 4 THEN 'user' WHEN role = '' THEN ' ' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS time
  FROM own JOIN crc USING (name) WHERE kind <> 0),
pos AS (SELECT k, turn, role, text, role[1] AS ini, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, text) AS i FROM dam),
flt AS (
  SELECT *, lag(ini) OVER (PARTITION BY k ORDER BY i) || ini AS pair,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
         WHEN row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 THEN 'duplicate'
         WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
  FROM pos),
stat AS (
  SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM flt GROUP BY k),
ins AS (FROM (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
  (0, 2, 5, 'I', chr(10) || 'user:'), (1, 2, 5, 'I', chr(10) || 'user:'), (3, 2, 5, 'I', chr(10) || 'user:'), (2, 3, 5, 'I', chr(10) || 'assistant:'),
  (0, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'))
  AS ins(s, t, cost, letters, lines)),
step AS (FROM (VALUES (0, 1, 's'), (0, 2, 'u'), (1, 2, 'u'), (2, 3, 'a'), (3, 2, 'u')) AS step(s, t, ini)),
edit AS (
  SELECT k, i, s, s AS t, 2 AS cost, 'D' AS letter, '' AS line FROM flt, (SELECT unnest(range(4)) AS s)
  UNION ALL
  SELECT k, i, s, t, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, 'K', chr(10) || role || ':' || text
  FROM flt JOIN step USING (ini) WHERE fault IS NULL OR fault = 'truncated'
  UNION ALL
  SELECT k, i, s, t, CASE WHEN fault = 'truncated' THEN 6 ELSE 1 END, 'R', chr(10) || CASE step.ini WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text
  FROM flt, step WHERE step.ini <> 's' AND (fault IS NULL OR fault = 'truncated')),
way AS (
  SELECT k, CAST(0 AS BIGINT) AS i, 0 AS s, {'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': ''} AS w FROM stat
  UNION ALL
  SELECT w.k, e.i, e.t, min({'cost': w.w.cost + ins.cost + e.cost, 'audit': w.w.audit || ins.letters || e.letter, 'lines': w.w.lines || ins.lines || e.line})
  FROM way w JOIN ins ON ins.s = w.s JOIN edit e ON e.k = w.k AND e.i = w.i + 1 AND e.s = ins.t GROUP BY w.k, e.i, e.t),
best AS (
  SELECT w.k, min({'cost': w.w.cost + ins.cost, 'audit': w.w.audit || ins.letters, 'lines': w.w.lines || ins.lines}) AS w
  FROM way w JOIN stat ON stat.k = w.k AND stat.n = w.i JOIN ins ON ins.s = w.s WHERE ins.t IN (0, 3) GROUP BY w.k)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(w.cost, 0) AS BIGINT) AS cost,
       coalesce(w.audit, '') AS audit, sha256(coalesce(substr(w.lines, 2), '')) AS repaired_sha256
FROM conv LEFT JOIN stat USING (k) LEFT JOIN best USING (k)
"""

OP11 = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
t AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM pieces),
grams AS (SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS g, i
          FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM t, (SELECT unnest([1, 2, 3]) AS k) WHERE len(ws) >= k)),
f AS (SELECT lang, k, g, count(*) AS c FROM grams GROUP BY ALL HAVING count(*) >= 10),
tot AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM t GROUP BY lang),
cand AS (SELECT lang, k, g, c AS a, string_split(g, ' ') AS ws FROM f WHERE k > 1),
longer AS (
  SELECT lang, sub, max(a) AS a FROM (SELECT lang, a, unnest([ws[1] || ' ' || ws[2], ws[2] || ' ' || ws[3]]) AS sub FROM cand WHERE k = 3) GROUP BY ALL),
cuts AS (
  SELECT lang, g, a, cut, array_to_string(ws[1 : cut], ' ') AS x, array_to_string(ws[cut + 1 : k], ' ') AS y
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand)),
s AS (
  SELECT cuts.lang, cuts.g, a, cut, fx.c AS l, fy.c AS r, CAST(1000000 AS HUGEINT) * a * a // (CAST(fx.c AS HUGEINT) * fy.c) AS score
  FROM cuts JOIN f fx ON fx.lang = cuts.lang AND fx.g = x JOIN f fy ON fy.lang = cuts.lang AND fy.g = y),
one AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
kept AS (SELECT one.* FROM one LEFT JOIN longer ON longer.lang = one.lang AND sub = one.g WHERE coalesce(100 * longer.a < 50 * one.a, true)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM kept)
SELECT lang, rank, g AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN tot USING (lang) WHERE rank <= 2000
"""

ORACLES = {"op1_decontamination": OP1, "op2_chat_formatting": OP2, "op3_lm_scoring": OP3, "op6_warc": OP6,
           "op10_quality_rules": OP10, "op11_collocations": OP11, "op12_suffix_dedup": OP12,
           "op13_conversation_repair": OP13}
