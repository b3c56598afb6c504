"""DuckDB statements that the queries of this subpackage must agree with, over the whole tables."""

from __future__ import annotations

from vitrine.llm import decontaminate, earlier_text, hard_negatives, quality

SPACED = r"'[^\x20\x09-\x0D]+'"
LETTERS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def folded(column: str) -> str:
    return f"translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


OP10 = f"""
WITH d AS (SELECT row_number() OVER () r, doc_id, regexp_extract_all({folded("coalesce(text, '')")}, {LETTERS}) ws FROM documents),
w AS (SELECT item_id, regexp_extract_all({folded("text")}, {LETTERS}) ws FROM benchmark WHERE text IS NOT NULL),
iw AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i+n-1], ' ') g
       FROM (SELECT item_id, ws, least(len(ws), {decontaminate.WINDOW}) n,
                    unnest(range(1, len(ws) - least(len(ws), {decontaminate.WINDOW}) + 2)) i FROM w WHERE len(ws) > 0)),
p AS (SELECT r, i, list(w) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {decontaminate.WINDOW - 1} FOLLOWING) l
      FROM (SELECT r, unnest(ws) w, generate_subscripts(ws, 1) i FROM d)),
h AS (SELECT p.r, p.i, iw.n, iw.item_id
      FROM (SELECT r, i, n, array_to_string(l[1:n], ' ') g FROM p, (SELECT DISTINCT n FROM iw) WHERE len(l) >= n) p
      JOIN iw ON p.n = iw.n AND p.g = iw.g),
c AS (SELECT r, count(DISTINCT k) n_hit FROM (SELECT r, unnest(range(i, i + n)) k FROM h) GROUP BY r),
s AS (SELECT r, count(*) n_items, string_agg(v, ',' ORDER BY v) items
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) v FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
       sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN s USING (r)
"""

OP5 = rf"""
WITH d AS (SELECT row_number() OVER () r, doc_id, source, coalesce(text, '') body,
                  regexp_extract_all(coalesce(text, ''), {SPACED}) ws FROM documents),
g AS (SELECT r, i, array_to_string(l, ' ') g
      FROM (SELECT r, i, list(w) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {quality.WINDOW - 1} FOLLOWING) l
            FROM (SELECT r, unnest(ws) w, generate_subscripts(ws, 1) i FROM d)) WHERE len(l) = {quality.WINDOW}),
rep AS (SELECT r, count(DISTINCT k) n FROM (SELECT r, unnest(range(i, i + {quality.WINDOW})) k
        FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) m FROM g) WHERE m > 1) GROUP BY r),
lines AS (SELECT r, l, array_to_string(regexp_extract_all({folded("l")}, {SPACED}), ' ') norm,
                 len(regexp_extract_all(l, {SPACED})) n FROM (SELECT r, unnest(string_split(body, chr(10))) l FROM d)
          WHERE regexp_matches(l, {SPACED})),
dups AS (SELECT r, count(*) - count(DISTINCT l) n FROM lines GROUP BY r),
own AS (SELECT DISTINCT source, body, norm FROM lines JOIN d USING (r)),
common AS (SELECT source, norm FROM (SELECT source, norm, count(*) docs FROM own GROUP BY ALL) c
           JOIN (SELECT source s2, count(DISTINCT body) host_docs FROM d GROUP BY 1) h ON c.source IS NOT DISTINCT FROM h.s2
           WHERE docs > {quality.LINE_MIN_DOCS} AND docs > host_docs * {quality.LINE_MAX_SHARE}),
lost AS (SELECT r, sum(n) n FROM lines JOIN d USING (r)
         WHERE EXISTS (SELECT 1 FROM common c WHERE c.norm = lines.norm AND c.source IS NOT DISTINCT FROM d.source) GROUP BY r),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) word_chars,
             CAST(length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS BIGINT) n_symbols, coalesce(dups.n, 0) n_dup_lines,
             coalesce(rep.n, 0) n_repeat_words, CAST(coalesce(lost.n, 0) AS BIGINT) n_boilerplate
      FROM d LEFT JOIN rep USING (r) LEFT JOIN dups USING (r) LEFT JOIN lost USING (r)),
f AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words base_failed FROM m)
SELECT *, NOT base_failed AND n_words - n_boilerplate >= {quality.MIN_WORDS}
          AND n_words - n_boilerplate >= n_words * {quality.MIN_LEFT_SHARE} kept FROM f
"""

OP9 = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () r, doc_id, regexp_extract_all({folded("coalesce(text, '')")}, {SPACED}) ws FROM documents),
g AS (SELECT DISTINCT r, array_to_string(ws[i:i+n-1], ' ') g
      FROM (SELECT r, ws, least(len(ws), 3) n, unnest(range(1, len(ws) - least(len(ws), 3) + 2)) i FROM d WHERE len(ws) > 0)),
s AS (SELECT r, count(*) n FROM g GROUP BY r),
l AS (SELECT p.a, p.b FROM (SELECT x.r a, y.r b, count(*) c FROM g x JOIN g y ON x.g = y.g AND x.r <> y.r GROUP BY ALL) p
      JOIN s t ON t.r = p.a JOIN s u ON u.r = p.b WHERE 100 * c >= 90 * (t.n + u.n - c)),
reach(r, o) AS (SELECT r, r FROM d UNION SELECT reach.r, l.b FROM reach JOIN l ON reach.o = l.a)
SELECT d.doc_id, any_value(coalesce(s.n, 0)) n_shingles, min(e.doc_id) component_id
FROM d LEFT JOIN s USING (r) JOIN reach USING (r) JOIN d e ON e.r = reach.o GROUP BY d.r, d.doc_id
"""

OP3 = """
WITH c AS (SELECT conv_id, list({'turn': turn, 'role': role, 'text': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) ts
           FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL) GROUP BY 1),
k AS (SELECT conv_id, list_transform(ts, lambda t: {'role': t.role, 'text': t.text}) ks, ts FROM c),
h AS (SELECT ks, min(conv_id) conv_id, count(*) n_copies FROM k GROUP BY ks),
p AS (SELECT DISTINCT ks[1:n] ks FROM (SELECT ks, unnest(range(1, len(ks))) n FROM k))
SELECT conv_id, CAST(len(ks) AS BIGINT) n_turns, n_copies,
       array_to_string(list_transform(ks, lambda t: '<|' || coalesce(t.role, 'user') || '|>' || chr(10) || coalesce(t.text, '') || chr(10)
                                                     || '<|end|>' || chr(10)), '') rendered
FROM h ANTI JOIN p USING (ks)
"""

# CRC-32 of the decimal id, byte by byte over a table of 256 steps.
OP11 = """
WITH RECURSIVE steps AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)
                                     ORDER BY i) t FROM (SELECT unnest(range(256)) i)),
r AS (SELECT conv_id, turn, coalesce(role, '') role, coalesce(text, '') txt FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT conv_id, dense_rank() OVER (ORDER BY role, txt) s, strlen(txt) b,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, txt) - 1 pos FROM r),
c AS (SELECT conv_id, conv_id - conv_id % 5 base, count(*) n,
             xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
                             lambda a, d: xor(a // 256, t[xor(a % 256, d) + 1])), 4294967295) % 9 h
      FROM s, steps GROUP BY conv_id, t),
k AS (SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(o.n, 0)) head FROM c LEFT JOIN c o ON o.conv_id = c.base),
q AS (SELECT k.conv_id, s.pos, s.s, s.b FROM k JOIN s ON s.conv_id = k.base AND s.pos < k.h
      UNION ALL SELECT k.conv_id, k.head + s.pos - k.h, s.s, s.b FROM k JOIN s ON s.conv_id = k.conv_id AND s.pos >= k.h),
w AS (SELECT k.conv_id, coalesce(l, []) l, coalesce(bs, []) bs
      FROM k LEFT JOIN (SELECT conv_id, list(s ORDER BY pos) l, list(b ORDER BY pos) bs FROM q GROUP BY 1) USING (conv_id)),
p AS (SELECT conv_id, l[1:d] p, d, CASE WHEN d = 0 THEN 0 ELSE bs[d] END b, len(l) = d is_end FROM (SELECT conv_id, l, bs, unnest(range(len(l) + 1)) d FROM w)),
n AS (SELECT p, d, min(conv_id) conv_id, count(*) n, any_value(b) b, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (is_end) ids
      FROM p GROUP BY p, d),
ch AS (SELECT p[1:d-1] p, d - 1 d, count(*) m FROM n WHERE d > 0 GROUP BY ALL),
f AS (SELECT n.*, coalesce(m, 0) m FROM n LEFT JOIN ch USING (p, d)),
a AS (SELECT p[1:j] p, j d, CAST(sum(CASE WHEN m = 0 THEN 1 ELSE 0 END) AS BIGINT) n_leaves, CAST(sum((n - 1) * b) AS BIGINT) saved
      FROM (SELECT *, unnest(range(d + 1)) j FROM f) GROUP BY ALL)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, u.conv_id parent_conv_id, f.n n_convs, f.m n_children, a.n_leaves, a.saved saved_tokens,
       sha256(coalesce(f.ids, '')) ends_sha256
FROM f JOIN a ON a.p = f.p AND a.d = f.d LEFT JOIN n u ON u.p = f.p[1:f.d-1] AND u.d = f.d - 1
"""

OP12 = f"""
WITH d AS (SELECT row_number() OVER () r, doc_id, regexp_extract_all(coalesce(text, ''), {SPACED}) ws FROM documents),
w AS (SELECT r, unnest(ws) w, generate_subscripts(ws, 1) i FROM d),
g AS (SELECT r, doc_id, i, array_to_string(l, ' ') g
      FROM (SELECT r, i, list(w) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {earlier_text.WINDOW - 1} FOLLOWING) l FROM w)
      JOIN d USING (r) WHERE len(l) = {earlier_text.WINDOW} AND doc_id IS NOT NULL),
m AS (SELECT g, min(doc_id) f FROM g GROUP BY g HAVING min(doc_id) < max(doc_id)),
x AS (SELECT DISTINCT r, unnest(range(i, i + {earlier_text.WINDOW})) i FROM g JOIN m USING (g) WHERE f < doc_id),
k AS (SELECT r, count(x.i) n_removed, string_agg(w, ' ' ORDER BY i) FILTER (x.i IS NULL) t FROM w LEFT JOIN x USING (r, i) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) n_words, coalesce(n_removed, 0) n_removed, sha256(coalesce(t, '')) kept_sha256
FROM d LEFT JOIN k USING (r)
"""

OP13 = f"""
WITH v AS (SELECT row_number() OVER () r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END label,
                  list_transform(embedding, lambda x: floor({hard_negatives.SCALE} * CAST(x AS DOUBLE))) e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r, a.vec_id anchor_id, b.r o, b.vec_id, a.label = b.label same, CAST(list_dot_product(a.e, b.e) AS BIGINT) score
      FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) j FROM s WHERE same) WHERE j <= {hard_negatives.POSITIVES})
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS "rank", negative_id, positive_score, negative_score FROM (
  SELECT p.anchor_id, p.vec_id positive_id, s.vec_id negative_id, p.score positive_score, s.score negative_score,
         row_number() OVER (PARTITION BY p.r, p.j ORDER BY s.score DESC, s.vec_id) k
  FROM p JOIN s ON s.r = p.r AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
WHERE k <= {hard_negatives.NEGATIVES}
"""

ORACLES = {"op3_chat_format": OP3, "op5_quality_rules": OP5, "op9_jaccard_join": OP9, "op10_decontaminate": OP10,
           "op11_prefix_trie": OP11, "op12_substring_dedup": OP12, "op13_hard_negatives": OP13}
