"""DuckDB SQL for the corpus operators' queries, written from their contracts."""

# words of a text, as a list
_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = rf"""
WITH d AS (SELECT doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, list_slice(w, i, i + 7) AS g FROM d, unnest(generate_series(1, len(w) - 7)) AS u(i) WHERE len(w) >= 8),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM rep, unnest(generate_series(0, 7)) AS u(j) GROUP BY doc_id),
lines AS (SELECT * FROM (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM lines GROUP BY doc_id),
norm AS (SELECT doc_id, host, text, list_filter(regexp_split_to_array(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS lw FROM lines),
common AS (SELECT host, lw, min(doc_id) AS holder FROM norm GROUP BY host, lw HAVING count(DISTINCT text) > 50),
firsts AS (SELECT host, text, min(doc_id) AS rep FROM d GROUP BY host, text),
lost AS (SELECT host, text, sum(n) AS n FROM (SELECT n.host, n.text, len(n.lw) AS n FROM norm n JOIN firsts f ON n.host = f.host AND n.text = f.text AND n.doc_id = f.rep
         JOIN common c ON c.host = n.host AND c.lw = n.lw WHERE c.holder <> n.doc_id) GROUP BY host, text),
m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_common_words
      FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN lost ON lost.host = d.host AND lost.text = d.text)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_words - n_common_words >= 0.3 * n_words AS kept, n_common_words FROM m
"""

OP5 = rf"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, list_filter(regexp_split_to_array({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, list_slice(w, i, i + least(len(w), 13) - 1) AS g FROM b, unnest(generate_series(1, len(w) - least(len(w), 13) + 1)) AS u(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS g FROM d, sizes, unnest(generate_series(1, len(w) - n + 1)) AS u(i) WHERE len(w) >= n),
hit AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM hit, unnest(generate_series(0, n - 1)) AS u(j) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP7 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, list_slice(w, i, i + 12) AS g FROM d, unnest(generate_series(1, len(w) - 12)) AS u(i) WHERE len(w) >= 13),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS lo FROM win) WHERE lo < doc_id),
gone AS (SELECT doc_id, list(DISTINCT i + j) AS g FROM later, unnest(generate_series(0, 12)) AS u(j) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(g), 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN g IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(list_transform(list_filter(generate_series(1, len(w)), lambda x: NOT list_contains(g, x)), lambda x: w[x]), ' ') END) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""

OP8 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(w, i, i + 4) AS g FROM d, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.y FROM r JOIN e ON e.x = r.b),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM d LEFT JOIN n USING (doc_id) JOIN c ON c.a = d.doc_id
"""

OP10 = r"""
WITH m AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
raw AS (SELECT conv_id, turn, role, text, unnest(regexp_split_to_array(text, '\r?\n')) AS l, unnest(generate_series(1, len(regexp_split_to_array(text, '\r?\n')))) AS k FROM m),
lev AS (SELECT *, length(regexp_replace(regexp_extract(l, '^[ \t]*(>[ \t]?)+', 0), '[^>]', '', 'g')) AS level FROM raw),
fixed AS (SELECT * EXCLUDE (level), CASE WHEN level = 0 AND regexp_matches(l, '(?i)^\s*(on .+ wrote|.+ writes|.+ a écrit|.+ schrieb):\s*$')
            AND coalesce(lead(level) OVER (PARTITION BY conv_id, turn, role, text ORDER BY k), 0) > 0 THEN -1 ELSE level END AS level,
            lower(trim(regexp_replace(regexp_replace(l, '^[ \t]*(>[ \t]?)+', ''), '\s+', ' ', 'g'), ' ')) AS norm FROM lev),
own AS (SELECT conv_id, norm, min(turn) AS origin FROM fixed WHERE level = 0 AND norm <> '' GROUP BY 1, 2),
linked AS (SELECT f.conv_id, f.turn, f.level, o.origin, count(*) AS lines, sum(length(f.norm)) AS chars FROM fixed f JOIN own o USING (conv_id, norm)
           WHERE f.level > 0 AND f.norm <> '' AND o.origin < f.turn GROUP BY 1, 2, 3, 4),
parent AS (SELECT conv_id, turn, max((chars, origin))[2] AS reply_to FROM linked WHERE level = 1 GROUP BY 1, 2),
body AS (SELECT conv_id, turn, role, text, regexp_replace(regexp_replace(coalesce(string_agg(l, chr(10) ORDER BY k) FILTER (level = 0), ''), '^(\s*\n)+', ''), '\s+$', '') AS body,
         count(*) FILTER (level > 0) AS n_quoted_lines FROM fixed GROUP BY 1, 2, 3, 4),
up AS (SELECT b.conv_id, b.turn, b.role, b.body, b.n_quoted_lines, p.reply_to FROM body b LEFT JOIN parent p USING (conv_id, turn))
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY coalesce(reply_to, turn), turn, role, body) - 1 AS position, turn, role, body AS text,
       reply_to, coalesce(reply_to, turn) AS thread, CAST(n_quoted_lines AS BIGINT) AS n_quoted_lines,
       CAST(coalesce((SELECT sum(lines) FROM linked l WHERE l.conv_id = up.conv_id AND l.turn = up.turn), 0) AS BIGINT) AS n_linked_lines FROM up
"""

_D2 = "CAST(list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"


def _round(i: int) -> str:
    """Vectors assigned to the centroids c<i>, and the centroids c<i+1> that follow."""
    return f"""
a{i} AS (SELECT rid, any_value(vec_id) AS vec_id, any_value(vq) AS q, min((d, k)) AS best FROM (SELECT rid, vec_id, v.q AS vq, {_D2} AS d, c.k FROM v, c{i} c) GROUP BY rid),
s{i} AS (SELECT k, p, sum(x) AS s, count(*) AS n FROM (SELECT best[2] AS k, unnest(q) AS x, unnest(generate_series(1, 64)) AS p FROM a{i}) GROUP BY k, p),
m{i} AS (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY p) AS q FROM s{i} GROUP BY k),
c{i + 1} AS (SELECT c.k, coalesce(m.q, c.q) AS q FROM c{i} c LEFT JOIN m{i} m ON m.k = c.k)"""


OP12 = f"""
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT)) AS q
           FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (SELECT row_number() OVER (ORDER BY name, q) - 1 AS k, q FROM (SELECT sha256('1:' || vec_id) AS name, q FROM v WHERE vec_id IS NOT NULL ORDER BY name, q LIMIT 16)),
{",".join(_round(i) for i in range(4))}
SELECT vec_id, CAST(best[2] AS INTEGER) AS cluster, best[1] AS distance, CAST(sum(best[1]) OVER (PARTITION BY best[2]) AS BIGINT) AS cluster_inertia,
       CAST(sum(best[1]) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a3 JOIN c3 c ON c.k = best[2]
"""

_CRC = "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(nm, ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"


def _edit(s: str, price: str, letter: str, row: str) -> str:
    return f"CASE WHEN {s} IS NOT NULL THEN {{'c': {s}.c + {price}, 'a': {s}.a || '{letter}', 'r': {s}.r || {row}}} END"


def _nl(text: str) -> str:
    return f"chr(10) || '{text}'"


def _least(*options: str) -> str:
    return f"list_sort(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))[1]"


_NEXT = "(SELECT dp.cid, f.rn, f.role, f.text, f.fault, s0, s1, s2, s3 FROM dp JOIN flags f ON f.cid = dp.cid AND f.rn = dp.rn + 1)"
# one insertion after every state of the rows before (two never pay)
_INSERTED = (f"SELECT * EXCLUDE (s2, s3), {_least('s2', *[_edit(s, '5', 'I', _nl('user:')) for s in ('s0', 's1', 's3')])} AS s2, "
             f"{_least('s3', _edit('s2', '5', 'I', _nl('assistant:')))} AS s3 FROM {_NEXT}")
_ROW = "chr(10) || role || ':' || text"
_KEEP = "CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END"


def _stay(s: str, role: str) -> str:
    """Keep or rerole of the row after state ``s``."""
    keep, turn = _edit(s, _KEEP, "K", _ROW), _edit(s, f"1 + {_KEEP}", "R", f"chr(10) || '{role}:' || text")
    return f"CASE WHEN fault NOT IN ('blank', 'duplicate') THEN (CASE WHEN left(role, 1) = '{role[0]}' THEN {keep} ELSE {turn} END) END"


_SYSTEM = f"CASE WHEN fault NOT IN ('blank', 'duplicate') AND left(role, 1) = 's' THEN {_edit('s0', _KEEP, 'K', _ROW)} END"
_DELETE = [_edit(f"s{i}", "2", "D", "''") for i in range(4)]

OP13 = f"""
WITH RECURSIVE base AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS nm FROM conversations),
kinds AS (SELECT nm, {_CRC} % 20 AS kind FROM (SELECT DISTINCT nm FROM base)),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(generate_series(1, CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM base JOIN kinds USING (nm) WHERE kind <> 0),
body AS (SELECT *, coalesce(conv_id, -9223372036854775808) AS cid, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last_char FROM damaged),
seq AS (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, sha256(text)) AS rn FROM body),
flags AS (SELECT *, CASE WHEN last_char = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY cid, role, text ORDER BY rn) > 1 THEN 'duplicate' WHEN last_char NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
          lag(left(role, 1)) OVER (PARTITION BY cid ORDER BY rn) || left(role, 1) AS pair FROM seq),
stats AS (SELECT cid, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
          count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(rn) AS n FROM flags GROUP BY cid),
dp AS (
  SELECT cid, CAST(0 AS BIGINT) AS rn, {{'c': CAST(0 AS BIGINT), 'a': '', 'r': ''}} AS s0, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, r VARCHAR)) AS s1, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, r VARCHAR)) AS s2, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, r VARCHAR)) AS s3 FROM stats
  UNION ALL
  SELECT cid, rn, {_DELETE[0]} AS s0, {_least(_DELETE[1], _SYSTEM)} AS s1, {_least(_DELETE[2], _stay('s0', 'user'), _stay('s1', 'user'), _stay('s3', 'user'))} AS s2, {_least(_DELETE[3], _stay('s2', 'assistant'))} AS s3
  FROM ({_INSERTED})
),
done AS (SELECT cid, {_least('s0', 's3', _edit('s2', '5', 'I', _nl('assistant:')))} AS best FROM dp JOIN stats USING (cid) WHERE dp.rn = stats.n)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.r, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id, -9223372036854775808) AS cid FROM conversations) LEFT JOIN stats USING (cid) LEFT JOIN done USING (cid)
"""

ORACLE = {"op13_audit_repair": OP13, "op12_pca_centroids": OP12, "op2_line_quality": OP2, "op5_winnow": OP5, "op7_recompress": OP7, "op8_superminhash": OP8, "op10_quote_links": OP10}
