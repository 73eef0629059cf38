"""DuckDB SQL of the pipeline queries that SQL can express."""

from __future__ import annotations

#: Fixed values shared by the statements.
_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
_LOWER = "'abcdefghijklmnopqrstuvwxyz'"
_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP3 = """
WITH p AS (
  SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes
  FROM pages),
f AS (SELECT payload_digest, max(page_id) AS first FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest
"""

OP5 = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {_SPACE}), {_UPPER}, {_LOWER}) AS key FROM l),
hot AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.doc_id, k.line, k.pos, coalesce(hot.keeper <> k.doc_id, FALSE) AS dropped FROM k LEFT JOIN hot ON k.key = hot.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

_HIT_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

OP6 = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), {_HIT_WORD}) AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), {_HIT_WORD}) AS ws FROM benchmark),
bw AS (SELECT item, least(10, len(ws)) AS k, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0),
win AS (SELECT DISTINCT item, k, array_to_string(ws[i:i + k - 1], ' ') AS win FROM bw),
sizes AS (SELECT DISTINCT k FROM win),
dw AS (SELECT doc_id, k, ws, unnest(range(1, len(ws) - k + 2)) AS i FROM w, sizes WHERE len(ws) >= k),
occ AS (SELECT doc_id, dw.k, i, item FROM dw JOIN win ON dw.k = win.k AND array_to_string(ws[i:i + dw.k - 1], ' ') = win.win),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP1 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (
  SELECT a, b FROM i JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * k >= 80 * (na.n + nb.n - k)),
r AS (SELECT doc_id AS d, doc_id AS c FROM n UNION SELECT e.b, r.c FROM r JOIN e ON r.d = e.a AND r.c < e.b),
m AS (SELECT d, min(c) AS c FROM r GROUP BY d)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.c, w.doc_id) AS component_id
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN m ON w.doc_id = m.d
"""

OP8 = f"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS win
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
d AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS k FROM g) WHERE k > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM d) GROUP BY doc_id),
st AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, ws, unnest(range(1, len(ws))) AS i FROM w WHERE len(ws) >= 2) WHERE ws[i] = ws[i + 1] GROUP BY doc_id),
b AS (
  SELECT w.doc_id, t, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
         len(lines) AS n_lines, coalesce(st.n, 0) AS n_stutter
  FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id LEFT JOIN st ON w.doc_id = st.doc_id),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR NOT word_chars BETWEEN 2 * n_words AND 20 * n_words OR 10 * n_symbols > n_words
    OR (n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines) OR 5 * n_stutter > n_words
    OR 2 * (length(t) - length(regexp_replace(t, '\\p{{Lu}}+', '', 'g'))) > length(t) - length(regexp_replace(t, '\\p{{L}}+', '', 'g'))
    OR 2 * len(list_filter(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+'), lambda x: NOT regexp_matches(x, '\\p{{L}}'))) > n_words
    OR 10 * len(regexp_extract_all(t, '(?:\\.\\.\\.|…)[ \\t\\r]*(?:\\n|$)')) > 3 * n_lines) AS kept
FROM f
"""

#: CRC-32 of an ASCII string, unsigned.
_CRC = """xor(list_reduce([ascii(c) for c in string_split({0}, '')],
  lambda a, b: list_reduce([x for x in range(8)], lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, xor(a, b)),
  4294967295), 4294967295)"""


def _level(name: str, below: str) -> str:
    """Nodes (g, i, n, d) of the next level, and each node's siblings in its run (a tree of one node stays as it is)."""
    return f"""
{name}_r AS (SELECT g, i // 16 AS run, n, list(d ORDER BY i) AS ds FROM {below} WHERE n > 1 GROUP BY g, i // 16, n),
{name}_s AS (SELECT g, run * 16 + p - 1 AS i, array_to_string(ds[:p - 1], '') AS l, array_to_string(ds[p + 1:], '') AS r
  FROM (SELECT *, unnest(range(1, len(ds) + 1)) AS p FROM {name}_r)),
{name} AS (SELECT g, run AS i, CAST(ceil(n / 16) AS BIGINT) AS n, sha256(array_to_string(ds, '')) AS d FROM {name}_r
  UNION ALL SELECT g, i, n, d FROM {below} WHERE n = 1)"""


def _merkle(levels: int = 5, tops: int = 4) -> str:
    """16 ** levels documents a source, 16 ** tops sources at most."""
    field = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"
    leaf = "sha256(" + " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {0})"
    text, low = field.format("text"), field.format(f"translate(text, {_UPPER}, {_LOWER})")
    parts = [f"""docs AS (SELECT row_number() OVER () AS row, doc_id, source, {leaf.format(text)} AS leaf,
  CASE WHEN doc_id IS NOT NULL AND {_CRC.format("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN {leaf.format(low)} ELSE {leaf.format(text)} END AS bent FROM documents)""",
        """o AS (SELECT row, doc_id, leaf, bent, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM docs)""",
        "t0 AS (SELECT g, i, n, leaf AS d FROM o)"]
    parts += [_level(f"t{k}", f"t{k - 1}") for k in range(1, levels + 1)]
    parts.append(f"sub AS (SELECT g, d FROM t{levels})")
    parts.append("u0 AS (SELECT 0 AS g, g AS i, count(*) OVER () AS n, d FROM sub)")
    parts += [_level(f"u{k}", f"u{k - 1}") for k in range(1, tops + 1)]
    parts.append(f"top AS (SELECT d FROM u{tops})")
    parts.append("f0 AS (SELECT row, g, i, bent AS f, '' AS p FROM o)")
    step = "coalesce(CASE WHEN s.g IS NULL THEN f.f ELSE sha256(s.l || f.f || s.r) END, f.f) AS f, f.p || coalesce(s.l || s.r, '') AS p"
    for k in range(1, levels + 1):
        parts.append(f"f{k} AS (SELECT f.row, f.g, f.i // 16 AS i, {step} FROM f{k - 1} f LEFT JOIN t{k}_s s ON f.g = s.g AND f.i = s.i)")
    parts.append(f"h0 AS (SELECT row, 0 AS g, g AS i, f, p FROM f{levels})")
    for k in range(1, tops + 1):
        parts.append(f"h{k} AS (SELECT f.row, f.g, f.i // 16 AS i, {step} FROM h{k - 1} f LEFT JOIN u{k}_s s ON f.i = s.i)")
    return f"""WITH {", ".join(parts)}
SELECT doc_id, leaf, sub.d AS subroot, top.d AS root, sha256(p) AS proof_sha256, f AS folded_root, f = top.d AS verified
FROM o JOIN h{tops} h ON o.row = h.row JOIN sub ON o.g = sub.g JOIN top ON TRUE"""


ORACLE: dict[str, str] = {
    "op1_ngram_jaccard_join": OP1,
    "op3_warc": OP3,
    "op5_line_dedup": OP5,
    "op6_decontamination": OP6,
    "op8_quality_rules": OP8,
    "op12_merkle_manifest": _merkle(),
}
