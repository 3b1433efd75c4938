"""SQL that states the training-data queries plainly, for the comparison on small data.

It compares every pair of texts that share a piece, which the operators never
do; it is only meant for tables of some thousand rows.
"""

from __future__ import annotations

import unicodedata

from palimpsest.llm.lookalike import HOMOGLYPHS, SAME_LOOK, UNSEEN

_OWNERS = "own AS (SELECT DISTINCT expression_id AS x, clause_work_id AS o FROM clause_document_expression)"

P4_FOUND = f"""
WITH {_OWNERS},
u AS (SELECT DISTINCT 'work' AS k, clause_work_id AS r, clause_work_id AS o, exact_text AS t FROM clause_document_expression WHERE exact_text IS NOT NULL
  UNION SELECT DISTINCT 'hunk', h.hunk_id, own.o, h.new_exact_text FROM clause_document_diff_hunk h JOIN own ON own.x = h.newer_expression_id WHERE h.new_exact_text IS NOT NULL),
n AS (SELECT *, row_number() OVER () AS i FROM u),
g AS (SELECT DISTINCT k, i, o, substring(t, CAST(j AS INT), 5) AS g FROM n, LATERAL (SELECT unnest(generate_series(1, greatest(1, length(t) - 4))) AS j)),
c AS (SELECT i, count(*) AS c FROM g GROUP BY 1),
p AS (SELECT a.i AS a, b.i AS b, count(*) AS s FROM g a JOIN g b ON a.k = b.k AND a.g = b.g AND a.i < b.i AND a.o <> b.o GROUP BY 1, 2)
SELECT DISTINCT x.k AS record_kind, least(x.r, y.r) AS record_a, greatest(x.r, y.r) AS record_b
FROM p JOIN c ca ON ca.i = p.a JOIN c cb ON cb.i = p.b JOIN n x ON x.i = p.a JOIN n y ON y.i = p.b
WHERE s >= 0.75 * (ca.c + cb.c - s) AND x.r <> y.r
"""

P4_GROUPS = f"""
WITH RECURSIVE found AS ({P4_FOUND}), l AS (SELECT record_kind AS k, record_a AS a, record_b AS b FROM found UNION SELECT record_kind, record_b, record_a FROM found),
w AS (SELECT k, a AS r, b AS g FROM l UNION SELECT k, a, a FROM l UNION SELECT w.k, w.r, l.b FROM w JOIN l ON l.k = w.k AND l.a = w.g),
c AS (SELECT k, r, min(g) AS g FROM w GROUP BY 1, 2)
SELECT k AS record_kind, r AS record, g AS group_id, count(*) OVER (PARTITION BY k, g) AS records FROM c
"""

P5_FOUND = f"""
WITH {_OWNERS},
u AS (SELECT DISTINCT 'work' AS k, clause_work_id AS r, clause_work_id AS o, exact_text AS t FROM clause_document_expression WHERE length(exact_text) >= 60
  UNION SELECT DISTINCT 'hunk', s.hunk_id, own.o, s.new_text FROM clause_document_inline_diff_segment s JOIN clause_document_diff_hunk h ON s.hunk_id = h.hunk_id
  JOIN own ON own.x = h.newer_expression_id WHERE length(s.new_text) >= 60),
g AS (SELECT DISTINCT k, r, o, md5_number(substring(t, CAST(i AS INT), 60)) AS g FROM u, LATERAL (SELECT unnest(generate_series(1, length(t) - 59)) AS i)),
m AS (SELECT k, g FROM g GROUP BY 1, 2 HAVING count(DISTINCT o) > 1),
f AS (SELECT g.* FROM g SEMI JOIN m ON g.k = m.k AND g.g = m.g)
SELECT DISTINCT a.k AS record_kind, a.r AS record_a, b.r AS record_b FROM f a JOIN f b ON a.k = b.k AND a.g = b.g AND a.r < b.r AND a.o <> b.o
"""

_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_NARROW = "".join(chr(c) for c in range(0x21, 0x7F)).replace("'", "''")

P9_FOUND = f"""
WITH f AS (SELECT 'd' AS k, doc_id AS i, text AS t FROM documents WHERE text IS NOT NULL UNION ALL SELECT 'i', item_id, text FROM heldout_item),
z AS (SELECT k, i, regexp_replace(lower(translate(t, '{_WIDE}', '{_NARROW}')), '[^\\p{{L}}\\p{{Nd}}]', '', 'g') AS t FROM f),
g AS (SELECT DISTINCT k, i, substring(t, CAST(j AS INT), 30) AS g FROM z, LATERAL (SELECT unnest(generate_series(1, length(t) - 29)) AS j))
SELECT DISTINCT d.i AS doc_id, q.i AS item_id FROM g d JOIN g q ON d.g = q.g AND d.k = 'd' AND q.k = 'i'
"""


P5_SHARES = f"""
WITH {_OWNERS},
u AS (SELECT DISTINCT 'work' AS k, clause_work_id AS r, clause_work_id AS o, exact_text AS t FROM clause_document_expression WHERE length(exact_text) >= 60
  UNION SELECT DISTINCT 'hunk', s.hunk_id, own.o, s.new_text FROM clause_document_inline_diff_segment s JOIN clause_document_diff_hunk h ON s.hunk_id = h.hunk_id
  JOIN own ON own.x = h.newer_expression_id WHERE length(s.new_text) >= 60),
x AS (SELECT k, t, row_number() OVER () AS n FROM (SELECT DISTINCT k, t FROM u)),
w AS (SELECT k, n, i, md5_number(substring(t, CAST(i AS INT), 60)) AS g FROM x, LATERAL (SELECT unnest(generate_series(1, length(t) - 59)) AS i)),
m AS (SELECT w.k, w.g FROM w JOIN x USING (n) JOIN u ON u.k = x.k AND u.t = x.t GROUP BY 1, 2 HAVING count(DISTINCT u.o) > 1),
c AS (SELECT n, sum(least(60, coalesce(ahead, 60))) AS c FROM (SELECT n, lead(i) OVER (PARTITION BY n ORDER BY i) - i AS ahead FROM w SEMI JOIN m ON w.k = m.k AND w.g = m.g) GROUP BY 1)
SELECT r.k AS record_kind, r.r AS record, count(*) AS texts, CAST(sum(length(r.t)) AS BIGINT) AS characters, CAST(coalesce(sum(c.c), 0) AS BIGINT) AS shared
FROM (SELECT DISTINCT k, r, t FROM u) r JOIN x ON x.k = r.k AND x.t = r.t LEFT JOIN c USING (n) GROUP BY 1, 2
"""

P9_ITEMS = f"""
WITH f AS (SELECT 'd' AS k, doc_id AS i, text AS t FROM documents WHERE text IS NOT NULL UNION ALL SELECT DISTINCT 'i', item_id, text FROM heldout_item),
n AS (SELECT k, i, row_number() OVER () AS n, regexp_extract_all(t, '(?s).') AS cs FROM f),
c AS (SELECT k, i, n, generate_subscripts(cs, 1) AS pos, lower(translate(unnest(cs), '{_WIDE}', '{_NARROW}')) AS c FROM n),
l AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY pos) AS j FROM c WHERE regexp_matches(c, '^[\\p{{L}}\\p{{Nd}}]')),
z AS (SELECT k, i, n, string_agg(c, '' ORDER BY j) AS t FROM l GROUP BY 1, 2, 3),
g AS (SELECT k, i, n, j, substring(t, CAST(j AS INT), 30) AS g FROM z, LATERAL (SELECT unnest(generate_series(1, length(t) - 29)) AS j)),
h AS (SELECT DISTINCT d.i AS doc, d.n, q.i AS item, d.j FROM g d JOIN g q ON d.g = q.g AND d.k = 'd' AND q.k = 'i'),
s AS (SELECT *, sum(CASE WHEN j <= before + 30 THEN 0 ELSE 1 END) OVER (PARTITION BY n, item ORDER BY j) AS run FROM (SELECT *, lag(j) OVER (PARTITION BY n, item ORDER BY j) AS before FROM h)),
r AS (SELECT doc, n, item, run, min(j) AS a, max(j) + 29 AS b FROM s GROUP BY 1, 2, 3, 4),
o AS (SELECT r.doc, r.n, r.item, sum(y.pos - x.pos + 1) AS covered FROM r JOIN l x ON x.n = r.n AND x.j = r.a JOIN l y ON y.n = r.n AND y.j = r.b GROUP BY 1, 2, 3)
SELECT item AS item_id, count(DISTINCT doc) AS documents, CAST(max(covered) AS INT) AS most_covered FROM o GROUP BY 1
"""


def _look(char: str) -> str:
    """What a character looks like, by its Unicode properties; itself if nothing else."""
    if unicodedata.category(char) == "Cf" or any(a <= ord(char) <= b for a, b in UNSEEN):
        return ""
    if unicodedata.category(char) == "Zs":
        return " "
    kind = unicodedata.decomposition(char).partition(" ")[0]
    if kind.startswith("<") and kind in SAME_LOOK and not "\u3131" <= char <= "\u318e":
        parts = unicodedata.decomposition(char).split()[1:]
        return "".join(_look(chr(int(p, 16))) for p in parts)
    return HOMOGLYPHS.get(char, char)


def _looks() -> str:
    """The characters that look like others, as rows of SQL."""
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    chars = [chr(p) for p in [*range(1, 0xD800), *range(0xE000, 0x20000)] if unicodedata.category(chr(p)) not in ("Cn", "Co")]
    return ", ".join(f"({quoted(c)}, {quoted(look)})" for c in chars if (look := _look(c)) != c)


P3_FOUND = f"""
WITH m(c, r) AS (VALUES {_looks()}),
t AS (SELECT raw_text AS t FROM current_clause_block UNION SELECT exact_text FROM clause_document_expression UNION SELECT old_exact_text FROM clause_document_diff_hunk),
x AS (SELECT t, row_number() OVER () AS n, regexp_extract_all(t, '(?s).') AS cs FROM t WHERE t IS NOT NULL),
c AS (SELECT n, unnest(cs) AS c, generate_subscripts(cs, 1) AS k FROM x),
j AS (SELECT n, nfc_normalize(string_agg(coalesce(m.r, c.c), '' ORDER BY k)) AS f FROM c LEFT JOIN m USING (c) GROUP BY 1),
f AS (SELECT t, coalesce(f, '') AS f FROM x LEFT JOIN j USING (n)),
b AS (SELECT DISTINCT source_block_id AS i, raw_text AS t, f FROM current_clause_block JOIN f ON f.t = raw_text),
e AS (SELECT DISTINCT expression_id AS i, clause_work_id AS w, source_edition_version_id AS v, exact_text AS t, f FROM clause_document_expression JOIN f ON f.t = exact_text),
ed AS (SELECT edition_import_run_id AS r, source_edition_version_id AS v, min(chronology_order) AS o FROM source_edition GROUP BY 1, 2),
p AS (SELECT * FROM (SELECT v, lag(v) OVER (PARTITION BY r ORDER BY o, v) AS p FROM ed) WHERE p IS NOT NULL),
h AS (SELECT DISTINCT hunk_id AS i, older_expression_id AS o, old_exact_text AS t, f FROM clause_document_diff_hunk JOIN f ON f.t = old_exact_text)
SELECT a.i AS record_a, b.i AS record_b FROM b a JOIN b ON a.f = b.f AND a.t <> b.t AND a.i < b.i
UNION SELECT least(n.i, o.i), greatest(n.i, o.i) FROM e n JOIN p ON p.v = n.v JOIN e o ON o.v = p.p AND o.w = n.w AND o.f = n.f AND o.t <> n.t AND o.i <> n.i
UNION SELECT least(h.i, e.i), greatest(h.i, e.i) FROM h JOIN e ON e.i = h.o WHERE NOT contains(e.t, h.t) AND h.f <> '' AND contains(e.f, h.f)
"""

# The rules of endings, written for this SQL alone.
_ENDINGS = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS source, length(text) AS chars, strlen(text) AS bytes, text, rtrim(text, {blank}) AS bare FROM documents WHERE text IS NOT NULL),
s AS (SELECT *, regexp_replace(bare, '(?:</?[A-Za-z][A-Za-z0-9]*(?:\s[^<>]*)?/?>|</?(?:[A-Za-z][A-Za-z0-9]*(?:\s+[A-Za-z-]*|\s[^<>]*=[^<>]*)?)?$|&#?[A-Za-z0-9]{{0,8}};?|[…⋯]|\.{{3,}}|[（(\[【<]|[\x{{FFFD}}\p{{So}}\p{{Cf}}]|[\s\x{{3000}}])+$', '') AS stop FROM d WHERE bare <> ''),
l AS (SELECT *, trim(string_split(stop, chr(10))[-1], {blank}) AS line FROM s),
h AS (SELECT *, CASE
    WHEN stop = '' OR regexp_matches(stop, '(?:[。！？!?｡．]|\pL[）)\]”’"'']*\.|[%°]\.)[」』”’"''）)】》\]]*$') THEN 'finished'
    WHEN regexp_matches(line, '(?:^|[。！？!?｡．][」』”’"''）)】》\]]*\s*|\pL[）)\]”’"'']*\.[」』”’"''）)】》\]]*\s*|[%°]\.\s*)[－—–\-=*【\[（(〔]\s*\pL[\pL ]*[－—–\-=*】\]）)〕]$') THEN 'finished'
    WHEN regexp_matches(line, '^((中華民國|民國)?\s*\d{{2,4}}\s*年\s*\d{{1,2}}\s*月\s*\d{{1,2}}\s*日|\d{{2,4}}[/\-]\d{{1,2}}[/\-]\d{{1,2}}|\d{{1,2}} {month} \d{{4}}|{month} \d{{1,2}}, \d{{4}})([ T]\d{{1,2}}:\d{{2}}(:\d{{2}})?)?$') THEN 'finished'
    WHEN regexp_matches(line, '[|;{{}}]$|^\S*://\S*$') THEN 'other'
    WHEN regexp_matches(line, '[。！？!?｡]|\pL\.\s') OR length(regexp_replace(line, '[^，；、,;]', '', 'g')) > 1 THEN 'sentence'
    WHEN regexp_matches(line, '[，；、,;]') THEN 'clause'
    WHEN regexp_matches(line, '^[^\s:：]+( [^\s:：]+){{0,2}}\s?[:：]\s*[\pL\pN]') THEN 'label'
    WHEN regexp_matches(line, '^(\d{{1,3}}(\.\s|[)、])|[（(]?[一二三四五六七八九十]{{1,3}}[）)、]|[-*•●]\s)') THEN 'entry'
    WHEN NOT contains(ltrim(stop, {blank}), chr(10)) THEN 'title' ELSE 'line' END AS shape,
  left(regexp_replace(left(line, 24), '\d+', '0', 'g'), 3) AS opener FROM l),
o AS (SELECT left(regexp_replace(left(x, 24), '\d+', '0', 'g'), 3) AS opener, regexp_matches(x, '(?:[。！？!?｡．]|\pL[）)\]”’"'']*\.|[%°]\.)[」』”’"''）)】》\]]*$') AS f
  FROM (SELECT trim(unnest(string_split(text, chr(10))), {blank}) AS x FROM d WHERE bare <> '') WHERE x <> ''),
y AS (SELECT prefix, sum(n) AS n, sum(f) AS f FROM (SELECT unnest(list_distinct([left(opener, 1), left(opener, 2), opener])) AS prefix, n, f FROM (SELECT opener, count(*) AS n, count(*) FILTER (WHERE f) AS f FROM o GROUP BY 1)) GROUP BY 1 HAVING sum(n) > 10),
q AS (SELECT h.doc_id, h.source, chars, bytes, shape, coalesce(y3.f / (y3.n - 1), y2.f / (y2.n - 1), y1.f / (y1.n - 1)) AS share
  FROM h LEFT JOIN y y1 ON y1.prefix = left(opener, 1) LEFT JOIN y y2 ON y2.prefix = left(opener, 2) LEFT JOIN y y3 ON y3.prefix = opener),
e AS (SELECT doc_id, source, chars, bytes, shape = 'entry' OR coalesce(shape = 'title' AND chars < (SELECT quantile_cont(chars, 0.01) FROM h WHERE shape = 'finished'), false) AS alike,
  CASE WHEN shape = 'finished' THEN 'finished' WHEN shape = 'sentence' THEN 'broken' WHEN shape = 'label' AND share <= 0.1 THEN 'finished'
  WHEN shape IN ('clause', 'label', 'entry', 'line') AND share >= 0.9 THEN 'broken' ELSE 'open' END AS ending FROM q),
c AS (SELECT source, unit, length, count(*) AS n FROM (
  SELECT source, 'chars' AS unit, chars AS length FROM e WHERE ending = 'finished' OR NOT alike UNION ALL SELECT source, 'bytes', bytes FROM e WHERE ending = 'finished' OR NOT alike) GROUP BY 1, 2, 3),
k AS (SELECT *, sum(n) OVER (PARTITION BY source, unit ORDER BY length DESC) AS risk FROM c),
x AS (SELECT *, coalesce(sum(n) OVER far - sum(n) OVER near, 0) + 0.5 AS stopped, coalesce(sum(risk) OVER far - sum(risk) OVER near, 0) AS passed FROM k
  WINDOW far AS (PARTITION BY source, unit ORDER BY length RANGE BETWEEN 20 PRECEDING AND 20 FOLLOWING), near AS (PARTITION BY source, unit ORDER BY length RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
z AS (SELECT *, CASE WHEN passed > 0 THEN stopped / passed * risk ELSE stopped END AS ex FROM x),
b AS (SELECT *, greatest(ceil(CASE WHEN n <= ex THEN 0 ELSE least(n - ex + n * ln(ex / n), 0) END * 20), -20000) AS bin FROM z),
r AS (SELECT bin, sum(count(*)) OVER (ORDER BY bin) AS rank, sum(count(*)) OVER () AS total FROM b GROUP BY 1),
g AS (SELECT source, unit, length, n FROM b WHERE bin <= (SELECT max(bin) FROM r WHERE bin / 20 <= ln(0.01 * rank / total))),
f AS (SELECT *, EXISTS (SELECT 1 FROM g WHERE g.source = e.source AND ((unit = 'chars' AND length = chars) OR (unit = 'bytes' AND length = bytes))) AS at_limit FROM e)
""".format(
    blank="chr(32) || chr(9) || chr(13) || chr(10) || chr(11) || chr(12) || chr(133) || chr(160) || chr(173) || chr(5760) || '"
    + "".join(map(chr, [*range(0x2000, 0x2010), 0x2028, 0x2029, *range(0x202A, 0x2030), 0x205F, 0x2060, 0x3000, 0xFEFF]))
    + "'",
    month="(January|February|March|April|May|June|July|August|September|October|November|December)",
)

P10_FOUND = _ENDINGS + "SELECT DISTINCT doc_id FROM f WHERE ending = 'broken' OR (ending = 'open' AND at_limit)"

P10_SOURCES = _ENDINGS + """, m AS (SELECT source, string_agg(unit || ':' || length || ':' || n, ',' ORDER BY unit, length) AS limits FROM g GROUP BY 1)
SELECT source, count(*) AS documents, count(*) FILTER (WHERE ending <> 'finished' AND at_limit) AS cut_by_limit, count(*) FILTER (WHERE ending = 'broken' AND NOT at_limit) AS cut_in_transfer,
  count(*) FILTER (WHERE ending = 'broken' OR (ending = 'open' AND at_limit)) / count(*) AS share, any_value(m.limits) AS limits FROM f LEFT JOIN m USING (source) GROUP BY 1"""

SQL = {"p3_found": P3_FOUND, "p5_shares": P5_SHARES, "p9_items": P9_ITEMS, "p4_found": P4_FOUND, "p4_groups": P4_GROUPS, "p5_found": P5_FOUND, "p9_found": P9_FOUND, "p10_found": P10_FOUND, "p10_sources": P10_SOURCES}
