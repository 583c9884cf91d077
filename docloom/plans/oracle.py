"""Plain SQL for the registered queries, written apart from the operators: windows over whole files, nested loops for joins."""

from __future__ import annotations

from docloom.sources.lines import CUSTOMER_SQL, PROSE_SQL, TENDER_SQL

NORM = r"lower(trim(regexp_replace(regexp_replace(text, '[0-9]+', '#', 'g'), '\s+', ' ', 'g')))"
CODE = r"^([0-9]{2}\.[0-9]{2}\.[0-9]{4}|[A-ZÄÖÜ][A-ZÄÖÜ0-9](\.[0-9]{2}){2,4})"
EN = r"(?i)\b(the|and|shall|must|contractor|installation)\b"
DE = r"(?i)\b(und|der|die|das|liefern|montieren|gemäß|Stück)\b"
DOC_LINES = "SELECT source AS file_id, doc_id AS page, (1 - i)::double AS y, l[i] AS text FROM (SELECT source, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents), unnest(range(1, len(l) + 1)) u(i)"


def count(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, '{pattern}'))"


def language(text: str) -> str:
    return f"CASE WHEN {count(text, EN)} > {count(text, DE)} THEN 'en' ELSE 'de' END"


def chrome(lines: str) -> str:
    return f"""SELECT k.file_id, k.key, k.n FROM (SELECT file_id, {NORM} AS key, count(*) AS n FROM {lines} WHERE NOT regexp_matches(trim(text), '{CODE}') GROUP BY ALL) k
  JOIN (SELECT file_id, greatest(3, floor(0.4 * count(DISTINCT page))) AS least FROM {lines} GROUP BY file_id) p USING (file_id) WHERE length(k.key) >= 4 AND k.n >= p.least"""


def content(lines: str, name: str = "content", found: str = "chrome") -> str:
    return f"{found} AS ({chrome(lines)}), {name} AS (SELECT l.* FROM {lines} l WHERE NOT EXISTS (SELECT 1 FROM {found} c WHERE c.file_id = l.file_id AND c.key = {NORM.replace('text', 'l.text')}))"


QUALITY = r"""CASE WHEN length(t) < 15 THEN 'image_only' WHEN a > 2 OR (b + a) / greatest(w, 1) > 0.06 THEN 'corrupted' ELSE 'clean' END"""


def quality(key: str, table: str, text: str) -> str:
    return rf"""WITH q AS (SELECT {key}, length({text}) AS n, trim({text}, E' \t\n\r\x0b\x0c') AS t FROM {table}),
  m AS (SELECT *, len(regexp_extract_all(t, '�|Æ|ﬁ|ﬂ')) AS a, len(regexp_extract_all(t, '[a-z] (on|ng|ed|ce|er|ts)\b')) AS b, len(regexp_split_to_array(t, '\s+')) AS w FROM q)
  SELECT {key}, {QUALITY} AS text_quality, CASE WHEN length(t) < 15 THEN 'image_only' ELSE 'text' END AS method, n AS char_count FROM m"""


LEGEND = r"(?i)^H\s|laufende Nr|definiert die Obergruppe|Obergruppenunter"
SEGMENTS = rf"""tl AS ({TENDER_SQL}), {content("tl")},
t AS (SELECT *, trim(text) AS t FROM content WHERE trim(text) <> ''),
k AS (SELECT *, CASE WHEN regexp_matches(t, '^[0-9]{{2}}\.[0-9]{{2}}\.[0-9]{{4}}\s+') THEN 'position' WHEN regexp_matches(t, '^[0-9]{{2}}\.[0-9]{{2}}\s+') THEN 'group' WHEN regexp_matches(t, '^[0-9]{{2}}\s+.') THEN 'title'
   WHEN regexp_matches(t, '(?i)^(summe|zusammenstellung|übertrag)\b') THEN 'recap' ELSE 'other' END AS cls, regexp_extract(t, '^([0-9.]+)\s+(.*)$', 1) AS code, trim(regexp_extract(t, '^([0-9.]+)\s+(.*)$', 2)) AS rest FROM t),
s AS (SELECT *, sum(CASE WHEN cls IN ('position', 'group', 'recap') THEN 1 ELSE 0 END) OVER w AS seg FROM k WHERE NOT (cls = 'position' AND regexp_matches(rest, '{LEGEND}')) WINDOW w AS (PARTITION BY file_id ORDER BY page, y DESC, line_ord ROWS UNBOUNDED PRECEDING)),
h AS (SELECT *, CASE WHEN seg = 0 THEN NULL ELSE first_value(cls) OVER (PARTITION BY file_id, seg ORDER BY page, y DESC, line_ord) END AS head, row_number() OVER (PARTITION BY file_id ORDER BY page, y DESC, line_ord) AS pos FROM s)"""
LABEL = r"trim(regexp_replace(regexp_replace(arg_max(rest, pos), '[.\s]+$', ''), '\s+', ' ', 'g'))"
TITLES = f"SELECT file_id, code AS key, {LABEL} AS label FROM h WHERE cls = 'title' AND (head IS NULL OR head <> 'position') GROUP BY ALL"
GROUPS = f"SELECT file_id, code AS key, {LABEL} AS label FROM h WHERE cls = 'group' GROUP BY ALL"
QTY = r"(?i)^([0-9.,]+)\s*(St\b|Stk\b|psch\b|pausch\b|m2\b|lfm\b|kg\b|Stck\b|Stück\b|h\b|Pa\b)"
CHUNKS = rf"""b AS (SELECT *, CASE WHEN cls <> 'position' AND regexp_matches(t, '{QTY}') THEN regexp_extract(t, '{QTY}', 1) || ' ' || regexp_extract(t, '{QTY}', 2) END AS amount,
   CASE WHEN cls = 'position' THEN rest WHEN NOT regexp_matches(t, '^[.\s]+$') AND NOT regexp_matches(t, '^OZ\b') AND NOT regexp_matches(t, 'Einheitspreis|Gesamtbetrag') THEN t END AS line FROM h WHERE head = 'position'),
g AS (SELECT file_id, seg, min(page) FILTER (cls = 'position') AS page, min(code) FILTER (cls = 'position') AS oz_code, min(rest) FILTER (cls = 'position') AS title,
   trim(regexp_replace(string_agg(line, chr(10) ORDER BY pos), '\n{{2,}}', chr(10), 'g')) AS text, arg_max(amount, pos) FILTER (amount IS NOT NULL) AS quantity FROM b GROUP BY ALL),
chunks AS (SELECT file_id || ':p' || page || ':' || oz_code AS id, file_id, page, CASE WHEN regexp_matches(text, '(?i)\bentfällt(\b|$)') AND length(text) < 40 THEN 'void' ELSE 'position' END AS kind, oz_code, nullif(title, '') AS title, text, quantity,
   CASE WHEN regexp_matches(text, '(?i)\boder gleichwertig\b') THEN true END AS equivalence, seg FROM g)"""
BASE = f"{SEGMENTS}, titles AS ({TITLES}), groups AS ({GROUPS}), {CHUNKS}"
KEYS = """keyed AS (SELECT c.*, left(oz_code, 2) AS level1_key, coalesce(t.label, 'Section ' || left(oz_code, 2)) AS level1_label, left(oz_code, 5) AS level2_key, coalesce(g.label, 'Group ' || left(oz_code, 5)) AS level2_label
  FROM chunks c LEFT JOIN titles t ON t.file_id = c.file_id AND t.key = left(oz_code, 2) LEFT JOIN groups g ON g.file_id = c.file_id AND g.key = left(oz_code, 5) WHERE kind = 'position')"""
SHOULD = r"(?i)\b(soll|möglichst|should|expected)\b"
OPTIONAL = r"(?i)\b(optional|nice to have|richtwert)\b|\bca\.\b"
MUST = r"(?i)\b(muss|must|required|shall)\b|\b(mindest|zwingend)"


def stub(title: str, t: str, equivalence: str) -> str:
    sentence = rf"regexp_extract({t}, '^(.{{0,140}}?[.!?])(\s|$)', 1)"
    return rf"""regexp_replace(coalesce({title}, CASE WHEN {sentence} <> '' THEN {sentence} ELSE left({t}, 140) END), '^\s+|\s+$', '', 'g') AS bullet_point,
  CASE WHEN regexp_matches({t}, '{OPTIONAL}') AND NOT regexp_matches({t}, '{MUST}') THEN 'optional' WHEN regexp_matches({t}, '{SHOULD}') THEN 'should' ELSE 'must' END AS priority,
  coalesce({equivalence}, CASE WHEN regexp_matches({t}, '(?i)\b(oder gleichwertig|or equivalent)\b') THEN true END) AS equivalence_allowed,
  CASE WHEN {title} <> '' AND length({t}) > 40 THEN 'high' ELSE 'medium' END AS confidence"""


LEAVES = rf"""{BASE}, {KEYS}, e AS (SELECT *, trim(regexp_replace(text, '\s+', ' ', 'g')) AS d FROM keyed),
langs AS (SELECT file_id, CASE WHEN sum({count("text", EN)}) > sum({count("text", DE)}) THEN 'en' ELSE 'de' END AS language FROM tl GROUP BY file_id),
said AS (SELECT e.*, {stub("title", "d", "equivalence")} FROM e),
leaves AS (SELECT row_number() OVER (ORDER BY s.file_id, seg) - 1 AS leaf_ord, s.file_id, s.id, bullet_point || CASE WHEN quantity IS NULL THEN '' ELSE ' (' || quantity || ')' END AS bullet_point, d AS description_source, language, priority, equivalence_allowed, confidence,
  level1_key, level1_label, level2_key, level2_label FROM said s JOIN langs USING (file_id)),
first AS (SELECT level2_key, bullet_point, min(leaf_ord) AS leaf_ord, string_agg(DISTINCT id, ',' ORDER BY id) AS chunk_ids, bool_or(coalesce(equivalence_allowed, false)) AS any_eq, count(DISTINCT id) AS n_chunks FROM leaves GROUP BY ALL),
merged AS (SELECT l.* EXCLUDE (equivalence_allowed), f.chunk_ids, f.n_chunks, CASE WHEN f.any_eq THEN true ELSE l.equivalence_allowed END AS equivalence_allowed FROM first f JOIN leaves l USING (leaf_ord)),
ids AS (SELECT DISTINCT m.leaf_ord, l.id FROM merged m JOIN leaves l ON l.level2_key = m.level2_key AND l.bullet_point = m.bullet_point),
texts AS (SELECT i.leaf_ord, string_agg(c.text, chr(10) ORDER BY o.leaf_ord) AS text FROM ids i JOIN chunks c USING (id) JOIN leaves o ON o.id = i.id GROUP BY ALL)"""
REF = r"Position\s+[\"„“»«]([^\"„“»«]{2,50})[\"„“»«]"
MATCHES = rf"""names AS (SELECT leaf_ord, i - 1 AS nth, lower(trim(n[i])) AS name FROM (SELECT leaf_ord, regexp_extract_all(text, '{REF}', 1) AS n FROM texts), unnest(range(1, len(n) + 1)) u(i)),
matches AS (SELECT n.leaf_ord, n.nth, n.name, min(m.leaf_ord) AS target_ord FROM names n JOIN merged m ON m.leaf_ord <> n.leaf_ord AND contains(lower(m.bullet_point), n.name) WHERE length(n.name) >= 3 GROUP BY ALL)"""
PROSE_LINES = rf"""pt AS (SELECT *, trim(text) AS t FROM pl WHERE trim(text) <> ''),
pf AS (SELECT *, regexp_replace(t, '[^A-Za-zÄÖÜäöüß]', '', 'g') AS letters, len(regexp_split_to_array(t, '\s+')) AS words FROM pt),
ph AS (SELECT *, length(t) BETWEEN 3 AND 60 AND NOT regexp_matches(t, '[.!?]$') AND (regexp_matches(t, ':$') OR (length(letters) >= 3 AND letters = upper(letters) AND words <= 6)
  OR (regexp_matches(t, '(?i)^(installation|testing|maintenance|dismantl\w*|specification|delivery|warranty|scope|requirements?|general|payment|insurance|health|safety|submission)\b') AND words <= 6)) AS heading FROM pf),
pi AS (SELECT *, CASE WHEN NOT heading THEN nullif(trim(CASE WHEN regexp_matches(t, '^[0-9]{{1,2}}[.)]\s+.{{3,}}$') THEN regexp_extract(t, '^[0-9]{{1,2}}[.)]\s+(.{{3,}})$', 1) WHEN regexp_matches(t, '^[•·▪◦*‐-―-]\s+.{{3,}}$') THEN regexp_extract(t, '^[•·▪◦*‐-―-]\s+(.{{3,}})$', 1) END), '') END AS item FROM ph),
prose AS (SELECT *, coalesce(last_value(CASE WHEN heading THEN trim(regexp_replace(t, '[:.]+$', '')) END IGNORE NULLS) OVER w, 'Specification') AS section, count(item) OVER w - 1 AS idx FROM pi WINDOW w AS (PARTITION BY file_id ORDER BY page, y DESC, line_ord ROWS UNBOUNDED PRECEDING))"""
WORDS3 = "list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[a-zäöüß0-9]{3,}'))"
#: Greedy merges, a pair for a step: similar pairs in order, those with a merged side skipped, the verifier asked 60 times at most.
GREEDY = r"""sets AS (SELECT leaf_ord, level1_key, level2_key, list_distinct(regexp_extract_all(lower(bullet_point || ' ' || left(description_source, 200)), '[a-zäöüß0-9]{3,}')) AS w,
  list_distinct(regexp_split_to_array(trim(lower(bullet_point || ' ' || left(description_source, 200))), '\s+')) AS v, min(leaf_ord) OVER (PARTITION BY level1_key, level2_key) AS block FROM merged),
two AS (SELECT a.leaf_ord AS a, b.leaf_ord AS b, row_number() OVER (ORDER BY a.block, a.leaf_ord, b.leaf_ord) AS k, 4 * len(list_intersect(a.v, b.v)) >= 3 * (len(a.v) + len(b.v) - len(list_intersect(a.v, b.v))) AS ok
  FROM sets a JOIN sets b ON a.block = b.block AND a.leaf_ord < b.leaf_ord WHERE len(list_intersect(a.w, b.w)) >= 0.7 * (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))) AND len(a.w) + len(b.w) > 0),
fold AS (SELECT 0::bigint AS k, []::bigint[] AS gone, 0 AS calls, NULL::bigint AS keeper, NULL::bigint AS lost
  UNION ALL SELECT k2, CASE WHEN ask AND ok THEN list_append(gone, b) ELSE gone END, calls + ask::int, CASE WHEN ask AND ok THEN a END, CASE WHEN ask AND ok THEN b END
  FROM (SELECT f.gone, f.calls, two.a, two.b, two.ok, two.k AS k2, f.calls < 60 AND NOT list_contains(f.gone, two.a) AND NOT list_contains(f.gone, two.b) AS ask FROM fold f JOIN two ON two.k = f.k + 1))"""
#: References, a match for a step: what each leaf's ids have become so far is kept in a map.
RESOLVED = """own AS (SELECT leaf_ord, list(id ORDER BY id) AS ids FROM ids GROUP BY ALL),
steps AS (SELECT m.leaf_ord, m.target_ord, l.ids AS l_ids, t.ids AS t_ids, row_number() OVER (ORDER BY m.leaf_ord, m.nth) AS k FROM matches m JOIN own l USING (leaf_ord) JOIN own t ON t.leaf_ord = m.target_ord),
fold AS (SELECT 0::bigint AS k, MAP([]::bigint[], []::varchar[][]) AS known, NULL::bigint AS leaf, 0 AS grew
  UNION ALL SELECT k2, map_concat(known, MAP([leaf_ord], [list_distinct(list_concat(mine, theirs))])), leaf_ord, (len(list_distinct(list_concat(mine, theirs))) > len(mine))::int
  FROM (SELECT s.k AS k2, f.known, s.leaf_ord, coalesce(f.known[s.leaf_ord], s.l_ids) AS mine, CASE WHEN s.target_ord < s.leaf_ord THEN coalesce(f.known[s.target_ord], s.t_ids) ELSE s.t_ids END AS theirs FROM fold f JOIN steps s ON s.k = f.k + 1)),
known AS (SELECT known FROM fold ORDER BY k DESC LIMIT 1)"""
EXTERNAL = r"(?i)\b(Grundriss\w*|Montageplan\w*|Protokoll\w*|Terminplan\w*|Bestandsm\w*|Ansichtszeichn\w*|Beilage\w*)"
#: Leaves with the faults that the queries plant.
FAULTY = """faulty AS (SELECT * REPLACE (CASE WHEN leaf_ord % 97 = 5 THEN 'later' ELSE priority END AS priority, CASE WHEN leaf_ord % 89 = 3 THEN 'sure' WHEN leaf_ord % 83 = 2 THEN NULL WHEN leaf_ord % 79 = 1 THEN 'low' ELSE confidence END AS confidence,
  CASE WHEN leaf_ord % 101 = 7 THEN '' ELSE bullet_point END AS bullet_point, CASE WHEN leaf_ord % 103 = 9 THEN NULL ELSE level2_label END AS level2_label) FROM merged),
checked AS (SELECT *, coalesce(bullet_point, '') <> '' AND coalesce(priority, '') IN ('must', 'should', 'optional') AND (confidence IS NULL OR confidence IN ('high', 'medium', 'low'))
  AND chunk_ids IS NOT NULL AND description_source IS NOT NULL AND coalesce(level1_label, '') <> '' AND coalesce(level2_label, '') <> '' AS valid FROM faulty)"""
#: Rows of tokens, a token of every page for a step: the rows' first heights are kept in a list.
ROWS = """t AS (SELECT l_orderkey AS page, l_partkey::varchar AS str, l_linenumber * 4.0::double AS x, (l_suppkey % 12)::double AS y, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS k FROM lineitem),
s AS (SELECT DISTINCT page, 0::bigint AS k, []::double[] AS heights, 0::bigint AS row FROM t
  UNION ALL SELECT page, k, CASE WHEN hit = 0 THEN list_append(heights, y) ELSE heights END, CASE WHEN hit = 0 THEN len(heights) + 1 ELSE hit END
  FROM (SELECT t.page, t.k, t.y, s.heights, coalesce(list_position(list_transform(s.heights, lambda h: abs(h - t.y) <= 3), true), 0)::bigint AS hit FROM s JOIN t ON t.page = s.page AND t.k = s.k + 1)),
w AS (SELECT t.*, s.row, s.heights[s.row] AS row_y, x - lag(x + length(str)) OVER (PARTITION BY t.page, s.row ORDER BY x, t.k) AS gap FROM t JOIN s ON s.page = t.page AND s.k = t.k)"""
PROSE = f"pl AS ({PROSE_SQL}), {PROSE_LINES}"
ITEMS = "SELECT file_id || ':p' || page || ':b' || idx AS id, file_id, page, left(item, 80) AS title, item AS text, section FROM prose WHERE item IS NOT NULL"
ALL_LINES = f"al AS (SELECT * FROM ({TENDER_SQL}) UNION ALL SELECT * FROM ({PROSE_SQL}))"
KINDS = rf"""{ALL_LINES}, {content("al", "every", "often")}, pg AS (SELECT DISTINCT file_id, page FROM al), tx AS (SELECT file_id, page, string_agg(text, chr(10) ORDER BY line_ord) AS text FROM every GROUP BY ALL),
kinds AS (SELECT file_id, page, CASE WHEN regexp_matches(lower(x), 'inhaltsverzeichnis|table of contents') THEN 'toc'
 WHEN regexp_matches(lower(x), 'zusammenstellung|summe\s|gesamtbetrag|mwst|\bust\b|übertrag') AND NOT regexp_matches(x, '(?m)^\s*[0-9]{{2}}\.[0-9]{{2}}\.[0-9]{{4}}') AND regexp_matches(lower(x), 'summe|zusammenstellung|übertrag|mwst|\bust\b') THEN 'recap'
 WHEN regexp_matches(lower(x), 'vorbemerkungen|vertragstexte|background|general conditions|gegenstand der ausschreibung') THEN 'preamble'
 WHEN regexp_matches(x, '(?m)^\s*[0-9]{{2}}\.[0-9]{{2}}\.[0-9]{{4}}') OR regexp_matches(x, '\bOZ\b.*Menge.*Einheit') THEN 'lv_positions'
 WHEN regexp_matches(x, '(?m)^\s*[0-9]+\.\s+[A-Z]') AND regexp_matches(lower(x), 'installation|maintenance|specification|dismantl|testing') THEN 'prose_spec'
 WHEN regexp_matches(lower(x), 'contractor details|checklist|tick|please complete|einzutragen') THEN 'form' ELSE 'unknown' END AS kind FROM (SELECT pg.*, coalesce(text, '') AS x FROM pg LEFT JOIN tx USING (file_id, page)))"""


def grounding(said: str, source: str) -> str:
    w = "regexp_extract_all(lower({}), '[a-zäöüß0-9]{{4,}}')".format
    return f"CASE WHEN len(list_distinct({w(said)})) = 0 THEN 1.0 ELSE len(list_intersect(list_distinct({w(said)}), list_distinct({w(source)}))) / len(list_distinct({w(said)})) END"


SQL = {
    "file_manifest": r"""WITH p AS (SELECT page_id, html, regexp_extract(url || CASE page_id % 5 WHEN 0 THEN ' LV.pdf' WHEN 1 THEN ' Annex.pdf' WHEN 2 THEN '_notice.PDF' WHEN 3 THEN ' Tender Annex A.pdf' ELSE '.pdf' END, '([^/]*)$', 1) AS filename FROM pages)
  SELECT page_id, filename, left(regexp_replace(regexp_replace(lower(regexp_replace(filename, '\.[^./]*$', '')), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 40) AS file_id,
  CASE WHEN regexp_matches(lower(filename), '(^|[^a-z])lv([^a-z]|$)|leistungsverzeichnis|tender|ausschreibung') THEN 'main_lv' WHEN regexp_matches(lower(filename), 'annex|anhang|anlage|plan|protokoll|datasheet') THEN 'annex' WHEN regexp_matches(lower(filename), 'notice|bekanntmachung') THEN 'notice' ELSE 'unknown' END AS role_guess, sha256(html) AS sha256 FROM p""",
    "lang_detect": f"SELECT doc_id, {language('coalesce(text, chr(32))')} AS language FROM documents",
    "page_quality": quality("doc_id", "documents", "coalesce(text, '')"),
    "page_quality_ligature": quality("p_partkey", "part", "('installa on tes ng ' || p_name)"),
    "chrome_keys": f"WITH dl AS ({DOC_LINES}) {chrome('dl')}",
    "content_lines": f"WITH dl AS ({DOC_LINES}), {content('dl')} SELECT file_id, page, y, text FROM content",
    "page_kinds": f"WITH {KINDS} SELECT * FROM kinds",
    "page_kind_counts": f"WITH {KINDS} SELECT kind, count(*) AS n FROM kinds GROUP BY kind",
    "lv_titles": f"WITH {BASE} SELECT * FROM titles",
    "lv_groups": f"WITH {BASE} SELECT * FROM groups",
    "lv_positions": f"WITH {BASE} SELECT id, file_id, page, kind, oz_code, title, text, quantity, equivalence FROM chunks",
    "lv_voids": f"WITH {BASE} SELECT id, file_id, page, text FROM chunks WHERE kind = 'void'",
    "lv_quantities": f"WITH {BASE} SELECT file_id, quantity, count(*) AS n, count(equivalence) AS n_equivalent FROM chunks GROUP BY ALL",
    "prose_sections": f"WITH {PROSE} SELECT file_id, page, line_ord, section FROM prose WHERE NOT heading",
    "prose_items": f"WITH {PROSE} {ITEMS}",
    "leaf_grouping_keys": f"WITH {BASE}, {KEYS} SELECT id, level1_key, level1_label, level2_key, level2_label FROM keyed",
    "enrich_stub": rf"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN left(coalesce(text, ''), 30) END AS title, trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS t, CASE WHEN doc_id % 7 = 0 THEN false END AS eq FROM documents) SELECT doc_id, {stub("title", "t", "eq")}, md5(t) AS description_md5 FROM d""",
    "enrich_leaves": f"WITH {LEAVES} SELECT leaf_ord, bullet_point, description_source, language, priority, equivalence_allowed, confidence FROM leaves",
    "obligations": rf"""WITH pl AS ({PROSE_SQL}), x AS (SELECT file_id, string_split(regexp_replace(string_agg(text, chr(10) ORDER BY line_ord), '([.!?])\s+', '\1' || chr(10), 'g'), chr(10)) AS l FROM pl GROUP BY file_id),
  s AS (SELECT file_id, i AS pos, trim(l[i]) AS s FROM x, unnest(range(1, len(l) + 1)) u(i)),
  q AS (SELECT *, row_number() OVER (PARTITION BY file_id, lower(left(s, 60)) ORDER BY pos) AS r FROM s WHERE length(s) BETWEEN 25 AND 400 AND regexp_matches(s, '(?i)\b(muss|müssen|sind zu|hat zu|verpflichtet|shall|must|is to be|are to be|required)\b')),
  n AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY pos) - 1 AS i FROM q WHERE r = 1) SELECT file_id, i, left(s, 80) AS bullet_point, s AS description, 'must' AS priority FROM n WHERE i < 30""",
    "modality_legend": rf"WITH {ALL_LINES}, m AS (SELECT file_id, line_ord, nullif(regexp_extract(text, '(?i)(Mindest|Muss|zwingend)[^\n]{{0,200}}'), '') AS g FROM al) SELECT file_id, arg_min(g, line_ord) FILTER (g IS NOT NULL) AS legend FROM m GROUP BY file_id",
    "consolidate_exact": f"WITH {LEAVES} SELECT level2_key, bullet_point, description_source, priority, equivalence_allowed, leaf_ord, chunk_ids FROM merged",
    "jaccard_candidates": f"""WITH d AS (SELECT source, doc_id, list_sort({WORDS3}) AS w FROM documents), c AS (SELECT source, w, min(doc_id) AS o, count(*) AS n FROM d WHERE len(w) > 0 GROUP BY ALL),
  p AS (SELECT a.source, a.o AS a, b.o AS b, len(list_intersect(a.w, b.w)) AS i, len(a.w) + len(b.w) AS t, a.n AS n_a, b.n AS n_b FROM c a JOIN c b ON a.source = b.source AND a.o < b.o)
  SELECT source, a, b, round(i / (t - i), 4) AS sim, n_a, n_b FROM p WHERE i / (t - i) >= 0.7 UNION ALL SELECT source, o, o, 1.0, n, n FROM c WHERE n > 1""",
    "refs_internal": f"WITH {LEAVES}, {MATCHES} SELECT leaf_ord, nth, name, target_ord FROM matches",
    "refs_external": rf"WITH {LEAVES} SELECT t.leaf_ord, left(m.bullet_point, 60) AS leaf_bullet_point, regexp_extract(t.text, '{EXTERNAL}', 1) AS reference FROM texts t JOIN merged m USING (leaf_ord) WHERE reference <> ''",
    "tree_nested": f"""WITH {LEAVES}, o AS (SELECT *, min(leaf_ord) OVER (PARTITION BY level1_key) AS ord, min(leaf_ord) OVER (PARTITION BY level1_key, level2_key) AS o2 FROM merged)
  SELECT ord, first_value(level1_label) OVER (PARTITION BY level1_key ORDER BY leaf_ord) AS level1, dense_rank() OVER (PARTITION BY level1_key ORDER BY o2) - 1 AS l2, first_value(level2_label) OVER (PARTITION BY level1_key, level2_key ORDER BY leaf_ord) AS level2,
  row_number() OVER (PARTITION BY level1_key, level2_key ORDER BY leaf_ord) - 1 AS l3, bullet_point, description_source AS description, n_chunks FROM o""",
    "tree_level_counts": f"WITH {LEAVES} SELECT level1_key, level2_key, count(*) AS n_leaves FROM merged GROUP BY ROLLUP (level1_key, level2_key)",
    "coverage_report": f"""WITH {LEAVES}, {FAULTY}, m AS (SELECT * FROM checked WHERE leaf_ord % 50 <> 9), gr AS (SELECT m.leaf_ord, {grounding("m.description_source", "t.text")} AS g FROM m JOIN texts t USING (leaf_ord)),
  used AS (SELECT DISTINCT ids.id FROM ids JOIN m USING (leaf_ord)), c AS (SELECT count(*) AS n, coalesce(string_agg(id, ',' ORDER BY file_id, seg) FILTER (id NOT IN (FROM used)), '') AS lost, count(*) FILTER (id IN (FROM used)) AS found FROM chunks WHERE kind = 'position')
  SELECT (SELECT bool_and(valid) FROM m) AS schema_valid, c.n AS total_content_chunks, c.found AS referenced_chunks, c.lost AS orphan_chunks, (SELECT count(*) FROM m) AS leaf_count, (SELECT count(*) FROM m WHERE confidence = 'low') AS low_confidence_leaves,
  (SELECT count(*) FROM m WHERE priority = 'must') AS must_leaves, (SELECT round(avg(g), 3) FROM gr) AS avg_grounding, (SELECT count(*) FROM gr WHERE g < 0.5) AS low_grounding_leaves FROM c""",
    "grounding": f"""WITH {LEAVES} SELECT t.leaf_ord, round({grounding("CASE WHEN t.leaf_ord % 3 = 0 THEN m.description_source || ' erfundener Zusatz' WHEN t.leaf_ord % 5 = 0 THEN 'ab' ELSE m.description_source END", "t.text")}, 6) AS grounding FROM merged m JOIN texts t USING (leaf_ord)""",
    "llm_budget_split": "SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) <= 100 AS use_llm FROM conversations",
    "usage_cost": """WITH u AS (SELECT count(*) AS calls, sum(CASE WHEN role <> 'assistant' THEN length(coalesce(text, '')) ELSE 0 END)::bigint AS prompt_tokens, sum(CASE WHEN role <> 'assistant' AND turn > 0 THEN length(coalesce(text, '')) ELSE 0 END)::bigint AS cached_tokens,
  sum(CASE WHEN role = 'assistant' THEN length(coalesce(text, '')) ELSE 0 END)::bigint AS completion_tokens FROM conversations) SELECT *, round(((prompt_tokens - cached_tokens) * 0.15::double + cached_tokens * 0.075::double + completion_tokens * 0.6::double) / 1e6, 4) AS cost_usd FROM u""",
    "schema_audit": f"WITH {LEAVES}, {FAULTY} SELECT count(*) AS n_leaves, count(*) FILTER (NOT valid) AS n_invalid, bool_and(valid) AS schema_valid FROM checked",
    "line_reconstruct": rf"""WITH RECURSIVE {ROWS}, l AS (SELECT page, row, any_value(row_y) AS y, min(x) AS x, trim(regexp_replace(string_agg(CASE WHEN gap > 1.5 THEN ' ' || str ELSE str END, '' ORDER BY x, k), '\s+', ' ', 'g')) AS text FROM w GROUP BY page, row)
  SELECT 'lineitem' AS file_id, page, y, x, text, page * 1048576 + row_number() OVER (PARTITION BY page ORDER BY y DESC, row) AS line_ord FROM l""",
    "merge_greedy": f"""WITH RECURSIVE {LEAVES}, {GREEDY}, all_ids AS (SELECT leaf_ord, id FROM ids UNION SELECT f.keeper, i.id FROM fold f JOIN ids i ON i.leaf_ord = f.lost)
  SELECT m.leaf_ord, level2_key, bullet_point, string_agg(i.id, ',' ORDER BY i.id) AS chunk_ids FROM merged m JOIN all_ids i USING (leaf_ord) WHERE m.leaf_ord NOT IN (SELECT lost FROM fold WHERE lost IS NOT NULL) GROUP BY ALL""",
    "refs_resolved": f"""WITH RECURSIVE {LEAVES}, {MATCHES}, {RESOLVED}, gain AS (SELECT leaf AS leaf_ord, sum(grew)::bigint AS grew FROM fold WHERE leaf IS NOT NULL GROUP BY ALL)
  SELECT m.leaf_ord, bullet_point, array_to_string(list_sort(coalesce((SELECT known FROM known)[m.leaf_ord], o.ids)), ',') AS chunk_ids, coalesce(gain.grew, 0) AS grew FROM merged m JOIN own o USING (leaf_ord) LEFT JOIN gain USING (leaf_ord)""",
    "refs_report": rf"""WITH RECURSIVE {LEAVES}, {MATCHES}, {RESOLVED}, ext AS (SELECT t.leaf_ord, left(m.bullet_point, 60) || '=' || regexp_extract(t.text, '{EXTERNAL}', 1) AS said, row_number() OVER (ORDER BY t.leaf_ord) AS k FROM texts t JOIN merged m USING (leaf_ord) WHERE regexp_extract(t.text, '{EXTERNAL}', 1) <> ''),
  n AS (SELECT (SELECT count(*) FROM merged) AS scanned_leaves, (SELECT coalesce(sum(grew), 0)::bigint FROM fold) AS internal_resolved)
  SELECT 'main_lv' AS role, n.*, (SELECT count(*) FROM ext) AS external_unresolved, (SELECT count(*) FROM ext WHERE k <= 50) AS n_listed, (SELECT coalesce(string_agg(said, '|' ORDER BY k), '') FROM ext WHERE k <= 50) AS listed FROM n
  UNION ALL SELECT 'annex', n.*, 0, 0, '' FROM n""",
    "pages_report": r"""WITH d AS (SELECT source AS file_id, doc_id, CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 5 = 0 THEN 'installa on tes ng ' || left(text, 60) ELSE coalesce(text, '') END AS text FROM documents),
  q AS (SELECT *, trim(text, E' \t\n\r\x0b\x0c') AS t FROM d), m AS (SELECT *, len(regexp_extract_all(t, '�|Æ|ﬁ|ﬂ')) AS a, len(regexp_extract_all(t, '[a-z] (on|ng|ed|ce|er|ts)\b')) AS b, len(regexp_split_to_array(t, '\s+')) AS w FROM q),
  k AS (SELECT *, {QUALITY} AS q FROM m)
  SELECT file_id, count(*) AS n_pages, count(*) FILTER (q = 'corrupted' AND doc_id % 2 = 1) AS n_corrupted, count(*) FILTER (q = 'image_only') AS n_image_only, count(*) FILTER (q = 'corrupted' AND doc_id % 2 = 0) AS n_ocr FROM k GROUP BY file_id""".replace("{QUALITY}", QUALITY),
    "preamble_texts": f"""WITH {BASE}, {KINDS}, has AS (SELECT DISTINCT file_id FROM chunks WHERE kind = 'position'), pre AS (SELECT file_id, string_agg(text, chr(10) ORDER BY line_ord) AS text FROM every JOIN kinds USING (file_id, page)
  WHERE kind = 'preamble' OR (kind IN ('unknown', 'form') AND file_id NOT IN (FROM has)) GROUP BY file_id), langs AS (SELECT file_id, CASE WHEN sum({count("text", EN)}) > sum({count("text", DE)}) THEN 'en' ELSE 'de' END AS language FROM al GROUP BY file_id)
  SELECT file_id, length(text) AS n_chars, md5(text) AS text_md5, language FROM pre JOIN langs USING (file_id) WHERE length(trim(text)) >= 50""",
    "no_positions": f"""WITH {BASE}, {KINDS}, pl AS (SELECT * FROM every WHERE file_id NOT IN (SELECT file_id FROM chunks WHERE kind = 'position')), {PROSE_LINES}
  SELECT id, file_id, page, kind, md5(text) AS text_md5, NULL::varchar AS section FROM chunks UNION ALL SELECT id, file_id, page, 'paragraph', md5(text), section FROM ({ITEMS})""",
    "room_codes": f"""WITH p AS ({CUSTOMER_SQL}) SELECT file_id || ':p' || page || ':' || 'GU.' || rr || '.' || nn || '.' || left(lpad(k::varchar, 4, '0'), 2) || '.' || right(lpad(k::varchar, 4, '0'), 2) AS id, 'GU' AS level1_key, 'Section GU' AS level1_label,
  'GU.' || rr || '.' || nn AS level2_key, n_name AS level2_label FROM p WHERE c_custkey % 17 <> 0""",
    "legend_skip": f"""WITH {BASE.replace("tl AS (" + TENDER_SQL + ")", "tl AS (SELECT * REPLACE (regexp_replace(text, '^([0-9]{2}[.][0-9]{2}[.][0-9]{3}3) .*$', '" + chr(92) + "1 laufende Nr der Position') AS text) FROM (" + TENDER_SQL + "))")}
  SELECT id, kind, title, md5(text) AS text_md5, quantity FROM chunks""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
