"""SQL fragments that the comparison queries share."""

from __future__ import annotations

SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{SPACE}+'), lambda tk: tk <> '')"


def count_of(x: str, sub: str) -> str:
    return f"(length({x}) - length(replace({x}, '{sub}', '')))"


def is_figure_caption(x: str) -> str:
    return rf"regexp_matches(lower({strip(x)}), '^(figure|fig\.)[\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]*\p{{Nd}}+')"


def is_equation(x: str) -> str:
    return rf"(contains({x}, '=') AND regexp_matches({x}, '[+\-*/^∑∏∫λσ]'))"


def is_table(x: str) -> str:
    rows = f"list_filter(list_transform(regexp_split_to_array({x}, '{LINE_END}'), lambda ln: {strip('ln')}), lambda ln: ln <> '')"
    return (
        f"(len(list_filter({rows}, lambda r: length(r) - length(replace(r, '|', '')) >= 2 OR contains(r, chr(9)))) > 0 "
        f"OR len(list_filter({rows}, lambda r: contains(r, '|'))) >= 2)"
    )


def classify(x: str, refs: str) -> str:
    return f"CASE WHEN {refs} THEN 'references' WHEN {is_figure_caption(x)} THEN 'figure_caption' WHEN {is_equation(x)} THEN 'equation' WHEN {is_table(x)} THEN 'table' ELSE 'paragraph' END"


#: Lines of the documents.
LINES = f"""
lines AS (
  SELECT doc_id, seq, {strip('t')} AS t
  FROM (SELECT doc_id, unnest(range(1, len(x) + 1)) AS seq, unnest(x) AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL))
  WHERE {strip('t')} <> '')"""

#: Parser items of the documents, and those kept, numbered.
ITEMS = f"""{LINES},
items AS (
  SELECT doc_id, seq,
    CASE WHEN seq = 1 THEN 'title' WHEN seq % 5 = 0 THEN 'section_header' WHEN seq % 7 <> 0 AND seq % 11 <> 0 AND seq % 13 <> 0 AND seq % 17 = 0 THEN 'formula' ELSE 'text' END AS label,
    CASE WHEN seq <> 1 AND seq % 5 = 0 THEN 1 + ((seq // 5) - 1) % 3 END AS level,
    1 + (seq - 1) // 12 AS page,
    CASE WHEN seq = 1 THEN CASE WHEN doc_id % 3 = 0 THEN t || ' ' || (1900 + doc_id % 150) ELSE t END
         WHEN seq % 20 = 0 THEN 'References ' || seq WHEN seq % 5 = 0 THEN 'Section ' || seq
         WHEN seq % 7 = 0 THEN 'Figure ' || seq || ': ' || t WHEN seq % 11 = 0 THEN 'y = a + ' || t
         WHEN seq % 13 = 0 THEN replace(t, ' ', ' | ') WHEN seq % 17 = 0 OR seq % 23 = 0 THEN '' ELSE t END AS text,
    CASE WHEN seq % 7 = 0 THEN 'Figure ' || seq ELSE '' END AS caption,
    CASE WHEN seq % 2 = 0 THEN t ELSE '' END AS original, '| ' || t AS markdown
  FROM lines),
kept AS (
  SELECT doc_id, seq, label, level, page, CASE WHEN st = '' THEN '[equation]' ELSE st END AS text, row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS ord
  FROM (SELECT *, {strip('text')} AS st FROM items) WHERE st <> '' OR label = 'formula')"""

#: Kept items with the references flag and the section path by the fold over headings of levels 1 to 3.
SECTIONED = f"""{ITEMS},
heads AS (
  SELECT doc_id, ord, level, text,
    max(CASE WHEN level = 1 THEN {{'o': ord, 't': text}} END) OVER w AS h1,
    max(CASE WHEN level = 2 THEN {{'o': ord, 't': text}} END) OVER w AS h2,
    coalesce(max(CASE WHEN level < 2 THEN ord END) OVER w, 0) AS b2
  FROM kept WHERE label = 'section_header' WINDOW w AS (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
paths AS (
  SELECT doc_id, ord, CASE level WHEN 1 THEN [text]
    WHEN 2 THEN [CASE WHEN h1 IS NOT NULL THEN h1.t ELSE 'section' END, text]
    ELSE [CASE WHEN h1 IS NOT NULL THEN h1.t ELSE 'section' END, CASE WHEN coalesce(h2.o, 0) > b2 THEN h2.t ELSE 'section' END, text] END AS path,
    starts_with(lower(text), 'references') AS refs
  FROM heads),
sectioned AS (
  SELECT k.*, coalesce(last_value(p.path IGNORE NULLS) OVER w, []) AS section_path, coalesce(last_value(p.refs IGNORE NULLS) OVER w, false) AS in_references
  FROM kept k LEFT JOIN paths p USING (doc_id, ord)
  WINDOW w AS (PARTITION BY k.doc_id ORDER BY k.ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

#: Cleaned and merged elements.
MERGED = f"""
cleaned AS (
  SELECT doc_id, ord, element_type, CASE WHEN st = '' THEN '[equation]' ELSE st END AS text, CASE WHEN page > 0 THEN page ELSE 1 END AS page,
    coalesce(section_path, []) AS section_path, coalesce(table_rows, []) AS table_rows, coalesce(bboxes, []) AS bboxes
  FROM (SELECT DISTINCT doc_id, ord, element_type, {strip("coalesce(text, '')")} AS st, page, section_path, table_rows, bboxes FROM elements)
  WHERE (st <> '' OR element_type = 'equation') AND doc_id IS NOT NULL AND ord IS NOT NULL),
broken AS (
  SELECT *, CASE WHEN element_type IN ('paragraph', 'references', 'table') AND lag(element_type) OVER w = element_type AND lag(page) OVER w = page AND lag(section_path) OVER w = section_path THEN 0 ELSE 1 END AS b
  FROM cleaned WINDOW w AS (PARTITION BY doc_id ORDER BY ord)),
grouped AS (SELECT *, sum(b) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM broken),
merged AS (
  SELECT doc_id, sha1(doc_id || '::element::' || CAST(g AS BIGINT)) AS element_id, first(element_type ORDER BY ord) AS element_type,
    string_agg(text, chr(10) ORDER BY ord) AS text, first(page ORDER BY ord) AS page, CAST(g AS BIGINT) AS ord, first(section_path ORDER BY ord) AS section_path,
    flatten(list(table_rows ORDER BY ord)) AS table_rows, flatten(list(bboxes ORDER BY ord)) AS bboxes, count(*) AS n_merged
  FROM grouped GROUP BY doc_id, g)"""

#: Parents of the merged elements.
PARENTS = f"""{MERGED},
indexed AS (
  SELECT *, CAST(sum(CASE WHEN element_type = 'section_heading' OR ord = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS parent_index
  FROM merged),
parted AS (
  SELECT doc_id, parent_index, first(section_path ORDER BY ord) AS p, min(page) AS page_start, max(page) AS page_end, string_agg(text, chr(10) ORDER BY ord) AS text
  FROM indexed GROUP BY doc_id, parent_index),
nodes AS (
  SELECT doc_id, sha1(doc_id || '::parent::' || parent_index || '::' || array_to_string(path, '.')) AS parent_id, parent_index, path AS section_path, path[-1] AS section, page_start, page_end, text
  FROM (SELECT *, CASE WHEN len(p) > 0 THEN p ELSE ['front_matter'] END AS path FROM parted))"""


def windows(source: str, key: str, size: int, overlap: int) -> str:
    """CTEs ``tok`` and ``win``: the token windows of ``source`` (columns in ``key`` and text)."""
    step = max(size - max(overlap, 0), 1)
    return f"""
tok AS (SELECT {key}, {tokens("coalesce(text, '')")} AS tk FROM {source}),
num AS (SELECT *, CASE WHEN len(tk) = 0 THEN 0 WHEN len(tk) <= {size} THEN 1 ELSE CAST(ceil((len(tk) - {size}) / {step}.0) AS BIGINT) + 1 END AS n FROM tok),
win AS (SELECT {key}, w + 1 AS chunk_index, array_to_string(tk[w * {step} + 1 : w * {step} + {size}], ' ') AS chunk FROM (SELECT *, unnest(range(0, n)) AS w FROM num))"""


#: Tables and figures with their parent and context.
SPECIAL = f"""{PARENTS},
moved AS (
  SELECT *, CASE WHEN lag(page) OVER w = page AND lag(section_path) OVER w = section_path THEN 0 ELSE 1 END AS mv FROM merged WINDOW w AS (PARTITION BY doc_id ORDER BY ord)),
runs AS (SELECT *, sum(mv) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM moved),
contexts AS (
  SELECT doc_id, element_id, element_type, ord, coalesce(first_value(CASE WHEN element_type = 'paragraph' THEN text END IGNORE NULLS) OVER (PARTITION BY doc_id, run ORDER BY ord ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS context
  FROM runs),
placed AS (
  SELECT e.doc_id, e.element_id, e.element_type, e.ord, e.page, e.text, e.section_path, e.table_rows, arg_min(n.parent_id, (CASE WHEN n.section_path = e.section_path THEN 0 WHEN len(e.section_path) > 0 AND n.section_path[-1] = e.section_path[-1] THEN 1 ELSE 2 END, n.parent_index)) AS parent_id
  FROM merged e JOIN nodes n USING (doc_id) WHERE e.element_type IN ('table', 'figure_caption')
  GROUP BY ALL),
special AS (
  SELECT p.doc_id, p.parent_id, CASE WHEN p.element_type = 'table' THEN 'table' ELSE 'figure' END AS chunk_type, p.element_id, p.section_path, p.page, p.ord, p.table_rows, c.context,
    {strip("p.text || chr(10) || CASE WHEN p.element_type = 'table' THEN coalesce(array_to_string(list_transform(list_filter(p.table_rows, lambda r: len(r) > 0), lambda r: array_to_string(list_transform(r, lambda c: coalesce(c, '')), ' | ')), chr(10)), '') ELSE c.context END")} AS text
  FROM placed p JOIN contexts c USING (doc_id, element_id))"""

#: The current listing and the latest state of each path.
FILES = """
files AS (
  SELECT relative_path, r.doc_id AS doc_id, r.text AS text, sha256(coalesce(r.text, '')) AS fingerprint, length(coalesce(r.text, '')) AS char_count, r.exported_at AS ingested_at, r.source_path AS source_path
  FROM (SELECT metadata.relative_path AS relative_path, arg_max({'doc_id': doc_id, 'text': text, 'exported_at': exported_at, 'source_path': metadata.source_path}, (coalesce(exported_at, TIMESTAMPTZ '0001-01-01'), record_id)) AS r
        FROM parsed_documents WHERE metadata.relative_path IS NOT NULL GROUP BY 1)),
state AS (
  SELECT relative_path, r.fingerprint AS fingerprint, r.doc_id AS doc_id, r.char_count AS char_count, r.at AS last_ingested_at
  FROM (SELECT relative_path, arg_max({'fingerprint': fingerprint, 'doc_id': doc_id, 'char_count': char_count, 'at': last_ingested_at}, (coalesce(last_ingested_at, TIMESTAMPTZ '0001-01-01'), coalesce(fingerprint, ''))) AS r
        FROM ingest_state WHERE relative_path IS NOT NULL GROUP BY 1)),
decided AS (
  SELECT f.*, CASE WHEN s.relative_path IS NULL THEN 'new' WHEN s.fingerprint = f.fingerprint THEN 'unchanged' ELSE 'changed' END AS decision
  FROM files f LEFT JOIN state s USING (relative_path))"""

_ESCAPED = """CASE WHEN unicode(c) BETWEEN 32 AND 126 THEN c WHEN unicode(c) < 65536 THEN format('\\u{:04x}', unicode(c))
  ELSE format('\\u{:04x}\\u{:04x}', 55296 + (unicode(c) - 65536) // 1024, 56320 + (unicode(c) - 65536) % 1024) END"""


def json_string(x: str) -> str:
    named = f"replace(replace({x}, '\\', '\\\\'), '\"', '\\\"')"
    for code, letter in ((10, "n"), (13, "r"), (9, "t"), (8, "b"), (12, "f")):
        named = f"replace({named}, chr({code}), '\\{letter}')"
    return f"'\"' || CASE WHEN {x} = '' THEN '' ELSE array_to_string(list_transform(regexp_extract_all({named}, '(?s).'), lambda c: {_ESCAPED}), '') END || '\"'"


def uuid5(x: str) -> str:
    bare = f"lower(regexp_replace(regexp_replace({x}, '^(?i)urn:uuid:', ''), '[{{}}\\-]', '', 'g'))"
    digest = f"sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode({x}))"
    digit = f"instr('0123456789abcdef', substr({digest}, 17, 1)) - 1"
    named = f"substr({digest}, 1, 12) || '5' || substr({digest}, 14, 3) || substr('89ab', CAST(({digit}) % 4 + 1 AS BIGINT), 1) || substr({digest}, 18, 15)"
    text = f"CASE WHEN regexp_matches({bare}, '^[0-9a-f]{{32}}$') THEN {bare} ELSE {named} END"
    return f"substr({text}, 1, 8) || '-' || substr({text}, 9, 4) || '-' || substr({text}, 13, 4) || '-' || substr({text}, 17, 4) || '-' || substr({text}, 21, 12)"


#: Chunks that can be indexed, with point ids and hashes; the latest index state.
POINTS = f"""
usable AS (
  SELECT doc_id, chunk_type, text, parent_id, chunk_level, page_start, page_end, section_path, chunk_index,
    CASE WHEN {strip("coalesce(child_id, '')")} = '' THEN sha1(coalesce(doc_id, '') || chr(31) || coalesce(chunk_type, '') || chr(31) || coalesce(CAST(page_start AS VARCHAR), '') || chr(31) || coalesce(CAST(page_end AS VARCHAR), '') || chr(31) || coalesce(text, '') || chr(31) || array_to_string(coalesce(section_path, []), '.')) ELSE child_id END AS child_id
  FROM children WHERE {strip("coalesce(text, '')")} <> '' AND doc_id IS NOT NULL),
ids AS (SELECT *, {uuid5('child_id')} AS point_id FROM (SELECT DISTINCT * FROM usable)),
points AS (
  SELECT doc_id, point_id, max(sha256('{{"metadata": {{"chunk_type": ' || {json_string("coalesce(chunk_type, '')")} || ', "doc_id": ' || {json_string('doc_id')} || '}}, "text": ' || {json_string('text')} || '}}')) AS content_hash
  FROM ids GROUP BY doc_id, point_id),
old AS (
  SELECT doc_id, point_id, arg_max(content_hash, (coalesce(updated_at, TIMESTAMPTZ '0001-01-01'), coalesce(content_hash, ''))) AS content_hash
  FROM index_state WHERE doc_id IS NOT NULL AND point_id IS NOT NULL GROUP BY doc_id, point_id),
loaded AS (SELECT DISTINCT doc_id FROM children),
diff AS (
  SELECT coalesce(p.doc_id, o.doc_id) AS doc_id, coalesce(p.point_id, o.point_id) AS point_id, o.content_hash AS old_hash, p.content_hash AS new_hash,
    CASE WHEN p.point_id IS NULL THEN 'stale' WHEN o.point_id IS NULL THEN 'new' WHEN o.content_hash = p.content_hash THEN 'unchanged' ELSE 'changed' END AS status
  FROM points p FULL JOIN (SELECT * FROM old WHERE doc_id IN (SELECT doc_id FROM loaded)) o ON p.doc_id = o.doc_id AND p.point_id = o.point_id)"""
