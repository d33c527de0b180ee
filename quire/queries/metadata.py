"""Inferred metadata and the manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import preview
from quire.operators import metadata as md
from quire.operators import nodes
from quire.plans import corpus, run
from quire.queries.sqltext import FILES, MERGED, strip, tokens
from quire.queries.chunks import _CHILDREN
from quire.session import table


def paper_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First title of each document."""
    return md.paper_titles(corpus.merged_elements(spark, sf_dir))


def paper_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Author lines of each document."""
    return md.paper_authors(corpus.merged_elements(spark, sf_dir)).select("doc_id", F.array_join("authors", "\n").alias("authors"))


def paper_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year of each document."""
    return md.paper_years(corpus.merged_elements(spark, sf_dir))


def element_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements of each type in each document."""
    return md.type_counts(corpus.merged_elements(spark, sf_dir))


def _metadata(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    files = corpus.current_files(table(spark, sf_dir, "parsed_documents"))
    merged, counts = corpus.sizes(spark, sf_dir)
    return files, merged, md.doc_metadata(files, merged, counts)


def doc_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All metadata of each document."""
    return _metadata(spark, sf_dir)[2].withColumn("authors", F.array_join("authors", "\n"))


def text_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 240 characters of each document."""
    return table(spark, sf_dir, "documents").select("doc_id", preview(F.coalesce("text", F.lit("")), 240).alias("text_preview"))


def min_chars_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of at least 40 code points."""
    return table(spark, sf_dir, "documents").where(F.char_length("text") >= corpus.MIN_CHARACTERS).select("doc_id", F.char_length("text").cast("bigint").alias("n_chars"))


def docs_with_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed documents that have any element."""
    files = corpus.current_files(table(spark, sf_dir, "parsed_documents"))
    return files.join(table(spark, sf_dir, "elements").select("doc_id"), "doc_id", "left_semi").select("doc_id", "relative_path")


def manifest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest entries in path order."""
    files, merged, metadata = _metadata(spark, sf_dir)
    out = md.manifest_documents(files, metadata, merged)
    counts = F.array_join(F.transform(F.array_sort(F.map_entries("element_type_counts")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return out.select("index", "doc_id", "title", "year", "topic", "file_ext", "char_count", "relative_path", "elements_count", "parent_nodes_count", "child_nodes_count", counts.alias("element_type_counts"), "text_preview")


def manifest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document count and total characters."""
    _, _, metadata = _metadata(spark, sf_dir)
    return metadata.agg(F.count("*").alias("document_count"), F.coalesce(F.sum("char_count"), F.lit(0)).alias("total_characters"))


def _fields(*columns: F.Column) -> F.Column:
    return F.concat_ws("\x1f", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns))


def nested_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record that a run writes for every document, by its sizes and the hash of all its fields in order."""
    files = corpus.current_files(table(spark, sf_dir, "parsed_documents"))
    merged, parents, children = corpus.nodes(spark, sf_dir)
    looked_at = md.light(merged)
    meta = md.doc_metadata(files, looked_at, nodes.counts(looked_at, corpus.CHUNK_SIZE, corpus.CHUNK_OVERLAP))
    rows = lambda x: F.array_join(F.transform(x, lambda r: F.array_join(r, "|", "")), "\n")
    path = lambda x: F.array_join(x["section_path"], ">")
    each = {
        "elements": lambda e: _fields(e["element_id"], e["element_type"], e["text"], e["page"], e["order"], path(e), F.size(e["metadata"]["bboxes"]), rows(e["metadata"]["rows"])),
        "parent_nodes": lambda p: _fields(p["parent_id"], p["doc_id"], path(p), p["page_start"], p["page_end"], p["text"], p["metadata"]["section"], p["metadata"]["paper_title"], p["metadata"]["year"], p["metadata"]["chunk_level"]),
        "child_nodes": lambda c: _fields(
            c["child_id"], c["parent_id"], c["chunk_type"], path(c), c["page_start"], c["page_end"], c["text"], c["metadata"]["section"], c["metadata"]["year"], c["metadata"]["chunk_index"],
            rows(c["metadata"]["table_rows"]), c["metadata"]["figure_context"],
        ),
    }
    parts = [F.coalesce(F.array_join(F.transform(name, f), "\x1e"), F.lit("")) for name, f in each.items()]
    record = F.sha2(F.concat_ws("\x1d", F.col("metadata.title"), *parts), 256)
    size = lambda name: F.coalesce(F.size(name), F.lit(0)).alias(f"n_{name}")
    return run.nested(files, merged, parents, children, meta).select("doc_id", *map(size, each), record.alias("record_hash"))


QUERIES = {
    f.__name__: f
    for f in (paper_title, paper_authors, paper_year, element_type_counts, doc_metadata, text_preview, min_chars_filter, docs_with_elements, manifest_documents, manifest_summary, nested_documents)
}

_TITLES = "titles AS (SELECT doc_id, arg_min(text, ord) AS paper_title FROM merged WHERE element_type = 'title' GROUP BY 1)"
_AUTHORS = f"""
t0 AS (SELECT doc_id, min(ord) AS t FROM merged WHERE page = 1 AND element_type = 'title' GROUP BY 1),
h0 AS (SELECT m.doc_id, min(ord) AS h FROM merged m JOIN t0 USING (doc_id) WHERE page = 1 AND element_type = 'section_heading' AND ord > t GROUP BY 1),
lines AS (
  SELECT doc_id, ord, st, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS n
  FROM (SELECT m.doc_id, ord, {strip('text')} AS st FROM merged m JOIN t0 USING (doc_id) LEFT JOIN h0 USING (doc_id) WHERE page = 1 AND ord > t AND element_type <> 'title' AND (h IS NULL OR ord < h))
  WHERE NOT regexp_matches(st, '\\p{{Nd}}{{4}}') AND NOT contains(st, '@') AND len({tokens('st')}) BETWEEN 2 AND 15),
authored AS (SELECT doc_id, string_agg(st, chr(10) ORDER BY ord) AS authors FROM lines WHERE n <= 3 GROUP BY 1)"""
_YEARS = r"""
years AS (
  SELECT doc_id, CAST(arg_min(y, ord) AS INTEGER) AS year
  FROM (SELECT doc_id, ord, regexp_extract(text, '(?:^|[^\p{L}\p{M}\p{N}_])((?:19|20)\p{Nd}{2})(?:$|[^\p{L}\p{M}\p{N}_])', 1) AS y FROM merged WHERE ord <= 25) WHERE y <> '' GROUP BY 1)"""
_NAME = "string_split(relative_path, '/')[-1]"
_META = f"""{FILES}, {_CHILDREN}, {_TITLES}, {_AUTHORS}, {_YEARS},
meta AS (
  SELECT f.doc_id, f.source_path, f.relative_path, {_NAME} AS file_name, lower(regexp_extract({_NAME}, '^.+(\\.[^.]+)$', 1)) AS file_ext,
    CASE WHEN contains(relative_path, '/') THEN string_split(relative_path, '/')[1] ELSE 'root' END AS topic,
    coalesce(paper_title, CASE WHEN regexp_extract({_NAME}, '^.+(\\.[^.]+)$', 1) = '' THEN {_NAME} ELSE regexp_replace({_NAME}, '\\.[^.]+$', '') END) AS title,
    coalesce(authors, '') AS authors, year, f.char_count, f.text, e.page_start, e.page_end, e.n AS elements_count, coalesce(p.n, 0) AS parent_nodes_count, coalesce(c.n, 0) AS child_nodes_count
  FROM files f JOIN (SELECT doc_id, min(page) AS page_start, max(page) AS page_end, count(*) AS n FROM merged GROUP BY 1) e USING (doc_id)
  LEFT JOIN (SELECT doc_id, count(*) AS n FROM nodes GROUP BY 1) p USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM kids GROUP BY 1) c USING (doc_id)
  LEFT JOIN titles USING (doc_id) LEFT JOIN authored USING (doc_id) LEFT JOIN years USING (doc_id))"""


def _preview(x: str) -> str:
    flat = f"array_to_string({tokens(x)}, ' ')"
    return f"CASE WHEN length({flat}) <= 240 THEN {flat} ELSE rtrim({flat}[1:240]) || '...' END"


def _joined(*fields: str) -> str:
    return "concat_ws(chr(31), " + ", ".join(f"coalesce(CAST({f} AS VARCHAR), '')" for f in fields) + ")"


def _rows(x: str) -> str:
    return f"array_to_string(list_transform({x}, lambda r: array_to_string(list_transform(r, lambda c: coalesce(c, '')), '|')), chr(10))"


_PATH = "array_to_string(section_path, '>')"
_NESTED = f"""WITH {_META},
e AS (SELECT doc_id, count(*) AS n, string_agg({_joined('element_id', 'element_type', 'text', 'page', 'ord', _PATH, 'len(bboxes)', f"CASE WHEN element_type = 'table' THEN {_rows('table_rows')} END")}, chr(30) ORDER BY ord) AS s FROM merged GROUP BY 1),
p AS (SELECT n.doc_id, count(*) AS n, string_agg({_joined('parent_id', 'n.doc_id', _PATH, 'n.page_start', 'n.page_end', 'n.text', 'section', 'm.title', 'm.year', "'parent'")}, chr(30) ORDER BY parent_index) AS s FROM nodes n JOIN meta m USING (doc_id) GROUP BY 1),
c AS (SELECT k.doc_id, count(*) AS n, string_agg({_joined('child_id', 'parent_id', 'chunk_type', _PATH, 'k.page_start', 'k.page_end', 'k.text', 'section', 'm.year', 'chunk_index', _rows('table_rows'), 'figure_context')}, chr(30) ORDER BY place) AS s FROM kids k JOIN meta m USING (doc_id) GROUP BY 1)
SELECT m.doc_id, CAST(e.n AS INTEGER) AS n_elements, CAST(coalesce(p.n, 0) AS INTEGER) AS n_parent_nodes, CAST(coalesce(c.n, 0) AS INTEGER) AS n_child_nodes,
  sha256(concat_ws(chr(29), m.title, coalesce(e.s, ''), coalesce(p.s, ''), coalesce(c.s, ''))) AS record_hash
FROM meta m JOIN e USING (doc_id) LEFT JOIN p USING (doc_id) LEFT JOIN c USING (doc_id)"""

SQL = {
    "nested_documents": _NESTED,
    "paper_title": f"WITH {MERGED}, {_TITLES} SELECT doc_id, paper_title FROM titles",
    "paper_authors": f"WITH {MERGED}, {_AUTHORS} SELECT doc_id, authors FROM authored",
    "paper_year": f"WITH {MERGED}, {_YEARS} SELECT doc_id, year FROM years",
    "element_type_counts": f"WITH {MERGED} SELECT doc_id, element_type, count(*) AS n FROM merged GROUP BY 1, 2",
    "doc_metadata": f"""WITH {_META} SELECT doc_id, source_path, relative_path, file_name, file_ext, topic, title, title AS paper_title, authors, year, char_count, page_start, page_end,
  elements_count, parent_nodes_count, child_nodes_count FROM meta""",
    "text_preview": f"SELECT doc_id, {_preview('tx')} AS text_preview FROM (SELECT doc_id, coalesce(text, '') AS tx FROM documents)",
    "min_chars_filter": "SELECT doc_id, length(text) AS n_chars FROM documents WHERE length(text) >= 40",
    "docs_with_elements": f"WITH {FILES} SELECT doc_id, relative_path FROM files WHERE doc_id IN (SELECT doc_id FROM elements)",
    "manifest_documents": f"""WITH {_META}
SELECT row_number() OVER (ORDER BY string_split(relative_path, '/'), m.doc_id) AS index, m.doc_id, title, year, topic, file_ext, char_count, relative_path, elements_count, parent_nodes_count, child_nodes_count,
  t.counts AS element_type_counts, {_preview("coalesce(text, '')")} AS text_preview
FROM meta m JOIN (SELECT doc_id, string_agg(element_type || '=' || n, ',' ORDER BY element_type) AS counts FROM (SELECT doc_id, element_type, count(*) AS n FROM merged GROUP BY 1, 2) GROUP BY 1) t ON t.doc_id = m.doc_id""",
    "manifest_summary": f"WITH {_META} SELECT count(*) AS document_count, CAST(coalesce(sum(char_count), 0) AS BIGINT) AS total_characters FROM meta",
}
