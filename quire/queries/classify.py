"""Items and their types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import file_name, strip, suffix
from quire.operators import elements as el
from quire.plans.corpus import classified_items, current_files, line_items
from quire.queries import sqltext as q
from quire.queries.sqltext import FILES, ITEMS, LINES, SECTIONED, classify
from quire.session import table
from quire.sources import parse

_CONVERTERS = {".pdf": parse.text_layer}


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = table(spark, sf_dir, "documents").where("text is not null and doc_id is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("k", "t"))
    return split.select("doc_id", (F.col("k") + 1).alias("seq"), strip(F.col("t")).alias("t")).where("t <> ''")


def item_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of every item from its caption, text, original or markdown."""
    text = el.item_text(*(F.col(c) for c in ("caption", "text", "original", "markdown")))
    return line_items(table(spark, sf_dir, "documents")).select("doc_id", "seq", text.alias("item_text"))


def drop_empty_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept items with their running number."""
    return el.kept_items(line_items(table(spark, sf_dir, "documents"))).select("doc_id", "seq", "ord", "text")


def is_figure_caption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items whose text reads as a figure caption."""
    return el.kept_items(line_items(table(spark, sf_dir, "documents"))).where(el.is_figure_caption(F.col("text"))).select("doc_id", "ord", "text")


def is_equation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items whose text reads as an equation."""
    return el.kept_items(line_items(table(spark, sf_dir, "documents"))).where(el.is_equation(F.col("text"))).select("doc_id", "ord", "text")


def is_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole element texts that read as tables."""
    return table(spark, sf_dir, "elements").where(el.is_table(F.coalesce("text", F.lit("")))).select("element_id", "element_type").distinct()


def classify_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of the documents' raw lines."""
    kind = el.classify(F.col("t"), F.lit(False))
    return _lines(spark, sf_dir).groupBy(kind.alias("element_type")).agg(F.count("*").alias("n"))


def in_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items below a references heading, and the type that gives them."""
    return classified_items(table(spark, sf_dir, "documents")).where("in_references").select("doc_id", "ord", "element_type")


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = current_files(table(spark, sf_dir, "parsed_documents"))
    return files.select("relative_path", suffix(file_name(F.col("relative_path"))).alias("file_ext"), F.col("text").cast("binary").alias("content"))


def conversion_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file that goes through a converter, with how its conversion ended and the number of its items."""
    out = parse.converted(_files(spark, sf_dir), _CONVERTERS)
    return out.select("relative_path", "doc_id", "ok", "error", F.size("items").alias("n_items"))


def unparsed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that give no items where no converter is named, with the reason; the others are parsed."""
    return parse.items(_files(spark, sf_dir))[1]


QUERIES = {f.__name__: f for f in (item_text, drop_empty_items, is_figure_caption, is_equation, is_table, classify_text, in_references, conversion_ok, unparsed_files)}

_EXT = "lower(regexp_extract(string_split(relative_path, '/')[-1], '^.+(\\.[^.]+)$', 1))"
_ENDED = f"""
ended AS (
  SELECT *, CASE WHEN ext IN ('.md', '.txt') THEN CASE WHEN text IS NULL THEN 'no content' END WHEN ext <> '.pdf' THEN 'LookupError: no converter for ' || ext WHEN text IS NULL THEN 'ValueError: no content'
    WHEN n = 0 THEN 'RuntimeError: conversion ended as failure' END AS error
  FROM (SELECT relative_path, text, {_EXT} AS ext, len(list_filter(regexp_split_to_array(coalesce(text, ''), '{q.LINE_END}'), lambda ln: {q.strip('ln')} <> '')) AS n FROM files))"""

SQL = {
    "item_text": f"WITH {ITEMS} SELECT doc_id, seq, coalesce(nullif(caption, ''), nullif(text, ''), nullif(original, ''), markdown, '') AS item_text FROM items",
    "drop_empty_items": f"WITH {ITEMS} SELECT doc_id, seq, ord, text FROM kept",
    "is_figure_caption": f"WITH {ITEMS} SELECT doc_id, ord, text FROM kept WHERE {q.is_figure_caption('text')}",
    "is_equation": f"WITH {ITEMS} SELECT doc_id, ord, text FROM kept WHERE {q.is_equation('text')}",
    "is_table": f"SELECT DISTINCT element_id, element_type FROM elements WHERE {q.is_table(chr(34) + 'text' + chr(34))}",
    "classify_text": f"WITH {LINES} SELECT {classify('t', 'false')} AS element_type, count(*) AS n FROM lines GROUP BY 1",
    "in_references": f"""WITH {SECTIONED} SELECT doc_id, ord,
  CASE label WHEN 'title' THEN 'title' WHEN 'section_header' THEN 'section_heading' WHEN 'formula' THEN 'equation' ELSE {classify('text', 'in_references')} END AS element_type
FROM sectioned WHERE in_references""",
    "conversion_ok": f"""WITH {FILES}, {_ENDED}
SELECT relative_path, sha1(relative_path) AS doc_id, error IS NULL AS ok, error, CAST(CASE WHEN error IS NULL THEN n ELSE 0 END AS INTEGER) AS n_items FROM ended WHERE ext NOT IN ('.md', '.txt')""",
    "unparsed_files": f"""WITH {FILES}
SELECT * FROM (SELECT relative_path, CASE WHEN {_EXT} NOT IN ('.md', '.txt') THEN 'LookupError: no converter for ' || {_EXT} WHEN text IS NULL THEN 'no content' END AS error FROM files) WHERE error IS NOT NULL""",
}
