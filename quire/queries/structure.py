"""Sections, merging, tables, parents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import elements as el
from quire.operators import nodes
from quire.plans.corpus import classified_items, merged_elements
from quire.queries.sqltext import LINE_END, MERGED, PARENTS, SECTIONED, SPACE, SPECIAL, strip
from quire.session import checkpointed, table


def _flat(rows) -> F.Column:
    return F.array_join(F.transform(rows, lambda r: F.array_join(F.transform(r, lambda c: F.coalesce(c, F.lit("<null>"))), "|")), "\n")


def section_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The section path of every item."""
    return classified_items(table(spark, sf_dir, "documents")).select("doc_id", "ord", F.array_join("section_path", " > ").alias("section_path"))


def merge_adjacent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged elements."""
    return merged_elements(spark, sf_dir).select("doc_id", "element_id", "element_type", "text", "page", "ord", F.array_join("section_path", " > ").alias("section_path"), "n_merged", F.size("bboxes").alias("n_boxes"))


def table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells parsed from the text of tables."""
    tables = table(spark, sf_dir, "elements").where("element_type = 'table'").select("element_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    return tables.select("element_id", _flat(el.table_rows(F.col("text"))).alias("cells"))


def typed_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of typed tables."""
    tables = table(spark, sf_dir, "elements").where("element_type = 'table' and table_rows is not null").select("element_id", "table_rows").distinct()
    return tables.select("element_id", _flat(el.typed_rows(F.col("table_rows"))).alias("cells"))


def serialize_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk tables as text."""
    rows = table(spark, sf_dir, "children").where("chunk_type = 'table'").select("child_id", "table_rows").distinct()
    return rows.select("child_id", el.serialise_rows(F.col("table_rows")).alias("table_text"))


def parent_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parents of the merged elements."""
    elements = table(spark, sf_dir, "elements")
    return nodes.parent_nodes(el.merge_adjacent(elements), el.merged_positions(elements)).withColumn("section_path", F.array_join("section_path", " > "))


def parent_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parent of every table and figure."""
    merged = checkpointed(merged_elements(spark, sf_dir))
    return nodes.parent_lookup(merged, nodes.parent_nodes(merged)).select("doc_id", "element_id", "parent_id")


def figure_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The paragraph that explains a figure."""
    return nodes.figure_context(merged_elements(spark, sf_dir)).select("doc_id", "element_id", "context")


QUERIES = {f.__name__: f for f in (section_path, merge_adjacent, table_rows, typed_table_rows, serialize_rows, parent_nodes, parent_lookup, figure_context)}

_CELLS = "array_to_string(list_transform({rows}, lambda r: array_to_string(r, '|')), chr(10))"
_LINES = f"list_filter(list_filter(list_transform(regexp_split_to_array(text, '{LINE_END}'), lambda ln: {strip('ln')}), lambda ln: ln <> ''), lambda ln: NOT regexp_full_match(ln, '[\\-:|\\s\\x0b\\x1c-\\x1f\\x{{85}}\\p{{Z}}]+'))"
_PARSED = (
    f"list_filter(list_transform({_LINES}, lambda ln: list_filter(list_transform(CASE WHEN contains(ln, '|') THEN string_split(ln, '|') WHEN contains(ln, chr(9)) THEN string_split(ln, chr(9)) "
    f"ELSE regexp_split_to_array(ln, '{SPACE}{{2,}}') END, lambda c: {strip('c')}), lambda c: c <> '')), lambda r: len(r) > 0)"
)

SQL = {
    "section_path": f"WITH {SECTIONED} SELECT doc_id, ord, array_to_string(section_path, ' > ') AS section_path FROM sectioned",
    "merge_adjacent": f"WITH {MERGED} SELECT doc_id, element_id, element_type, text, page, ord, array_to_string(section_path, ' > ') AS section_path, n_merged, len(bboxes) AS n_boxes FROM merged",
    "table_rows": f"SELECT element_id, {_CELLS.format(rows=_PARSED)} AS cells FROM (SELECT DISTINCT element_id, coalesce(text, '') AS text FROM elements WHERE element_type = 'table')",
    "typed_table_rows": f"""SELECT element_id, {_CELLS.format(rows=f"list_filter(list_transform(table_rows, lambda r: list_transform(r, lambda c: {strip("coalesce(c, '')")})), lambda r: len(list_filter(r, lambda c: c <> '')) > 0)")} AS cells
FROM (SELECT DISTINCT element_id, table_rows FROM elements WHERE element_type = 'table' AND table_rows IS NOT NULL)""",
    "serialize_rows": """SELECT child_id, coalesce(array_to_string(list_transform(list_filter(table_rows, lambda r: len(r) > 0), lambda r: array_to_string(list_transform(r, lambda c: coalesce(c, '')), ' | ')), chr(10)), '') AS table_text
FROM (SELECT DISTINCT child_id, table_rows FROM children WHERE chunk_type = 'table')""",
    "parent_nodes": f"WITH {PARENTS} SELECT doc_id, parent_id, parent_index, array_to_string(section_path, ' > ') AS section_path, section, page_start, page_end, text FROM nodes",
    "parent_lookup": f"WITH {SPECIAL} SELECT doc_id, element_id, parent_id FROM placed",
    "figure_context": f"WITH {SPECIAL} SELECT doc_id, element_id, context FROM contexts WHERE element_type = 'figure_caption'",
}
