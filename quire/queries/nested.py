"""Nested records as flat tables (problem 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import flatten
from quire.session import checkpointed, table


def _tables(lines: DataFrame, key: str) -> dict[str, DataFrame]:
    inlining = flatten.shared_inlining(flatten.schema_graph(lines))
    # Written once, as every table is cut out of the same rows.
    return flatten.document_tables(checkpointed(flatten.shred(lines, inlining, key)))


def _lines(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _tables(table(spark, sf_dir, "parsed_jsonl"), "line_no")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The objects of every raw record and what they belong to."""
    return flatten.links(_lines(spark, sf_dir)).withColumnRenamed("record", "line_no")


def p2_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema graph of the raw records."""
    return flatten.schema_graph(table(spark, sf_dir, "parsed_jsonl"))


def p2_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of elements."""
    return _lines(spark, sf_dir)["elements"]


def p2_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of boxes."""
    return _lines(spark, sf_dir)["boxes"]


def p2_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of cell rows."""
    return _lines(spark, sf_dir)["rows"]


def p2_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of parents."""
    return _lines(spark, sf_dir)["parents"]


def p2_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of children."""
    return _lines(spark, sf_dir)["children"]


def p2_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The objects of every nested document, by the same operator over the rows written as JSON."""
    docs = table(spark, sf_dir, "parsed_documents")
    lines = docs.select("record_id", F.to_json(F.struct("doc_id", "metadata", "elements", "parent_nodes", "child_nodes")).alias("line"))
    return flatten.links(_tables(lines, "record_id")).withColumnRenamed("record", "record_id")


QUERIES = {f.__name__: f for f in (p2_found, p2_graph, p2_elements, p2_boxes, p2_rows, p2_parents, p2_children, p2_documents)}

SQL = {
    "p2_documents": """
WITH els AS (SELECT record_id, coalesce(doc_id, '') AS doc_id, unnest(elements) AS e FROM parsed_documents),
pars AS (SELECT record_id, coalesce(doc_id, '') AS doc_id, unnest(parent_nodes) AS p FROM parsed_documents),
kids AS (SELECT record_id, unnest(child_nodes) AS c FROM parsed_documents),
boxes AS (SELECT record_id, e.element_id AS id, unnest(range(0, len(e.metadata.bboxes))) AS i, unnest(e.metadata.bboxes) AS b FROM els),
cells AS (SELECT record_id, e.element_id AS id, unnest(range(0, len(e.metadata.table_rows))) AS i, unnest(e.metadata.table_rows) AS r FROM els)
SELECT DISTINCT record_id, 'element' AS entity, e.element_id AS entity_id, doc_id AS link_id FROM els WHERE coalesce(e.element_id, '') <> ''
UNION SELECT record_id, 'bbox', id || '#' || i, id FROM boxes WHERE coalesce(id, '') <> '' AND b.l IS NOT NULL AND b.t IS NOT NULL AND b.r IS NOT NULL AND b.b IS NOT NULL
UNION SELECT record_id, 'row', id || '#' || i, id FROM cells WHERE coalesce(id, '') <> '' AND r IS NOT NULL
UNION SELECT record_id, 'parent', p.parent_id, doc_id FROM pars WHERE coalesce(p.parent_id, '') <> ''
UNION SELECT record_id, 'child', c.child_id, coalesce(c.parent_id, '') FROM kids WHERE coalesce(c.child_id, '') <> ''""",
}
