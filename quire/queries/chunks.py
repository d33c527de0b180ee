"""Token windows, special chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import nodes
from quire.plans import corpus
from quire.queries.sqltext import SPECIAL, windows
from quire.session import checkpointed, table


def _windows(spark: SparkSession, sf_dir: str, size: int, overlap: int) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return nodes.token_windows(docs, size, overlap).select("doc_id", "chunk_index", "chunk")


def token_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 64 tokens with 16 shared, over all documents."""
    return _windows(spark, sf_dir, 64, 16)


def token_windows_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of the default size, over all documents."""
    return _windows(spark, sf_dir, corpus.CHUNK_SIZE, corpus.CHUNK_OVERLAP)


def special_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of tables and figures."""
    merged = checkpointed(corpus.merged_elements(spark, sf_dir))
    special = nodes.special_children(merged, nodes.parent_nodes(merged))
    return special.select("doc_id", "parent_id", "child_id", "chunk_type", F.array_join("section_path", " > ").alias("section_path"), "page_start", "page_end", "text")


def child_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All chunks of all documents."""
    _, _, children = corpus.nodes(spark, sf_dir)
    return children.select("doc_id", "parent_id", "child_id", "chunk_level", "chunk_type", F.array_join("section_path", " > ").alias("section_path"), "page_start", "page_end", "text", "chunk_index")


QUERIES = {f.__name__: f for f in (token_windows, token_windows_default, special_children, child_nodes)}


def _sql(size: int, overlap: int) -> str:
    return f"WITH {windows('documents', 'doc_id', size, overlap)} SELECT doc_id, chunk_index, chunk FROM win"


_CHILDREN = f"""{SPECIAL}, {windows('nodes', 'doc_id, parent_id, parent_index, section_path, section, page_start, page_end', corpus.CHUNK_SIZE, corpus.CHUNK_OVERLAP)},
kids AS (
  SELECT doc_id, parent_id, sha1(parent_id || '::text::' || chunk_index) AS child_id, 'child' AS chunk_level, 'text' AS chunk_type, section_path, section, page_start, page_end, chunk AS text, chunk_index,
    NULL::VARCHAR[][] AS table_rows, NULL AS figure_context, [0, parent_index, chunk_index] AS place FROM win
  UNION ALL
  SELECT doc_id, parent_id, sha1(parent_id || '::' || chunk_type || '::' || element_id), 'child', chunk_type, section_path, CASE WHEN len(section_path) > 0 THEN section_path[-1] ELSE 'front_matter' END, page, page, text, NULL,
    CASE WHEN chunk_type = 'table' THEN table_rows END, CASE WHEN chunk_type = 'figure' THEN context END, [1, ord, 0] FROM special)"""

SQL = {
    "token_windows": _sql(64, 16),
    "token_windows_default": _sql(corpus.CHUNK_SIZE, corpus.CHUNK_OVERLAP),
    "special_children": f"""WITH {SPECIAL} SELECT doc_id, parent_id, sha1(parent_id || '::' || chunk_type || '::' || element_id) AS child_id, chunk_type, array_to_string(section_path, ' > ') AS section_path,
  page AS page_start, page AS page_end, text FROM special""",
    "child_nodes": f"WITH {_CHILDREN} SELECT doc_id, parent_id, child_id, chunk_level, chunk_type, array_to_string(section_path, ' > ') AS section_path, page_start, page_end, text, chunk_index FROM kids",
}
