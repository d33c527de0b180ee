"""Points, hashes, and the diff against the index state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as tx
from quire.operators import state
from quire.plans.corpus import latest_texts
from quire.queries.sqltext import POINTS, strip, uuid5
from quire.session import table


def _children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "children")


def blank_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks that cannot be indexed, by type."""
    blank = tx.strip(F.coalesce("text", F.lit(""))) == ""
    return _children(spark, sf_dir).where(blank).groupBy("chunk_type").agg(F.count("*").alias("n_blank"))


def point_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The point of every chunk, and of its parent."""
    known = _children(spark, sf_dir).where("child_id is not null").select("child_id", "parent_id").distinct()
    return known.select("child_id", tx.point_id(F.col("child_id")).alias("point_id"), tx.point_id(F.col("parent_id")).alias("parent_point_id"))


def point_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base keys of every point as columns, a row for each that occurs; ``point_payload`` has all keys."""
    docs = latest_texts(table(spark, sf_dir, "parsed_documents")).select("doc_id", F.col("metadata.relative_path").alias("relative_path"), F.col("metadata.title").alias("title"), F.col("metadata.topic").alias("topic"))
    usable = state.fallback_child_id(_children(spark, sf_dir).where(tx.strip(F.coalesce("text", F.lit(""))) != "").where("doc_id is not null"))
    rows = usable.select(
        "doc_id", tx.point_id(F.col("child_id")).alias("point_id"), "parent_id", "chunk_type", "chunk_level", "page_start", "page_end",
        F.array_join("section_path", " > ").alias("section_path"), "chunk_index",
    ).distinct()
    return rows.join(docs, "doc_id", "left")


def point_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All metadata of every point: the chunk's own values, then its parent's, then the document's; lists as text."""
    docs = latest_texts(table(spark, sf_dir, "parsed_documents")).select("doc_id", "metadata.relative_path", "metadata.title", "metadata.topic", "metadata.paper_title", "metadata.authors", "metadata.year")
    rows = state.point_payload(_children(spark, sf_dir), table(spark, sf_dir, "parents"), docs).select("point_id", "payload.*")
    lists = {"section_path": F.array_join("section_path", " > "), "authors": F.array_join("authors", "; "), "table_rows": F.array_join(F.transform("table_rows", lambda r: F.array_join(r, " | ", "")), "\n")}
    return rows.withColumns(lists)


def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The content hash of every point."""
    return state.current_points(_children(spark, sf_dir))


def _diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.index_diff(_children(spark, sf_dir), table(spark, sf_dir, "index_state"))


def index_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every point of the loaded documents with its status."""
    return _diff(spark, sf_dir)


def stale_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points to delete."""
    return _diff(spark, sf_dir).where("status = 'stale'").select("doc_id", "point_id")


def index_state_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index state after the run."""
    return state.next_index_state(_children(spark, sf_dir), table(spark, sf_dir, "index_state"))


def vector_table_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector table after the run: kept points with their old hash, written points with their new one."""
    old = state.latest_index_state(table(spark, sf_dir, "index_state")).groupBy("point_id").agg(F.max("content_hash").alias("content_hash"))
    fresh = state.current_points(_children(spark, sf_dir)).groupBy("point_id").agg(F.max("content_hash").alias("content_hash"))
    return state.next_vector_table(old, _diff(spark, sf_dir), fresh)


def index_run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of the run."""
    blank = _children(spark, sf_dir).where(tx.strip(F.coalesce("text", F.lit(""))) == "").agg(F.count("*").alias("n_blank"))
    count = lambda s: F.count_if(F.col("status").isin(*s))
    counts = _diff(spark, sf_dir).agg(count(["new", "changed"]).alias("upserted"), count(["unchanged"]).alias("n_same"), count(["stale"]).alias("deleted"))
    return counts.join(blank, F.lit(True)).select("upserted", (F.col("n_same") + F.col("n_blank")).alias("skipped"), "deleted")


QUERIES = {f.__name__: f for f in (blank_children, point_ids, point_metadata, point_payload, content_hash, index_diff, stale_points, index_state_next, vector_table_next, index_run_stats)}

_BLANK = strip("coalesce(text, '')") + " = ''"

SQL = {
    "blank_children": f"SELECT chunk_type, count(*) AS n_blank FROM children WHERE {_BLANK} GROUP BY 1",
    "point_ids": f"SELECT child_id, {uuid5('child_id')} AS point_id, {uuid5('parent_id')} AS parent_point_id FROM (SELECT DISTINCT child_id, parent_id FROM children WHERE child_id IS NOT NULL)",
    "point_metadata": f"""WITH {POINTS}
SELECT DISTINCT i.doc_id, point_id, parent_id, chunk_type, chunk_level, page_start, page_end, array_to_string(section_path, ' > ') AS section_path, chunk_index, relative_path, title, topic
FROM ids i LEFT JOIN (
  SELECT doc_id, m.relative_path AS relative_path, m.title AS title, m.topic AS topic
  FROM (SELECT doc_id, metadata AS m, row_number() OVER (PARTITION BY doc_id ORDER BY exported_at DESC NULLS LAST, record_id DESC) AS n FROM parsed_documents) WHERE n = 1) d ON d.doc_id = i.doc_id""",
    "content_hash": f"WITH {POINTS} SELECT doc_id, point_id, content_hash FROM points",
    "index_diff": f"WITH {POINTS} SELECT doc_id, point_id, old_hash, new_hash, status FROM diff",
    "stale_points": f"WITH {POINTS} SELECT doc_id, point_id FROM diff WHERE status = 'stale'",
    "index_state_next": f"WITH {POINTS} SELECT doc_id, point_id, content_hash FROM old WHERE doc_id NOT IN (SELECT doc_id FROM loaded WHERE doc_id IS NOT NULL) UNION ALL SELECT doc_id, point_id, content_hash FROM points",
    "vector_table_next": f"""WITH {POINTS}
SELECT point_id, max(content_hash) AS content_hash FROM old WHERE point_id NOT IN (SELECT point_id FROM diff WHERE status <> 'unchanged') GROUP BY 1
UNION ALL SELECT point_id, max(content_hash) FROM points WHERE point_id IN (SELECT point_id FROM diff WHERE status IN ('new', 'changed')) GROUP BY 1""",
    "index_run_stats": f"""WITH {POINTS}
SELECT count(*) FILTER (status IN ('new', 'changed')) AS upserted, count(*) FILTER (status = 'unchanged') + (SELECT count(*) FROM children WHERE {_BLANK}) AS skipped, count(*) FILTER (status = 'stale') AS deleted FROM diff""",
}
