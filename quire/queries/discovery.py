"""Listing, change detection and ingest state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import file_name, suffix
from quire.operators import state
from quire.operators.metadata import with_position
from quire.plans.corpus import current_files
from quire.queries.sqltext import FILES
from quire.session import table
from quire.sources.files import kept

def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_files(table(spark, sf_dir, "parsed_documents"))


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "ingest_state")


def discover_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths with a kept suffix and no excluded component."""
    paths = table(spark, sf_dir, "ingest_state").select("relative_path").union(table(spark, sf_dir, "parsed_documents").select("metadata.relative_path")).where("relative_path is not null").distinct()
    return paths.where(kept(F.col("relative_path"))).select("relative_path", suffix(file_name(F.col("relative_path"))).alias("file_ext"))


def discover_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file's position in the order of path components."""
    return with_position(_files(spark, sf_dir).select("relative_path", "doc_id"), F.split("relative_path", "/"), "position").select("relative_path", "position")


def limit_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 100 files in path order; the limit is the operator."""
    return _files(spark, sf_dir).orderBy(F.split("relative_path", "/")).limit(100).select("relative_path", "doc_id")


def skip_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to ingest: new or changed."""
    return state.file_decisions(_files(spark, sf_dir), _state(spark, sf_dir)).where("decision <> 'unchanged'").select("relative_path", "decision")


def removed_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State rows of vanished paths."""
    return state.vanished_paths(_files(spark, sf_dir), _state(spark, sf_dir)).select("relative_path", "doc_id")


def ingest_state_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest state after the run."""
    return state.next_ingest_state(_files(spark, sf_dir), _state(spark, sf_dir)).select("relative_path", "fingerprint", "doc_id", "char_count")


def parse_run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of the run; documents below 40 characters are in none but ``discovered``."""
    decided = state.file_decisions(_files(spark, sf_dir), _state(spark, sf_dir))
    ingested = (F.col("decision") != "unchanged") & (F.col("char_count") >= 40)
    return decided.agg(
        F.count("*").alias("discovered"), F.count_if(F.col("decision") == "unchanged").alias("skipped"), F.count_if(ingested).alias("parsed"),
        F.count_if(ingested & (F.col("decision") == "new")).alias("parsed_new"), F.coalesce(F.sum(F.when(ingested, F.col("char_count"))), F.lit(0)).alias("characters"),
    )


QUERIES = {f.__name__: f for f in (discover_filter, discover_order, limit_files, skip_unchanged, removed_missing, ingest_state_next, parse_run_stats)}

SQL = {
    "discover_filter": r"""
SELECT relative_path, lower(regexp_extract(string_split(relative_path, '/')[-1], '^.+(\.[^.]+)$', 1)) AS file_ext
FROM (SELECT relative_path FROM ingest_state UNION SELECT metadata.relative_path FROM parsed_documents)
WHERE relative_path IS NOT NULL AND lower(regexp_extract(string_split(relative_path, '/')[-1], '^.+(\.[^.]+)$', 1)) IN ('.pdf', '.md', '.txt')
  AND NOT list_has_any(string_split(relative_path, '/'), ['.git', '.venv', 'node_modules', '__pycache__'])""",
    "discover_order": f"WITH {FILES} SELECT relative_path, row_number() OVER (ORDER BY string_split(relative_path, '/'), doc_id) AS position FROM files",
    "limit_files": f"WITH {FILES} SELECT relative_path, doc_id FROM files ORDER BY string_split(relative_path, '/') LIMIT 100",
    "skip_unchanged": f"WITH {FILES} SELECT relative_path, decision FROM decided WHERE decision <> 'unchanged'",
    "removed_missing": f"WITH {FILES} SELECT relative_path, doc_id FROM state WHERE relative_path NOT IN (SELECT relative_path FROM files)",
    "ingest_state_next": f"""WITH {FILES}
SELECT relative_path, fingerprint, doc_id, char_count FROM decided WHERE decision <> 'unchanged'
UNION ALL SELECT s.relative_path, s.fingerprint, s.doc_id, s.char_count FROM state s JOIN decided d USING (relative_path) WHERE d.decision = 'unchanged'""",
    "parse_run_stats": f"""WITH {FILES}
SELECT count(*) AS discovered, count(*) FILTER (decision = 'unchanged') AS skipped, count(*) FILTER (decision <> 'unchanged' AND char_count >= 40) AS parsed,
  count(*) FILTER (decision = 'new' AND char_count >= 40) AS parsed_new, CAST(coalesce(sum(char_count) FILTER (decision <> 'unchanged' AND char_count >= 40), 0) AS BIGINT) AS characters
FROM decided""",
}
