"""Incremental runs: which files, chunks and points are new, changed, unchanged or gone.

State tables are snapshots. A next snapshot is computed from the old one and the current rows; the caller writes it
after the outputs, so that a crash in between repeats work instead of losing it.

Defined results. Of several state rows of a path (or point) the latest counts, the greatest fingerprint among equal
times; null paths and points are ignored. A null fingerprint differs from every other. A chunk whose text is null or blank is skipped.
Of several current rows of a point the greatest hash counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import content_hash, field_hash, point_id, strip


# Files against the ingest state

def latest_ingest_state(state: DataFrame) -> DataFrame:
    """One row for each path."""
    rank = F.struct(F.coalesce("last_ingested_at", F.lit("0001-01-01").cast("timestamp")), F.coalesce("fingerprint", F.lit("")))
    row = F.struct("fingerprint", "doc_id", "char_count", "last_ingested_at")
    return state.where("relative_path is not null").groupBy("relative_path").agg(F.max_by(row, rank).alias("r")).select("relative_path", "r.*")


def file_decisions(files: DataFrame, state: DataFrame) -> DataFrame:
    """``files`` (relative_path, fingerprint, ...) with ``decision``: new, changed or unchanged."""
    old = latest_ingest_state(state).select("relative_path", F.col("fingerprint").alias("old_fingerprint"), F.lit(True).alias("known"))
    same = F.col("old_fingerprint") == F.col("fingerprint")
    decision = F.when(F.col("known").isNull(), "new").when(F.coalesce(same, F.lit(False)), "unchanged").otherwise("changed")
    return files.join(old, "relative_path", "left").withColumn("decision", decision).drop("known")


def vanished_paths(files: DataFrame, state: DataFrame) -> DataFrame:
    """State rows whose path is no longer listed."""
    return latest_ingest_state(state).join(files.select("relative_path"), "relative_path", "left_anti")


def next_ingest_state(files: DataFrame, state: DataFrame, keep_vanished: bool = False) -> DataFrame:
    """The state after ingesting all new and changed files; vanished paths go unless the listing was limited."""
    done = file_decisions(files, state).where("decision <> 'unchanged'")
    written = done.select("relative_path", "fingerprint", "doc_id", "char_count", F.col("ingested_at").alias("last_ingested_at"))
    kept = latest_ingest_state(state).join(done.select("relative_path"), "relative_path", "left_anti")
    if not keep_vanished:
        kept = kept.join(files.select("relative_path"), "relative_path", "left_semi")
    return kept.unionByName(written)


# Chunks against the index state

def fallback_child_id(df: DataFrame) -> DataFrame:
    """``df`` whose null or blank child ids become a hash of document, section, type, pages and text."""
    blank = F.coalesce(strip(F.col("child_id")), F.lit("")) == ""
    own = F.sha1(F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "chunk_type", "page_start", "page_end", "text")), F.array_join(F.coalesce("section_path", F.array().cast("array<string>")), ".")))
    return df.withColumn("child_id", F.when(blank, own).otherwise(F.col("child_id")))


def indexable() -> Column:
    """Whether a chunk has text and a document."""
    return (strip(F.coalesce("text", F.lit(""))) != "") & F.col("doc_id").isNotNull()


def current_points(children: DataFrame) -> DataFrame:
    """doc_id, point_id, content_hash of all chunks that can be indexed, one row for each point."""
    usable = fallback_child_id(children).where(indexable())
    hashed = usable.select("doc_id", point_id(F.col("child_id")).alias("point_id"), content_hash(F.col("text"), F.coalesce("chunk_type", F.lit("")), F.col("doc_id")).alias("content_hash"))
    return hashed.groupBy("doc_id", "point_id").agg(F.max("content_hash").alias("content_hash"))


#: What a point carries besides text and vector: the base keys, then all keys of a chunk's own metadata.
PAYLOAD = {
    "doc_id": "string", "parent_id": "string", "chunk_type": "string", "chunk_level": "string", "page_start": "int", "page_end": "int", "section_path": "array<string>", "relative_path": "string", "title": "string", "topic": "string",
    "paper_title": "string", "authors": "array<string>", "year": "int", "section": "string", "chunk_index": "int", "table_rows": "array<array<string>>", "figure_context": "string",
}


def point_payload(children: DataFrame, parents: DataFrame, documents: DataFrame) -> DataFrame:
    """doc_id, point_id, text, payload of all chunks that can be indexed, one row for each point, as in ``current_points``.

    Of each key the chunk's value counts, else its parent's, else the document's. Of several rows of a chunk's point the
    one with the greatest hash counts, then the greatest fields; of several of a parent or document the greatest fields.
    """
    keys = {"parent": ["doc_id", "parent_id"], "document": ["doc_id"]}
    given = {"parent": ["section", "paper_title", "authors", "year"], "document": ["relative_path", "title", "topic", "paper_title", "authors", "year"]}
    rows = fallback_child_id(children).where(indexable())
    own = F.struct(*(F.col(c).cast(PAYLOAD[c]).alias(c) for c in PAYLOAD if c in children.columns))
    digest = content_hash(F.col("text"), F.coalesce("chunk_type", F.lit("")), F.col("doc_id"))
    out = rows.groupBy("doc_id", point_id(F.col("child_id")).alias("point_id")).agg(F.max(F.struct(digest.alias("digest"), "text", own.alias("chunk"))).alias("r")).select("doc_id", "point_id", "r.text", "r.chunk", "r.chunk.parent_id")
    for level, table in (("parent", parents), ("document", documents)):
        fields = [F.col(c).cast(PAYLOAD[c]).alias(c) for c in given[level] if c in table.columns]
        out = out.join(table.groupBy(*keys[level]).agg(F.max(F.struct(*fields)).alias(level)), keys[level], "left")
        given[level] = [c for c in given[level] if c in table.columns]
    given["chunk"] = [c for c in PAYLOAD if c in children.columns]
    values = [F.coalesce(*(F.col(f"{level}.{c}") for level in ("chunk", "parent", "document") if c in given[level]), F.lit(None).cast(kind)).alias(c) for c, kind in PAYLOAD.items()]
    return out.select("doc_id", "point_id", "text", F.struct(*values).alias("payload"))


def latest_index_state(state: DataFrame) -> DataFrame:
    """One row for each document and point."""
    rank = F.struct(F.coalesce("updated_at", F.lit("0001-01-01").cast("timestamp")), F.coalesce("content_hash", F.lit("")))
    return (
        state.where("doc_id is not null and point_id is not null").groupBy("doc_id", "point_id")
        .agg(F.max_by("content_hash", rank).alias("content_hash"), F.max("updated_at").alias("updated_at"))
    )


def index_diff(children: DataFrame, state: DataFrame, delete_missing_docs: bool = False) -> DataFrame:
    """doc_id, point_id, old_hash, new_hash, status: new, changed, unchanged or stale.

    Only points of documents among ``children`` can be stale, unless ``delete_missing_docs`` is set.
    """
    new = current_points(children).withColumnRenamed("content_hash", "new_hash")
    old = latest_index_state(state).select("doc_id", "point_id", F.col("content_hash").alias("old_hash"), F.lit(True).alias("known"))
    if not delete_missing_docs:
        old = old.join(children.select("doc_id").distinct(), "doc_id", "left_semi")
    status = (
        F.when(F.col("new_hash").isNull(), "stale").when(F.col("known").isNull(), "new")
        .when(F.coalesce(F.col("old_hash") == F.col("new_hash"), F.lit(False)), "unchanged").otherwise("changed")
    )
    return new.join(old, ["doc_id", "point_id"], "full").select("doc_id", "point_id", "old_hash", "new_hash", status.alias("status"))


def next_index_state(children: DataFrame, state: DataFrame) -> DataFrame:
    """Documents among ``children`` get their current points, others keep theirs."""
    kept = latest_index_state(state).join(children.select("doc_id").distinct(), "doc_id", "left_anti")
    return kept.select("doc_id", "point_id", "content_hash").unionByName(current_points(children))


def next_vector_table(points: DataFrame, diff: DataFrame, fresh: DataFrame) -> DataFrame:
    """``points`` without those that are stale or written anew, and the ``fresh`` ones; both have point_id."""
    gone = diff.where("status in ('stale', 'new', 'changed')").select("point_id")
    return points.join(gone, "point_id", "left_anti").unionByName(fresh.join(diff.where("status in ('new', 'changed')").select("point_id"), "point_id", "left_semi"))


def row_identity(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with ``row_hash`` over the named columns."""
    return df.withColumn("row_hash", field_hash(*(F.col(c) for c in columns)))
