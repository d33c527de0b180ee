"""Incremental state, diffs and idempotency."""

from datetime import datetime

from pyspark.sql import functions as F

from quire.functions.text import content_hash, point_id
from quire.operators import state

T1, T2 = datetime(2025, 1, 1), datetime(2025, 2, 1)
STATE = "relative_path string, fingerprint string, doc_id string, char_count bigint, last_ingested_at timestamp"
FILES = "relative_path string, fingerprint string, doc_id string, char_count bigint, ingested_at timestamp"
CHILDREN = "doc_id string, parent_id string, child_id string, chunk_level string, chunk_type string, section_path array<string>, page_start int, page_end int, text string, chunk_index int"
INDEX = "doc_id string, point_id string, content_hash string, updated_at timestamp"


def test_file_decisions_and_next_state(spark):
    old = spark.createDataFrame(
        [("a", "1", "da", 1, T1), ("a", "0", "da", 1, T2), ("b", "1", "db", 1, None), ("gone", "1", "dg", 1, T1), ("n", None, "dn", 1, T1), (None, "1", "dx", 1, T1)], STATE
    )
    files = spark.createDataFrame([("a", "1", "da", 5, T2), ("b", "1", "db", 5, T2), ("new", "1", "dn", 5, T2), ("n", "1", "dn", 5, T2)], FILES)
    assert {r.relative_path: r.decision for r in state.file_decisions(files, old).collect()} == {"a": "changed", "b": "unchanged", "new": "new", "n": "changed"}
    assert [r.relative_path for r in state.vanished_paths(files, old).collect()] == ["gone"]
    after = state.next_ingest_state(files, old)
    assert {r.relative_path for r in after.collect()} == {"a", "b", "new", "n"}
    assert {r.relative_path for r in state.next_ingest_state(files, old, keep_vanished=True).collect()} == {"a", "b", "new", "n", "gone"}
    assert state.file_decisions(files, after).where("decision <> 'unchanged'").count() == 0


def chunk(doc, child, text):
    return (doc, "p", child, "child", "text", ["s"], 1, 1, text, 1)


def hashes(spark, rows):
    df = spark.createDataFrame(rows, "doc_id string, child_id string, text string")
    return {(r[0], r[1]): (r[2], r[3]) for r in df.select("doc_id", "child_id", point_id(F.col("child_id")), content_hash(F.col("text"), F.lit("text"), F.col("doc_id"))).collect()}


def test_index_diff_and_idempotency(spark):
    h = hashes(spark, [("d1", "same", "t"), ("d1", "changed", "old"), ("d1", "gone", "x"), ("d2", "kept", "y")])
    old = spark.createDataFrame([(d, *h[d, c], T1) for d, c in h], INDEX)
    children = spark.createDataFrame([chunk("d1", "same", "t"), chunk("d1", "same", "t"), chunk("d1", "changed", "new"), chunk("d1", "added", "z"), chunk("d1", "blank", " "), chunk("d1", None, "no id"), chunk(None, "x", "y")], CHILDREN)
    status = {r.point_id: r.status for r in state.index_diff(children, old).collect()}
    assert sorted(status.values()) == ["changed", "new", "new", "stale", "unchanged"]
    assert status[h["d1", "gone"][0]] == "stale" and h["d2", "kept"][0] not in status
    everything = {r.point_id: r.status for r in state.index_diff(children, old, delete_missing_docs=True).collect()}
    assert everything[h["d2", "kept"][0]] == "stale"
    after = state.next_index_state(children, old).withColumn("updated_at", F.lit(T2).cast("timestamp"))
    assert after.where("doc_id = 'd2'").count() == 1
    assert {r.status for r in state.index_diff(children, after).collect()} == {"unchanged"}


def test_vector_table(spark):
    points = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "point_id string, v int")
    fresh = spark.createDataFrame([("b", 2), ("d", 2), ("a", 2)], "point_id string, v int")
    diff = spark.createDataFrame([("a", "unchanged"), ("b", "changed"), ("c", "stale"), ("d", "new")], "point_id string, status string")
    assert {(r.point_id, r.v) for r in state.next_vector_table(points, diff, fresh).collect()} == {("a", 1), ("b", 2), ("d", 2)}


def test_empty_tables(spark):
    children, old = spark.createDataFrame([], CHILDREN), spark.createDataFrame([], INDEX)
    assert state.index_diff(children, old).count() == state.next_index_state(children, old).count() == 0
