"""The index diff as a stream: chunk files that arrive are compared with the last state, batch by batch.

Files are consumed with ``availableNow``, so a run takes what is there and ends. A document's chunks may lie in several files and
batches, so a batch says only what is new or changed; points are merged into the state one by one. What is gone
is found by :func:`retire`, a full pass over the documents' current chunks. The state is a versioned snapshot, written after
the changes, and a batch that is run again after a crash finds its own changes as unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators import state
from quire.plans.run import INDEX_STATE
from quire.session import checkpointed
from quire.sources.jsonl import Snapshots


def diff_stream(spark: SparkSession, folder: str, schema: T.StructType, state_dir: str, changes_dir: str, checkpoint_dir: str, files_per_batch: int = 100):
    """Start the stream over parquet files of chunks; changes go to ``changes_dir`` by batch. Returns the running query."""
    snapshots = Snapshots(spark, state_dir, INDEX_STATE)

    def step(chunks: DataFrame, batch: int) -> None:
        rows = checkpointed(chunks)
        before = checkpointed(snapshots.read())
        changed = state.index_diff(rows, before).where("status in ('new', 'changed')")
        changed.write.mode("overwrite").parquet(f"{changes_dir}/batch={batch}")
        points = state.current_points(rows)
        kept = state.latest_index_state(before).join(points.select("doc_id", "point_id"), ["doc_id", "point_id"], "left_anti")
        snapshots.write(kept.unionByName(points.withColumn("updated_at", F.current_timestamp())))

    chunks = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    return chunks.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()


def retire(spark: SparkSession, chunks: DataFrame, state_dir: str) -> DataFrame:
    """doc_id, point_id of the points that the documents in ``chunks``, which has all their current chunks, no longer have; they leave the state."""
    snapshots = Snapshots(spark, state_dir, INDEX_STATE)
    before = checkpointed(snapshots.read())
    stale = checkpointed(state.index_diff(chunks, before).where("status = 'stale'").select("doc_id", "point_id"))
    snapshots.write(before.join(stale, ["doc_id", "point_id"], "left_anti"))
    return stale
