"""The index diff as a stream."""

from pyspark.sql import types as T

from quire.plans.run import INDEX_STATE
from quire.sources.jsonl import Snapshots
from quire.streaming.incremental import diff_stream, retire

_S, _I = T.StringType(), T.IntegerType()
SCHEMA = T.StructType([T.StructField(n, k) for n, k in (("doc_id", _S), ("child_id", _S), ("chunk_type", _S), ("section_path", T.ArrayType(_S)), ("page_start", _I), ("page_end", _I), ("text", _S))])


def chunks(spark, rows):
    return spark.createDataFrame([(d, c, "text", [], 1, 1, t) for d, c, t in rows], SCHEMA)


def test_batches_build_on_each_other(spark, tmp_path):
    folder, state, changes, checkpoint = (str(tmp_path / n) for n in ("in", "state", "changes", "checkpoint"))

    def arrive(rows):
        chunks(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        diff_stream(spark, folder, SCHEMA, state, changes, checkpoint).awaitTermination(120)

    arrive([("a", "1", "x"), ("a", "2", "y"), ("b", "1b", "z")])
    arrive([("a", "1", "x"), ("a", "2", "changed")])
    # The rest of a document in another file retires nothing.
    arrive([("a", "3", "more")])
    got = sorted((r.batch, r.status) for r in spark.read.parquet(changes).collect())
    assert got == [(0, "new")] * 3 + [(1, "changed"), (2, "new")]
    assert Snapshots(spark, state, INDEX_STATE).read().count() == 4
    assert retire(spark, chunks(spark, [("a", "1", "x"), ("a", "3", "more")]), state).count() == 1
    assert Snapshots(spark, state, INDEX_STATE).read().count() == 3
