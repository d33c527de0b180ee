"""Exact nearest neighbours of a set of query vectors, block against block.

Rows are spread over blocks of about ``BLOCK`` vectors by a hash of their id, and every block is sent all queries, which a task
meets in a stream: it holds one block of rows, compares a few hundred queries at a time in one matrix product and keeps the best ``k`` of each.
The final ``k`` are ranked from those. No key holds more than a block's rows, however many of them have one width.

Defined results. Null vectors, vectors of another length than the query's and vectors with null entries are left out.
Scores are rounded to six digits and ties go to the smaller id. The cosine with a zero vector is 0. Repeated ids count as often as they occur.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096
#: Queries that meet a block at once.
QUERIES = 256
#: Distances of which a smaller value is nearer.
ASCENDING = ("euclid", "manhattan")


def _scores(distance: str, q: np.ndarray, x: np.ndarray) -> np.ndarray:
    if distance == "manhattan":
        return np.stack([np.abs(x - row).sum(axis=1) for row in q])
    dots = q @ x.T
    if distance == "dot":
        return dots
    if distance == "euclid":
        return np.stack([np.sqrt(((x - row) ** 2).sum(axis=1)) for row in q])
    norms = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1)[None]
    return np.where(norms > 0, dots / np.where(norms > 0, norms, 1), 0.0)


def _vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id and v of the rows with whole vectors."""
    whole = df.where(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull() & (F.size(vec_col) > 0) & ~F.exists(vec_col, lambda x: x.isNull()))
    kind = df.schema[vec_col].dataType.simpleString()
    return whole.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast(kind if kind in ("array<float>", "array<double>") else "array<double>").alias("v"))


def _matrices(ids: np.ndarray, vectors: pa.ListArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors by width."""
    widths = vectors.value_lengths().to_numpy()
    out = {}
    for width in np.unique(widths):
        at = np.nonzero(widths == width)[0]
        flat = vectors.take(pa.array(at)).flatten().to_numpy().astype("<f8")
        out[int(width)] = (ids[at], flat.reshape(len(at), width))
    return out


def _best(distance: str, k: int, asked: tuple[np.ndarray, np.ndarray], kept: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    sign = 1 if distance in ASCENDING else -1
    (q_ids, q), (ids, x) = asked, kept
    for at in range(0, len(q_ids), QUERIES):
        scores = np.round(_scores(distance, q[at : at + QUERIES], x), 6) + 0.0
        for q_id, line in zip(q_ids[at : at + QUERIES], scores):
            line = np.where(ids == q_id, np.inf * sign, line)
            near = np.lexsort((ids, sign * line))[:k]
            near = near[np.isfinite(line[near])]
            yield np.full(len(near), q_id), ids[near], line[near]


def _nearest(distance: str, k: int):
    """The best of each block for each query, of a partition sorted by block and role, rows before queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, kept = None, [], None
        for batch in batches:
            keys = batch.column(0).to_numpy() * 2 + batch.column(1).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.nonzero(np.diff(keys))[0] + 1).tolist(), len(keys)]
            found = []
            for start, stop in zip(cuts, cuts[1:]):
                if start == stop:
                    continue
                part, asks = divmod(int(keys[start]), 2)
                if part != block:
                    block, parts, kept = part, [], None
                piece = (batch.column(2).slice(start, stop - start).to_numpy(), batch.column(3).slice(start, stop - start))
                if not asks:
                    parts.append(piece)
                    continue
                if kept is None:
                    kept = _matrices(np.concatenate([p[0] for p in parts]), pa.concat_arrays([p[1] for p in parts])) if parts else {}
                for width, asked in _matrices(*piece).items():
                    if width in kept:
                        found += _best(distance, k, asked, kept[width])
            columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "neighbour_id", "score"])

    return run


def nearest(queries: DataFrame, rows: DataFrame, distance: str, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, neighbour_id, score, rank: the k nearest other rows of every query."""
    if distance not in ("cosine", "dot", *ASCENDING):
        raise ValueError(f"unknown distance: {distance}")
    blocks = max(1, math.ceil(rows.count() / BLOCK))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    stored = _vectors(rows, id_col, vec_col).select(block.alias("block"), F.lit(False).alias("asks"), "id", "v")
    asking = _vectors(queries, id_col, vec_col).select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(True).alias("asks"), "id", "v")
    met = stored.unionAll(asking).repartition("block").sortWithinPartitions("block", "asks")
    score = F.asc("score") if distance in ASCENDING else F.desc("score")
    best = Window.partitionBy("query_id").orderBy(score, "neighbour_id")
    return met.mapInArrow(_nearest(distance, k), "query_id bigint, neighbour_id bigint, score double").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
