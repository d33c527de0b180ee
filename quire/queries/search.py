"""Exact nearest neighbours: queries are all rows whose id is divisible by 50."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.search import nearest
from quire.session import table

K = 10


def _knn(spark: SparkSession, sf_dir: str, distance: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows.where(F.col("vec_id") % 50 == 0), rows, distance, K)


def knn_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By cosine."""
    return _knn(spark, sf_dir, "cosine")


def knn_dot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By inner product."""
    return _knn(spark, sf_dir, "dot")


def knn_euclid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By Euclidean distance."""
    return _knn(spark, sf_dir, "euclid")


def knn_manhattan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By Manhattan distance."""
    return _knn(spark, sf_dir, "manhattan")


QUERIES = {f.__name__: f for f in (knn_cosine, knn_dot, knn_euclid, knn_manhattan)}


def _sql(score: str, order: str) -> str:
    return f"""WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL),
s AS (SELECT q.vec_id AS query_id, x.vec_id AS neighbour_id, round({score}, 6) + 0.0 AS score FROM v q JOIN v x ON q.vec_id % 50 = 0 AND q.vec_id <> x.vec_id AND len(q.e) = len(x.e))
SELECT query_id, neighbour_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score {order}, neighbour_id) AS rank FROM s) WHERE rank <= {K}"""


SQL = {
    "knn_cosine": _sql("list_cosine_similarity(q.e, x.e)", "DESC"),
    "knn_dot": _sql("list_inner_product(q.e, x.e)", "DESC"),
    "knn_euclid": _sql("list_distance(q.e, x.e)", "ASC"),
    "knn_manhattan": _sql("list_sum(list_transform(list_zip(q.e, x.e), lambda p: abs(p[1] - p[2])))", "ASC"),
}
