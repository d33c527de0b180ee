"""Corpus reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import report
from quire.plans import corpus
from quire.queries.chunks import _CHILDREN
from quire.queries.sqltext import tokens
from quire.session import table

CONFIGS = [("C1", 512, 64), ("C2", 800, 120), ("C3", 1024, 160), ("C4", 800, 0)]


def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the documents in elements, parents, children, pages and characters."""
    merged, counts = corpus.sizes(spark, sf_dir)
    pages = merged.groupBy("doc_id").agg(F.count("*").alias("elements"), (F.max("page") - F.min("page") + 1).alias("page_span"), F.sum("n_chars").alias("char_count"))
    per_doc = pages.join(counts, "doc_id", "left")
    return report.describe(per_doc, ["elements", "page_span", "char_count", "parents", "children"])


def special_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of tables and figures that have a chunk of their own."""
    merged, _, children = corpus.nodes(spark, sf_dir)
    special = merged.where("element_type in ('table', 'figure_caption')").agg(F.count("*").alias("n_special"))
    chunks = children.agg(F.count_if(F.col("chunk_type") != "text").alias("n_special_chunks"), F.count("*").alias("n_chunks"))
    return special.join(chunks, F.lit(True)).withColumn("coverage", F.round(F.col("n_special_chunks") / F.greatest(F.col("n_special"), F.lit(1)), 6))


def chunk_robustness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and size of the text chunks of all parents under four configurations."""
    return report.robustness(table(spark, sf_dir, "parents").select("text"), CONFIGS)


def chunk_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks by type over the whole pipeline; the flagship."""
    _, _, children = corpus.nodes(spark, sf_dir)
    return children.groupBy("chunk_type").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("n_chars"))


QUERIES = {f.__name__: f for f in (corpus_stats, special_coverage, chunk_robustness, chunk_types)}


def _metric(name: str) -> str:
    return f"SELECT '{name}' AS metric, count({name}) AS n, round(avg({name}), 6) AS mean, round(stddev_samp({name}), 6) AS std, CAST(min({name}) AS DOUBLE) AS min, CAST(max({name}) AS DOUBLE) AS max FROM per_doc"


def _config(name: str, size: int, overlap: int) -> str:
    step = size - overlap
    windows = f"SELECT least({size}, n - i * {step}) AS t FROM (SELECT n, unnest(range(0, CASE WHEN n = 0 THEN 0 WHEN n <= {size} THEN 1 ELSE CAST(ceil((n - {size}) / {step}.0) AS BIGINT) + 1 END)) AS i FROM sizes)"
    return f"SELECT '{name} {size}/{overlap}' AS config, count(*) AS n_chunks, round(avg(t), 6) AS mean_tokens, round(quantile_cont(CAST(t AS DOUBLE), 0.95), 6) AS p95_tokens FROM ({windows}) HAVING count(*) > 0"


SQL = {
    "corpus_stats": f"""WITH {_CHILDREN},
per_doc AS (
  SELECT * FROM (SELECT doc_id, count(*) AS elements, max(page) - min(page) + 1 AS page_span, CAST(sum(length(text)) AS BIGINT) AS char_count FROM merged GROUP BY 1)
  LEFT JOIN (SELECT doc_id, count(*) AS parents FROM nodes GROUP BY 1) USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS children FROM kids GROUP BY 1) USING (doc_id))
""" + " UNION ALL ".join(map(_metric, ("elements", "page_span", "char_count", "parents", "children"))),
    "special_coverage": f"""WITH {_CHILDREN}
SELECT n_special, n_special_chunks, n_chunks, round(n_special_chunks / greatest(n_special, 1), 6) AS coverage
FROM (SELECT count(*) AS n_special FROM merged WHERE element_type IN ('table', 'figure_caption')), (SELECT count(*) FILTER (chunk_type <> 'text') AS n_special_chunks, count(*) AS n_chunks FROM kids)""",
    "chunk_robustness": f"WITH sizes AS (SELECT len({tokens(chr(34) + 'tx' + chr(34))}) AS n FROM (SELECT coalesce(text, '') AS tx FROM parents)) " + " UNION ALL ".join(_config(*c) for c in CONFIGS),
    "chunk_types": f"WITH {_CHILDREN} SELECT chunk_type, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM kids GROUP BY 1",
}
