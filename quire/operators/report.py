"""Corpus statistics and chunking reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import tokens
from quire.operators.nodes import n_windows


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """metric, n, mean, std (sample), min, max of numeric columns, one row each; values to six digits."""
    long = df.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, columns)), F.array(*(F.col(c).cast("double") for c in columns)))).alias("metric", "value"))
    value = F.col("value")
    return long.where("value is not null").groupBy("metric").agg(
        F.count("*").alias("n"), F.round(F.avg(value), 6).alias("mean"), F.round(F.stddev_samp(value), 6).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"),
    )


def window_sizes(rows: DataFrame, size: int, overlap: int) -> DataFrame:
    """One row for each token window of ``rows`` with its number of tokens, without building the windows."""
    step = max(size - max(overlap, 0), 1)
    n = rows.select(F.size(tokens(F.coalesce("text", F.lit("")))).alias("n"))
    counted = n.withColumn("w", n_windows(F.col("n"), size, overlap)).where("w > 0")
    each = counted.select("n", F.explode(F.sequence(F.lit(0), F.col("w") - 1)).alias("i"))
    return each.select(F.least(F.lit(size), F.col("n") - F.col("i") * step).alias("tokens"))


def robustness(rows: DataFrame, configs: list[tuple[str, int, int]]) -> DataFrame:
    """config, n_chunks, mean_tokens and p95_tokens of the token windows under each configuration."""
    parts = [window_sizes(rows, size, overlap).withColumn("config", F.lit(f"{name} {size}/{overlap}")) for name, size, overlap in configs]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    # An exact percentile from counts by size: sizes are few, chunks are many.
    sizes = every.groupBy("config", "tokens").agg(F.count("*").alias("n"))
    return sizes.groupBy("config").agg(
        F.sum("n").alias("n_chunks"), F.round(F.sum(F.col("tokens") * F.col("n")) / F.sum("n"), 6).alias("mean_tokens"),
        F.round(F.percentile("tokens", F.lit(0.95), F.col("n")), 6).alias("p95_tokens"),
    )
