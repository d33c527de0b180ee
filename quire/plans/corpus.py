"""The tables of the pipeline, planned once from the raw inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import strip
from quire.operators.elements import element_type, merge_adjacent, sectioned_items
from quire.operators.metadata import light
from quire.operators.nodes import child_nodes, counts, parent_nodes
from quire.session import checkpointed, table

#: Chunking of the default configuration.
CHUNK_SIZE, CHUNK_OVERLAP = 800, 120
MIN_CHARACTERS = 40


def line_items(documents: DataFrame) -> DataFrame:
    """The test projection: every line of a document as a parser item, labelled by its number.

    Columns: doc_id, seq, label, level, page, text, and the converter's caption, original, markdown.
    """
    split = documents.where("text is not null and doc_id is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("k", "t"))
    k, t = F.col("seq"), F.col("t")
    rows = split.select("doc_id", (F.col("k") + 1).alias("seq"), strip(F.col("t")).alias("t")).where("t <> ''")
    label = F.when(k == 1, "title").when(k % 5 == 0, "section_header").when((k % 7 != 0) & (k % 11 != 0) & (k % 13 != 0) & (k % 17 == 0), "formula").otherwise("text")
    text = (
        F.when(k == 1, F.when(F.col("doc_id") % 3 == 0, F.concat(t, F.lit(" "), (1900 + F.col("doc_id") % 150).cast("string"))).otherwise(t))
        .when(k % 20 == 0, F.concat(F.lit("References "), k))
        .when(k % 5 == 0, F.concat(F.lit("Section "), k))
        .when(k % 7 == 0, F.concat(F.lit("Figure "), k, F.lit(": "), t))
        .when(k % 11 == 0, F.concat(F.lit("y = a + "), t))
        .when(k % 13 == 0, F.replace(t, F.lit(" "), F.lit(" | ")))
        .when((k % 17 == 0) | (k % 23 == 0), "")
        .otherwise(t)
    )
    level = F.when(label == "section_header", (F.lit(1) + (F.floor(k / 5) - 1) % 3).cast("int"))
    return rows.select(
        "doc_id", "seq", label.alias("label"), level.alias("level"), (F.lit(1) + F.floor((k - 1) / 12)).cast("int").alias("page"), text.alias("text"),
        F.when(k % 7 == 0, F.concat(F.lit("Figure "), k)).otherwise("").alias("caption"), F.when(k % 2 == 0, t).otherwise("").alias("original"), F.concat(F.lit("| "), t).alias("markdown"),
    )


def classified_items(documents: DataFrame) -> DataFrame:
    """Kept items with section paths and element types."""
    items = sectioned_items(line_items(documents))
    return items.withColumn("element_type", element_type(F.col("label"), F.col("text"), F.col("in_references")))


def current_files(parsed: DataFrame) -> DataFrame:
    """The listing that ``parsed_documents`` stands for: the latest export of each path.

    ``fingerprint`` is the sha256 of the text, '' for a null one. Of several exports at one time the greatest record_id counts.
    """
    rank = F.struct(F.coalesce("exported_at", F.lit("0001-01-01").cast("timestamp")), "record_id")
    row = F.struct("doc_id", "text", F.col("metadata.source_path").alias("source_path"), F.col("metadata.title").alias("title"), "exported_at")
    latest = parsed.where("metadata.relative_path is not null").groupBy(F.col("metadata.relative_path").alias("relative_path")).agg(F.max_by(row, rank).alias("r"))
    text = F.coalesce("text", F.lit(""))
    return latest.select("relative_path", "r.*").withColumn("fingerprint", F.sha2(text, 256)).withColumn("char_count", F.length(text).cast("bigint")).withColumnRenamed("exported_at", "ingested_at")


def merged_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged elements of the ``elements`` table."""
    return merge_adjacent(table(spark, sf_dir, "elements"))


def nodes(spark: SparkSession, sf_dir: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Merged elements, parents and children; the first two are written once, as all that follows is built from them."""
    merged = checkpointed(merged_elements(spark, sf_dir))
    parents = checkpointed(parent_nodes(merged))
    return merged, parents, child_nodes(merged, parents, size, overlap)


def sizes(spark: SparkSession, sf_dir: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> tuple[DataFrame, DataFrame]:
    """The light form of the merged elements, written once, and the number of nodes of each document; no node is built."""
    merged = checkpointed(light(merged_elements(spark, sf_dir)))
    return merged, counts(merged, size, overlap)


def latest_texts(parsed: DataFrame) -> DataFrame:
    """doc_id, text and metadata of the latest export of each document; of equal times the greatest record_id."""
    rank = F.struct(F.coalesce("exported_at", F.lit("0001-01-01").cast("timestamp")), "record_id")
    return parsed.groupBy("doc_id").agg(F.max_by(F.struct("text", "metadata"), rank).alias("r")).select("doc_id", "r.*")
