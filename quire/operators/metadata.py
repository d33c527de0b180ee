"""What is inferred about whole documents, and the reports over them.

Defined results. A document without a title element has a null paper title, one without a matching year a null year,
and one without author lines an empty list. The doc-level title falls back to the file's stem.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import file_name, preview, stem, strip, suffix, tokens
from quire.session import checkpointed

#: Elements at the start of a document that are searched for its year.
EARLY = 25
MOST_AUTHORS = 3


def paper_titles(merged: DataFrame) -> DataFrame:
    """doc_id, paper_title: the first title element."""
    return merged.where("element_type = 'title'").groupBy("doc_id").agg(F.min_by("text", "ord").alias("paper_title"))


def paper_authors(merged: DataFrame) -> DataFrame:
    """doc_id, authors: up to three lines of page 1 after the first title and before the next heading."""
    page = merged.where("page = 1")
    title = page.where("element_type = 'title'").groupBy("doc_id").agg(F.min("ord").alias("__title"))
    heading = page.where("element_type = 'section_heading'").join(title, "doc_id").where("ord > __title").groupBy("doc_id").agg(F.min("ord").alias("__stop"))
    text = strip(F.col("text"))
    fits = ~text.rlike(r"(?U)\d{4}") & ~F.contains(text, F.lit("@")) & F.size(tokens(text)).between(2, 15)
    lines = page.join(title, "doc_id").join(heading, "doc_id", "left").where("ord > __title and element_type <> 'title' and (__stop is null or ord < __stop)").where(fits)
    first = Window.partitionBy("doc_id").orderBy("ord")
    return (
        lines.select("doc_id", "ord", text.alias("text")).withColumn("__n", F.row_number().over(first)).where(F.col("__n") <= MOST_AUTHORS)
        .groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda a: a["text"]).alias("authors"))
    )


def paper_years(merged: DataFrame) -> DataFrame:
    """doc_id, year: the first year from 1900 to 2099 in the first elements; only documents that have one."""
    early = merged.where(F.col("ord") <= EARLY).withColumn("__y", F.regexp_extract("text", r"(?U)\b(?:19|20)\d{2}\b", 0)).where("__y <> ''")
    return early.groupBy("doc_id").agg(F.min_by("__y", "ord").cast("int").alias("year"))


def type_counts(merged: DataFrame) -> DataFrame:
    """doc_id, element_type, n."""
    return merged.groupBy("doc_id", "element_type").agg(F.count("*").alias("n"))


def light(merged: DataFrame) -> DataFrame:
    """What metadata and counts look at: positions, types, sizes, and of the texts only titles, first pages and early elements."""
    seen = (F.col("element_type") == "title") | (F.col("page") == 1) | (F.col("ord") <= EARLY)
    return merged.select("doc_id", "ord", "element_type", "page", F.size(tokens(F.col("text"))).alias("n_tokens"), F.length("text").alias("n_chars"), F.when(seen, F.col("text")).alias("text"))


def doc_metadata(documents: DataFrame, merged: DataFrame, counts: DataFrame) -> DataFrame:
    """The metadata of ``documents`` (doc_id, relative_path, source_path, text), one row for each with elements.

    ``merged`` may be :func:`light`; ``counts`` has doc_id, parents, children.
    """
    path = F.col("relative_path")
    pages = merged.groupBy("doc_id").agg(F.min("page").alias("page_start"), F.max("page").alias("page_end"), F.count("*").alias("elements_count"))
    numbers = counts.select("doc_id", F.col("parents").alias("parent_nodes_count"), F.col("children").alias("child_nodes_count"))
    out = documents.join(pages, "doc_id").join(numbers, "doc_id", "left").fillna(0, ["parent_nodes_count", "child_nodes_count"])
    for part in (paper_titles(merged), paper_authors(merged), paper_years(merged)):
        out = out.join(part, "doc_id", "left")
    title = F.coalesce("paper_title", stem(path))
    return out.select(
        "doc_id", "source_path", "relative_path", file_name(path).alias("file_name"), suffix(file_name(path)).alias("file_ext"),
        F.when(F.contains(path, F.lit("/")), F.split(path, "/")[0]).otherwise("root").alias("topic"),
        title.alias("title"), title.alias("paper_title"), F.coalesce("authors", F.array().cast("array<string>")).alias("authors"), "year",
        F.length(F.coalesce("text", F.lit(""))).cast("bigint").alias("char_count"), "page_start", "page_end", "elements_count", "parent_nodes_count", "child_nodes_count",
    )


def manifest_documents(documents: DataFrame, metadata: DataFrame, merged: DataFrame, preview_characters: int = 240) -> DataFrame:
    """Manifest entries; ``index`` counts the documents by path components."""
    counts = type_counts(merged).groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("element_type", "n")))).alias("element_type_counts"))
    texts = documents.select("doc_id", preview(F.coalesce("text", F.lit("")), preview_characters).alias("text_preview"))
    # The running number over all documents: sorted in ranges, counted in each, then offset.
    ordered = metadata.join(counts, "doc_id", "left").join(texts, "doc_id")
    return with_position(ordered, F.split("relative_path", "/"), "index")


def manifest_header(entries: DataFrame, source_dir: str) -> DataFrame:
    """generated_at_utc, source_dir, document_count and total_characters of manifest entries, in one row."""
    return entries.agg(
        F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("generated_at_utc"), F.lit(source_dir).alias("source_dir"),
        F.count("*").alias("document_count"), F.coalesce(F.sum("char_count"), F.lit(0)).alias("total_characters"),
    )


def with_position(rows: DataFrame, order, name: str) -> DataFrame:
    """``rows`` numbered from 1 by ``order`` and doc_id without bringing all rows into one task."""
    parts = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    # Written once, as the ids of the ranges must be the same in both uses.
    ranged = checkpointed(rows.withColumn("__key", order).repartitionByRange(int(parts), "__key", "doc_id").withColumn("__part", F.spark_partition_id()))
    inside = Window.partitionBy("__part").orderBy("__key", "doc_id")
    sizes = ranged.groupBy("__part").agg(F.count("*").alias("__n"))
    before = sizes.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    return ranged.join(F.broadcast(before), "__part").withColumn(name, (F.row_number().over(inside) + F.col("__before")).cast("int")).drop("__key", "__part", "__before")
