"""From merged elements to parents and retrieval chunks.

Defined results. A document without elements has no nodes. Empty texts have no token windows. A window
size of 0 or less gives one window; an overlap below 0 counts as 0 and one not below the size gives
steps of one token. Nodes are built from the output of :func:`quire.operators.elements.merge_adjacent`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import strip, tokens
from quire.operators.elements import serialise_rows
from quire.operators.ordered import gather, in_blocks, scan

FRONT_MATTER = "front_matter"


def _section(path: Column) -> Column:
    return F.when(F.size(path) > 0, path).otherwise(F.array(F.lit(FRONT_MATTER)))


def _heading() -> Column:
    return F.col("element_type") == "section_heading"


def parent_nodes(merged: DataFrame, positions: DataFrame | None = None) -> DataFrame:
    """One parent for each heading and what follows it, and one for what comes before the first heading.

    ``positions`` (doc_id, ord, element_type) are those of ``merged``, where they can be had without its texts.
    """
    light = in_blocks((merged if positions is None else positions).select("doc_id", "ord", "element_type"), "doc_id", "ord")
    numbers = scan(light, "doc_id", "ord", sums={"parent_index": (_heading() | (F.col("ord") == 1)).cast("int")}).select("doc_id", "ord", "parent_index", "__block")
    m = F.col("members")
    return (
        gather(merged, numbers, "doc_id", "ord", "parent_index", ["section_path", "page", "text"])
        .withColumn("section_path", _section(m[0]["section_path"]))
        .select(
            "doc_id",
            F.sha1(F.concat_ws("::", "doc_id", F.lit("parent"), "parent_index", F.array_join("section_path", "."))).alias("parent_id"),
            "parent_index",
            "section_path",
            F.element_at("section_path", -1).alias("section"),
            F.array_min("members.page").alias("page_start"),
            F.array_max("members.page").alias("page_end"),
            F.array_join("members.text", "\n").alias("text"),
        )
    )


def counts(merged: DataFrame, size: int, overlap: int) -> DataFrame:
    """doc_id, parents, children: how many nodes each document has, from token counts (``n_tokens``) and types alone.

    A parent has the tokens of its elements, so that its windows need not be built.
    """
    number = (_heading() | (F.col("ord") == 1)).cast("int")
    light = scan(in_blocks(merged.select("doc_id", "ord", "element_type", "n_tokens"), "doc_id", "ord"), "doc_id", "ord", sums={"parent_index": number})
    special = F.count_if(F.col("element_type").isin("table", "figure_caption"))
    parents = light.groupBy("doc_id", "parent_index").agg(F.sum("n_tokens").cast("int").alias("n"), special.alias("special"))
    return parents.groupBy("doc_id").agg(F.count("*").alias("parents"), F.sum(n_windows(F.col("n"), size, overlap) + F.col("special")).alias("children"))


def n_windows(n: Column, size: int, overlap: int) -> Column:
    """Number of token windows over n tokens."""
    step = max(size - max(overlap, 0), 1)
    return F.when(n == 0, 0).when((n <= size) | F.lit(size <= 0), 1).otherwise(F.ceil((n - size) / step).cast("int") + 1)


def token_windows(rows: DataFrame, size: int, overlap: int, text: str = "text") -> DataFrame:
    """``rows`` exploded into windows: ``chunk_index`` from 1 and ``chunk``, the tokens joined by spaces."""
    step = max(size - max(overlap, 0), 1)
    split = rows.withColumn("__tokens", tokens(F.coalesce(text, F.lit("")))).withColumn("__n", n_windows(F.size("__tokens"), size, overlap))
    each = split.where("__n > 0").withColumn("__w", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    window = F.slice("__tokens", F.col("__w") * step + 1, F.lit(size)) if size > 0 else F.col("__tokens")
    return each.withColumn("chunk_index", (F.col("__w") + 1).cast("int")).withColumn("chunk", F.array_join(window, " ")).drop("__tokens", "__n", "__w")


def text_children(parents: DataFrame, size: int, overlap: int) -> DataFrame:
    """The token windows of every parent."""
    return token_windows(parents, size, overlap).select(
        "doc_id",
        "parent_id",
        F.sha1(F.concat_ws("::", "parent_id", F.lit("text"), "chunk_index")).alias("child_id"),
        F.lit("text").alias("chunk_type"),
        "section_path",
        "page_start",
        "page_end",
        F.col("chunk").alias("text"),
        "chunk_index",
        F.element_at("section_path", -1).alias("section"),
        F.array(F.lit(0), "parent_index", "chunk_index").alias("place"),
    )


def parent_lookup(merged: DataFrame, parents: DataFrame) -> DataFrame:
    """The parent of every table and figure: the first of its section path, else of its last component, else the first.

    Each rank is an equality join against one row per document and key, so that no element meets
    all parents of its document.
    """
    special = merged.where(F.col("element_type").isin("table", "figure_caption")).withColumn("__last", F.element_at(F.when(F.size("section_path") > 0, F.col("section_path")), -1))
    node = F.struct("parent_index", "parent_id")
    by_path = parents.groupBy("doc_id", "section_path").agg(F.min(node).alias("__same"))
    by_last = parents.groupBy("doc_id", F.element_at("section_path", -1).alias("__last")).agg(F.min(node).alias("__named"))
    first = parents.where("parent_index = 1").select("doc_id", node.alias("__first"))
    found = F.coalesce("__same", "__named", "__first")
    return (
        special.join(by_path, ["doc_id", "section_path"], "left").join(by_last, ["doc_id", "__last"], "left").join(first, "doc_id")
        .withColumn("parent_id", found["parent_id"]).withColumn("parent_index", found["parent_index"])
        .drop("__same", "__named", "__first", "__last")
    )


def figure_context(merged: DataFrame) -> DataFrame:
    """doc_id, element_id, ord and ``context`` of every figure: the next paragraph before page or section changes, else ''.

    Positions alone are scanned, forward for the runs of one page and section and backward for the next paragraph;
    texts are fetched by position afterwards.
    """
    light = in_blocks(merged.select("doc_id", "ord", "element_type", "page", "section_path"), "doc_id", "ord")
    place = F.struct("page", "section_path")
    moved = scan(light, "doc_id", "ord", previous={"__place": place})
    changed = F.coalesce((F.col("__place") != place).cast("int"), F.lit(1))
    runs = scan(moved, "doc_id", "ord", sums={"run": changed}).select("doc_id", (-F.col("ord")).alias("pos"), "element_type", "run")
    ahead = F.when(F.col("element_type") == "paragraph", F.struct("run", "pos"))
    back = scan(in_blocks(runs, "doc_id", "pos"), "doc_id", "pos", lasts={"ahead": ahead}).where("element_type = 'figure_caption'")
    found = back.select("doc_id", (-F.col("pos")).alias("ord"), F.when(F.col("ahead.run") == F.col("run"), -F.col("ahead.pos")).alias("at"))
    texts = merged.where("element_type = 'paragraph'").select("doc_id", F.col("ord").alias("at"), F.col("text").alias("context"))
    figures = merged.where("element_type = 'figure_caption'").select("doc_id", "ord", "element_id")
    return figures.join(found, ["doc_id", "ord"]).join(texts, ["doc_id", "at"], "left").select("doc_id", "element_id", "ord", F.coalesce("context", F.lit("")).alias("context"))


def special_children(merged: DataFrame, parents: DataFrame) -> DataFrame:
    """One chunk for every table, with its rows, and every figure, with its context."""
    placed = parent_lookup(merged, parents).join(figure_context(merged).select("doc_id", "element_id", "context"), ["doc_id", "element_id"], "left")
    table = F.col("element_type") == "table"
    kind = F.when(table, "table").otherwise("figure")
    extra = F.when(table, serialise_rows(F.col("table_rows"))).otherwise(F.coalesce("context", F.lit("")))
    return placed.select(
        "doc_id",
        "parent_id",
        F.sha1(F.concat_ws("::", "parent_id", kind, "element_id")).alias("child_id"),
        kind.alias("chunk_type"),
        "section_path",
        F.col("page").alias("page_start"),
        F.col("page").alias("page_end"),
        strip(F.concat("text", F.lit("\n"), extra)).alias("text"),
        F.when(table, F.col("table_rows")).alias("table_rows"),
        F.when(~table, F.coalesce("context", F.lit(""))).alias("figure_context"),
        F.element_at(_section(F.col("section_path")), -1).alias("section"),
        F.array(F.lit(1), "ord", F.lit(0)).alias("place"),
    )


def child_nodes(merged: DataFrame, parents: DataFrame, size: int, overlap: int) -> DataFrame:
    """All chunks: token windows, then tables and figures; ``place`` orders those of a document."""
    return text_children(parents, size, overlap).unionByName(special_children(merged, parents), allowMissingColumns=True).withColumn("chunk_level", F.lit("child"))
