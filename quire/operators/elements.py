"""From parser items to semantic elements: cleaning, classification, section paths, merging.

Defined results. Null or blank text drops an element unless it is a formula, which becomes
``[equation]``. A null, zero or negative page is page 1. Rows that repeat in every column count once.
Empty tables give empty tables. Input columns beyond those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import LINE_END, SPACE, count_of, lines, strip
from quire.operators.ordered import gather, in_blocks, placed, scan
from quire.session import checkpointed

#: Element types whose neighbours of the same type, page and section are merged.
JOINABLE = ("paragraph", "references", "table")
EMPTY_FORMULA = "[equation]"


# Predicates on text

def is_figure_caption(text: Column) -> Column:
    """Begins with Figure or Fig. and a number."""
    return F.lower(strip(text)).rlike(r"(?U)^(figure|fig\.)\s*\d+")


def is_equation(text: Column) -> Column:
    """Contains = and an arithmetic or Greek operator sign."""
    return F.contains(text, F.lit("=")) & text.rlike(r"[+\-*/^∑∏∫λσ]")


def is_table(text: Column) -> Column:
    """A line with two bars, two lines with a bar, or a line with a tab."""
    rows = F.filter(F.split(text, LINE_END), lambda line: strip(line) != "")
    several = F.exists(rows, lambda line: (count_of(strip(line), "|") >= 2) | F.contains(strip(line), F.lit("\t"))) | (
        F.size(F.filter(rows, lambda line: F.contains(line, F.lit("|")))) >= 2
    )
    # Most texts have neither sign and are not taken apart.
    return (F.contains(text, F.lit("|")) | F.contains(text, F.lit("\t"))) & several


def classify(text: Column, in_references: Column) -> Column:
    """Element type of a plain text item."""
    return (
        F.when(in_references, "references")
        .when(is_figure_caption(text), "figure_caption")
        .when(is_equation(text), "equation")
        .when(is_table(text), "table")
        .otherwise("paragraph")
    )


def element_type(label: Column, text: Column, in_references: Column) -> Column:
    """Element type of an item: the parser's label first, then the text itself."""
    fixed = F.when(label == "title", "title").when(label == "section_header", "section_heading").when(label == "formula", "equation").when(label == "table", "table").when(label == "picture", "figure_caption")
    return F.coalesce(fixed, classify(text, in_references))


def table_rows(text: Column) -> Column:
    """Cells of a table written as text: rule lines and empty cells are dropped."""
    kept = F.filter(lines(text), lambda line: ~line.rlike(r"^[\-:|\s]+$"))
    cells = F.transform(
        kept,
        lambda line: F.filter(
            F.transform(
                F.when(F.contains(line, F.lit("|")), F.split(line, r"\|")).when(F.contains(line, F.lit("\t")), F.split(line, "\t")).otherwise(F.split(line, SPACE + "{2,}")),
                strip,
            ),
            lambda cell: cell != "",
        ),
    )
    return F.filter(cells, lambda row: F.size(row) > 0)


def typed_rows(rows: Column) -> Column:
    """Cells of a typed table: null cells are '', cells stripped, rows without any content dropped."""
    clean = F.transform(rows, lambda row: F.transform(row, lambda cell: strip(F.coalesce(cell, F.lit("")))))
    return F.filter(clean, lambda row: F.exists(row, lambda cell: cell != ""))


def serialise_rows(rows: Column) -> Column:
    """Rows of a table as lines of cells joined by ' | '; empty rows skipped, '' for null."""
    kept = F.filter(rows, lambda row: F.size(row) > 0)
    return F.coalesce(F.array_join(F.transform(kept, lambda row: F.array_join(F.transform(row, lambda c: F.coalesce(c, F.lit(""))), " | ")), "\n"), F.lit(""))


def normal_boxes(boxes: Column) -> Column:
    """Boxes with all four edges; page 1 where missing or below 1, origin in lower case, ``unknown`` where missing."""
    whole = F.filter(boxes, lambda b: b.isNotNull() & b["l"].isNotNull() & b["t"].isNotNull() & b["r"].isNotNull() & b["b"].isNotNull())
    return F.transform(
        whole,
        lambda b: F.struct(
            F.when(b["page"] > 0, b["page"]).otherwise(1).alias("page"), b["l"].alias("l"), b["t"].alias("t"), b["r"].alias("r"), b["b"].alias("b"),
            F.coalesce(F.lower(b["origin"]), F.lit("unknown")).alias("origin"),
        ),
    )


# Items

def item_text(caption: Column, text: Column, original: Column, markdown: Column) -> Column:
    """The first of an item's texts that is not empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in (caption, text, original)), markdown, F.lit(""))


def stripped_items(items: DataFrame) -> DataFrame:
    """Items (doc_id, seq, label, level, page, text) with stripped text, empty ones dropped, and pages from 1."""
    text = strip(F.coalesce("text", F.lit("")))
    kept = items.withColumn("text", text).where((F.col("text") != "") | (F.col("label") == "formula")).withColumn("text", F.when(F.col("text") == "", EMPTY_FORMULA).otherwise(F.col("text")))
    return kept.withColumn("page", F.when(F.col("page") > 0, F.col("page")).otherwise(1))


def kept_items(items: DataFrame) -> DataFrame:
    """``stripped_items`` numbered by ``ord`` from 1."""
    return scan(placed(stripped_items(items), "doc_id", "seq"), "doc_id", "seq", sums={"ord": F.lit(1)}).drop("__block")


def with_sections(items: DataFrame, pos: str = "ord", number: str | None = None) -> DataFrame:
    """``items`` (each at its own ``pos``) with ``in_references`` and ``section_path``, and a running ``number`` if it is named.

    A heading of level L keeps the path's first L - 1 entries, padded with ``section``, and adds its text;
    a heading of level 0 or less changes nothing; other items have the path of the last heading. The
    k-th entry below a heading is thus the last earlier heading of level k unless one of a smaller
    level came after it. Paths are made of the headings alone, which then pass along the items as rows just before their own.
    """
    level = F.coalesce("level", F.lit(1))
    heads = checkpointed(items.where(F.col("label") == "section_header").select("doc_id", F.col(pos).cast("bigint").alias("__pos"), level.alias("__lv"), "text"))
    levels = sorted(r[0] for r in heads.where("__lv > 0").select("__lv").distinct().collect())
    lasts = {}
    for k in levels:
        lasts[f"__own{k}"] = F.when(F.col("__lv") == k, F.struct("__pos", "text"))
        lasts[f"__higher{k}"] = F.when((F.col("__lv") > 0) & (F.col("__lv") < k), F.col("__pos"))
    above = scan(placed(heads, "doc_id", "__pos"), "doc_id", "__pos", lasts=lasts)
    entry = lambda k: F.when(F.col(f"__own{k}.__pos") > F.coalesce(f"__higher{k}", F.lit(-1)), F.col(f"__own{k}.text"))
    entries = F.map_from_arrays(F.array(*map(F.lit, levels)), F.array(*map(entry, levels))) if levels else F.lit(None).cast("map<int,string>")
    upper = F.when(F.col("__lv") > 1, F.transform(F.sequence(F.lit(1), F.greatest(F.col("__lv") - 1, F.lit(1))), lambda k: F.coalesce(F.try_element_at(entries, k), F.lit("section")))).otherwise(F.array().cast("array<string>"))
    path = F.when(F.col("__lv") > 0, F.concat(upper, F.array("text")))
    marks = above.select("doc_id", (2 * F.col("__pos")).alias("__at"), path.alias("__path"), F.lower("text").startswith("references").alias("__refs"))
    rows = items.withColumn("__at", 2 * F.col(pos).cast("bigint") + 1).withColumn("__item", F.lit(1))
    along = scan(
        placed(rows.unionByName(marks, allowMissingColumns=True), "doc_id", "__at"), "doc_id", "__at",
        sums={number: F.coalesce("__item", F.lit(0))} if number else {}, lasts={"section_path": F.col("__path"), "in_references": F.col("__refs")},
    ).where("__item = 1")
    empty = F.array().cast("array<string>")
    return along.withColumns({"section_path": F.coalesce("section_path", empty), "in_references": F.coalesce("in_references", F.lit(False))}).drop("__at", "__path", "__refs", "__item", "__block")


def sectioned_items(items: DataFrame) -> DataFrame:
    """Kept items with ``ord``, ``section_path`` and ``in_references``; texts move once."""
    return with_sections(stripped_items(items), "seq", "ord")


# Elements

def clean_elements(elements: DataFrame) -> DataFrame:
    """Raw elements with stripped text, blank ones dropped, pages, paths, rows and boxes without nulls; repeated rows stay."""
    text = strip(F.coalesce("text", F.lit("")))
    empty = lambda kind: F.array().cast(kind)
    return (
        elements.where("doc_id is not null and ord is not null")
        .select(
            "doc_id", F.col("ord").cast("int").alias("ord"), "element_type", F.when((text == "") & (F.col("element_type") == "equation"), EMPTY_FORMULA).otherwise(text).alias("text"),
            F.when(F.col("page") > 0, F.col("page")).otherwise(1).alias("page"), F.coalesce("section_path", empty("array<string>")).alias("section_path"),
            F.coalesce("table_rows", empty("array<array<string>>")).alias("table_rows"), F.filter(F.coalesce("bboxes", empty(_BOXES)), lambda b: b.isNotNull()).alias("bboxes"),
        )
        .where("text <> ''")
    )


_BOXES = "array<struct<page:int,l:double,t:double,r:double,b:double,origin:string>>"


def merge_groups(cleaned: DataFrame) -> DataFrame:
    """doc_id, ord, group, __block, element_type, page: the number of the merged element that each position belongs to, from positions and kinds alone."""
    # Written once: the texts are then looked at once, and the scans read narrow rows.
    light = checkpointed(in_blocks(cleaned.select("doc_id", "ord", "element_type", "page", F.xxhash64("section_path").alias("place")), "doc_id", "ord"))
    same = F.struct("element_type", "page", "place")
    linked = scan(light, "doc_id", "ord", previous={"before": same})
    joins = F.col("element_type").isin(*JOINABLE) & F.coalesce(F.col("before") == same, F.lit(False))
    return scan(linked.withColumn("begins", (~joins).cast("int")), "doc_id", "ord", sums={"group": F.col("begins")}).select("doc_id", "ord", "group", "__block", "element_type", "page")


def merged_positions(elements: DataFrame) -> DataFrame:
    """doc_id, ord, element_type, page of the merged elements, without their texts."""
    groups = merge_groups(clean_elements(elements))
    return groups.groupBy("doc_id", F.col("group").alias("ord")).agg(F.max("element_type").alias("element_type"), F.max("page").alias("page"))


def merge_adjacent(elements: DataFrame) -> DataFrame:
    """Merged elements: neighbours of a joinable type, page and section become one; ``ord`` counts anew from 1.

    Groups are numbered on narrow rows; texts, cells and boxes move once, to their block of positions.
    """
    cleaned = clean_elements(elements)
    columns = ["element_type", "text", "page", "section_path", "table_rows", "bboxes"]
    merged = gather(cleaned, merge_groups(cleaned), "doc_id", "ord", "group", columns).select("doc_id", F.col("group").alias("ord"), F.col("members").alias("m"))
    first = F.col("m")[0]
    return merged.select(
        "doc_id",
        F.sha1(F.concat_ws("::", "doc_id", F.lit("element"), "ord")).alias("element_id"),
        first["element_type"].alias("element_type"),
        F.array_join(F.col("m.text"), "\n").alias("text"),
        first["page"].alias("page"),
        "ord",
        first["section_path"].alias("section_path"),
        F.when(first["element_type"] == "table", F.flatten("m.table_rows")).alias("table_rows"),
        F.flatten("m.bboxes").alias("bboxes"),
        F.size("m").alias("n_merged"),
    )
