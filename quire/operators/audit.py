"""Layout audit: frames, chains, labels, legend and page rectangles of elements with boxes.

Defined results. A document's elements are counted by ``ord`` from 1, repeated rows once. An element without a box is
in no chain. A box without all four edges has no frame. Unknown types have rank 8 and the colour of ``chunk``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.ordered import in_blocks, scan

#: Rank order and colours of the element types.
RANKS = {"title": 1, "section_heading": 2, "paragraph": 3, "table": 4, "figure_caption": 5, "equation": 6, "references": 7}
COLOURS = {
    "title": "b51f1f", "section_heading": "c77800", "paragraph": "166534", "table": "1d4ed8", "figure_caption": "7c3aed",
    "equation": "0f766e", "references": "6b7280", "chunk": "dc2626",
}
#: Page size in points where a document brings none (A4).
PAGE = (595.0, 842.0)
_LEAST = 1.0


def looks_like_equation(text: Column) -> Column:
    """An equals sign, a digit, and an operator sign or an assignment."""
    assignment = r"(?U)\b[A-Za-z]\w*\s*=\s*[\dA-Za-z(]"
    return F.contains(text, F.lit("=")) & text.rlike(r"(?U)\d") & (text.rlike(r"[+\-*/^×÷]") | text.rlike(assignment))


def audit_type(element_type: Column, text: Column) -> Column:
    """The element type shown in the audit: paragraphs that read like equations are equations."""
    kind = F.coalesce(element_type, F.lit("chunk"))
    return F.when((kind == "paragraph") & looks_like_equation(F.coalesce(text, F.lit(""))), "equation").otherwise(kind)


def _lookup(values: dict, key: Column, default) -> Column:
    out = F.lit(default)
    for name, value in values.items():
        out = F.when(key == name, F.lit(value)).otherwise(out)
    return out


def type_rank(kind: Column) -> Column:
    """1 to 7 by type, 8 for others."""
    return _lookup(RANKS, kind, len(RANKS) + 1)


def type_colour(kind: Column) -> Column:
    """Colour by type, that of ``chunk`` for others."""
    return _lookup(COLOURS, kind, COLOURS["chunk"])


def numbered(elements: DataFrame) -> DataFrame:
    """Elements in blocks with ``element_index`` from 1."""
    rows = in_blocks(elements.select("doc_id", "element_id", "element_type", "text", "ord", "bboxes").where("doc_id is not null and ord is not null"), "doc_id", "ord")
    return scan(rows, "doc_id", "ord", sums={"element_index": F.lit(1)})


def chain(indexed: DataFrame) -> DataFrame:
    """doc_id, element_index, prev_index, next_index over the elements that have any box."""
    boxed = indexed.where(F.exists(F.coalesce("bboxes", F.array().cast("array<struct<page:int,l:double,t:double,r:double,b:double,origin:string>>")), lambda b: b.isNotNull()))
    forward = scan(boxed.select("doc_id", "element_index", "ord", "__block"), "doc_id", "ord", previous={"prev_index": F.col("element_index")})
    # The next of an element is the one whose previous it is.
    after = forward.select("doc_id", F.col("prev_index").alias("element_index"), F.col("element_index").alias("next_index")).where("element_index is not null")
    return forward.join(after, ["doc_id", "element_index"], "left").select("doc_id", "element_index", "prev_index", "next_index")


def frames(indexed: DataFrame) -> DataFrame:
    """One row for each box with all edges."""
    box = indexed.select("doc_id", "element_index", "element_id", audit_type(F.col("element_type"), F.col("text")).alias("element_type"), F.posexplode("bboxes").alias("box_index", "box"))
    return box.where("box.l is not null and box.t is not null and box.r is not null and box.b is not null").select(
        "doc_id", "element_index", "element_id", "element_type", "box_index", F.coalesce("box.page", F.lit(1)).alias("page"),
        "box.l", "box.t", "box.r", "box.b", F.coalesce(F.lower("box.origin"), F.lit("unknown")).alias("origin"),
    )


def with_rect(framed: DataFrame, width: float = PAGE[0], height: float = PAGE[1]) -> DataFrame:
    """``framed`` with x0, y0, x1, y1 in points from the lower left corner."""
    unit = F.greatest(*(F.abs(c) for c in "ltrb")) <= 1.0
    x = [F.when(unit, F.col(c) * width).otherwise(F.col(c)) for c in "lr"]
    y = [F.when(unit, F.col(c) * height).otherwise(F.col(c)) for c in "tb"]
    clamp = lambda c, high: F.greatest(F.lit(0.0), F.least(F.lit(high), c))
    top = F.contains("origin", F.lit("top"))
    x0, x1 = clamp(F.least(*x), width), clamp(F.greatest(*x), width)
    y0 = clamp(F.when(top, height - F.greatest(*y)).otherwise(F.least(*y)), height)
    y1 = clamp(F.when(top, height - F.least(*y)).otherwise(F.greatest(*y)), height)
    out = framed.withColumns({"x0": x0, "y0": y0, "x1": x1, "y1": y1})
    for low, high, most in (("x0", "x1", width), ("y0", "y1", height)):
        out = out.withColumn(high, F.when(F.col(high) <= F.col(low), F.least(F.lit(most), F.col(low) + _LEAST)).otherwise(F.col(high)))
    return out


def labels(framed: DataFrame, chained: DataFrame) -> DataFrame:
    """``framed`` with ``label``: rank, number, type and neighbours."""
    name = lambda c: F.coalesce(F.format_string("C%03d", F.col(c)), F.lit("none"))
    number = lambda c: F.when(F.col(c).isNotNull(), name(c)).otherwise("none")
    text = F.concat(
        F.format_string("H%02d C%03d:", type_rank(F.col("element_type")), F.col("element_index")), "element_type",
        F.lit(" prev="), number("prev_index"), F.lit(" next="), number("next_index"),
    )
    return framed.join(chained, ["doc_id", "element_index"], "left").withColumn("label", text)


def legend(framed: DataFrame) -> DataFrame:
    """doc_id, position, element_type, colour: the types seen in a document by rank and name."""
    from pyspark.sql import Window

    seen = framed.select("doc_id", "element_type").distinct()
    order = Window.partitionBy("doc_id").orderBy("rank", "element_type")
    return seen.withColumn("rank", type_rank(F.col("element_type"))).withColumn("position", F.row_number().over(order)).select("doc_id", "position", "element_type", type_colour(F.col("element_type")).alias("colour"))


#: The legend's measures in points, its heading and the heading's colour.
MARGIN, LEGEND_WIDTH, LEGEND_SHARE, HEADING_HEIGHT, ROW_HEIGHT, GAP = 12.0, (170.0, 260.0), 0.32, 14.0, 12.0, 2.0
HEADING, HEADING_COLOUR = "Label Colors (Hierarchy)", "111827"


def legend_boxes(items: DataFrame, width: float = PAGE[0], height: float = PAGE[1]) -> DataFrame:
    """``legend`` laid out in the upper right corner of a page: text and x0, y0, x1, y1 of each entry, below a heading at position 0."""
    right, top = width - MARGIN, height - MARGIN
    left = max(MARGIN, right - min(LEGEND_WIDTH[1], max(LEGEND_WIDTH[0], width * LEGEND_SHARE)))
    upper = F.lit(top - HEADING_HEIGHT - GAP) - (F.col("position") - 1) * ROW_HEIGHT
    text = F.concat(F.format_string("H%02d ", type_rank(F.col("element_type"))), "element_type")
    rows = items.select("doc_id", "position", text.alias("text"), "colour", (upper - ROW_HEIGHT + GAP).alias("y0"), upper.alias("y1"))
    head = items.select("doc_id").distinct().select("doc_id", F.lit(0).alias("position"), F.lit(HEADING).alias("text"), F.lit(HEADING_COLOUR).alias("colour"), F.lit(top - HEADING_HEIGHT).alias("y0"), F.lit(top).alias("y1"))
    return rows.unionByName(head).withColumns({"x0": F.lit(left), "x1": F.lit(right)})


def seeded_sample(rows: DataFrame, n: int, seed: int, id_col: str = "doc_id") -> DataFrame:
    """``n`` rows without replacement, the same for the same seed: those of the least keyed hash; ``output`` numbers them."""
    from pyspark.sql import Window

    if n <= 0:
        raise ValueError("the sample size must be positive")
    keyed = rows.withColumn("__key", F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256))
    taken = keyed.orderBy("__key", id_col).limit(n)
    return taken.withColumn("output", F.concat(F.row_number().over(Window.orderBy("__key", id_col)), F.lit(".pdf"))).drop("__key")
