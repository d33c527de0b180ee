"""Layout audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import audit as au
from quire.operators.elements import normal_boxes
from quire.session import table

SAMPLE, SEED = 25, 7


def _indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return au.numbered(table(spark, sf_dir, "elements"))


def _framed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return au.frames(_indexed(spark, sf_dir))


def bbox_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete boxes of all elements."""
    rows = table(spark, sf_dir, "elements").select("element_id", "bboxes").distinct()
    return rows.select("element_id", F.posexplode(normal_boxes(F.col("bboxes"))).alias("box_index", "b")).select("element_id", "box_index", "b.*")


def audit_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports of PDF files with at least one box."""
    docs = table(spark, sf_dir, "parsed_documents")
    boxed = F.exists("elements", lambda e: F.exists(e["metadata"]["bboxes"], lambda b: b.isNotNull()))
    return docs.where(F.coalesce(boxed, F.lit(False)) & (F.lower("metadata.file_ext") == ".pdf")).select("record_id", "doc_id")


def audit_equation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs that the audit shows as equations."""
    rows = table(spark, sf_dir, "elements").where("element_type = 'paragraph' and text is not null").select("element_id", "text").distinct()
    return rows.where(au.looks_like_equation(F.col("text"))).select("element_id")


def audit_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours among the elements with boxes."""
    return au.chain(_indexed(spark, sf_dir))


def audit_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames."""
    return _framed(spark, sf_dir)


def audit_rects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page rectangles, to four digits."""
    rects = au.with_rect(_framed(spark, sf_dir))
    return rects.select("doc_id", "element_index", "box_index", "page", *(F.round(c, 4).alias(c) for c in ("x0", "y0", "x1", "y1")))


def audit_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame labels."""
    indexed = _indexed(spark, sf_dir)
    return au.labels(au.frames(indexed), au.chain(indexed)).select("doc_id", "element_index", "box_index", "label")


def audit_legend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legends."""
    return au.legend(_framed(spark, sf_dir))


def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A repeatable sample of the eligible documents, the sampling operator itself."""
    return au.seeded_sample(audit_eligible(spark, sf_dir).select("doc_id").distinct(), SAMPLE, SEED)


QUERIES = {f.__name__: f for f in (bbox_normalize, audit_eligible, audit_equation, audit_chain, audit_frames, audit_rects, audit_labels, audit_legend, seeded_sample)}

_EQUATION = r"(contains(text, '=') AND regexp_matches(text, '\p{Nd}') AND (regexp_matches(text, '[+\-*/^×÷]') OR regexp_matches(text, '(?:^|[^\p{L}\p{M}\p{N}_])[A-Za-z][\p{L}\p{M}\p{N}_]*[\s\x0b\x{85}\p{Z}]*=[\s\x0b\x{85}\p{Z}]*[\p{Nd}A-Za-z(]')))"
_FRAMES = f"""
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS element_index
  FROM (SELECT DISTINCT doc_id, element_id, element_type, text, ord, bboxes FROM elements WHERE doc_id IS NOT NULL AND ord IS NOT NULL)),
boxed AS (SELECT doc_id, element_index FROM numbered WHERE len(list_filter(bboxes, lambda b: b IS NOT NULL)) > 0),
chain AS (SELECT doc_id, element_index, lag(element_index) OVER w AS prev_index, lead(element_index) OVER w AS next_index FROM boxed WINDOW w AS (PARTITION BY doc_id ORDER BY element_index)),
opened AS (
  SELECT doc_id, element_index, element_id, CASE WHEN element_type = 'paragraph' AND {_EQUATION.replace('text,', "coalesce(text, ''),")} THEN 'equation' ELSE coalesce(element_type, 'chunk') END AS element_type, unnest(range(0, len(bboxes))) AS box_index, unnest(bboxes) AS b
  FROM numbered),
frames AS (
  SELECT doc_id, element_index, element_id, element_type, box_index, coalesce(b.page, 1) AS page, b.l AS l, b.t AS t, b.r AS r, b.b AS b, coalesce(lower(b.origin), 'unknown') AS origin
  FROM opened WHERE b.l IS NOT NULL AND b.t IS NOT NULL AND b.r IS NOT NULL AND b.b IS NOT NULL)"""
_RANK = "CASE element_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in au.RANKS.items()) + " ELSE 8 END"
_COLOUR = "CASE element_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in au.COLOURS.items()) + f" ELSE '{au.COLOURS['chunk']}' END"
_ELIGIBLE = "SELECT record_id, doc_id FROM parsed_documents WHERE lower(metadata.file_ext) = '.pdf' AND len(list_filter(elements, lambda e: len(list_filter(e.metadata.bboxes, lambda b: b IS NOT NULL)) > 0)) > 0"

SQL = {
    "bbox_normalize": """SELECT element_id, box_index, CASE WHEN b.page > 0 THEN b.page ELSE 1 END AS page, b.l AS l, b.t AS t, b.r AS r, b.b AS b, coalesce(lower(b.origin), 'unknown') AS origin
FROM (SELECT element_id, unnest(range(0, len(bs))) AS box_index, unnest(bs) AS b FROM (
  SELECT element_id, list_filter(bboxes, lambda b: b.l IS NOT NULL AND b.t IS NOT NULL AND b.r IS NOT NULL AND b.b IS NOT NULL) AS bs FROM (SELECT DISTINCT element_id, bboxes FROM elements)))""",
    "audit_eligible": _ELIGIBLE,
    "audit_equation": f"SELECT element_id FROM (SELECT DISTINCT element_id, text FROM elements WHERE element_type = 'paragraph' AND text IS NOT NULL) WHERE {_EQUATION}",
    "audit_chain": f"WITH {_FRAMES} SELECT doc_id, element_index, prev_index, next_index FROM chain",
    "audit_frames": f"WITH {_FRAMES} SELECT * FROM frames",
    "audit_rects": f"""WITH {_FRAMES},
u AS (SELECT *, CASE WHEN greatest(abs(l), abs(t), abs(r), abs(b)) <= 1 THEN 595.0::DOUBLE ELSE 1.0::DOUBLE END AS sx, CASE WHEN greatest(abs(l), abs(t), abs(r), abs(b)) <= 1 THEN 842.0::DOUBLE ELSE 1.0::DOUBLE END AS sy FROM frames),
p AS (
  SELECT doc_id, element_index, box_index, page, greatest(0.0, least(595.0, least(l * sx, r * sx))) AS x0, greatest(0.0, least(595.0, greatest(l * sx, r * sx))) AS x1,
    greatest(0.0, least(842.0, CASE WHEN contains(origin, 'top') THEN 842.0 - greatest(t * sy, b * sy) ELSE least(t * sy, b * sy) END)) AS y0,
    greatest(0.0, least(842.0, CASE WHEN contains(origin, 'top') THEN 842.0 - least(t * sy, b * sy) ELSE greatest(t * sy, b * sy) END)) AS y1
  FROM u)
SELECT doc_id, element_index, box_index, page, round(CAST(x0 AS DOUBLE), 4) AS x0, round(CAST(y0 AS DOUBLE), 4) AS y0, round(CAST(CASE WHEN x1 <= x0 THEN least(595.0, x0 + 1) ELSE x1 END AS DOUBLE), 4) AS x1,
  round(CAST(CASE WHEN y1 <= y0 THEN least(842.0, y0 + 1) ELSE y1 END AS DOUBLE), 4) AS y1 FROM p""",
    "audit_labels": f"""WITH {_FRAMES}
SELECT doc_id, element_index, box_index, printf('H%02d C%03d:', {_RANK}, element_index) || element_type || ' prev=' || CASE WHEN prev_index IS NULL THEN 'none' ELSE printf('C%03d', prev_index) END
  || ' next=' || CASE WHEN next_index IS NULL THEN 'none' ELSE printf('C%03d', next_index) END AS label
FROM frames LEFT JOIN chain USING (doc_id, element_index)""",
    "audit_legend": f"WITH {_FRAMES} SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY {_RANK}, element_type) AS position, element_type, {_COLOUR} AS colour FROM (SELECT DISTINCT doc_id, element_type FROM frames)",
    "seeded_sample": f"""SELECT doc_id, row_number() OVER (ORDER BY k, doc_id) || '.pdf' AS output FROM (
  SELECT doc_id, sha256('{SEED}:' || doc_id) AS k FROM (SELECT DISTINCT doc_id FROM ({_ELIGIBLE})) ORDER BY k, doc_id LIMIT {SAMPLE})""",
}
