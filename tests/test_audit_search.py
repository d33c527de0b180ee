"""Audit geometry and exact search on literal cases."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators import audit, report, search

SCHEMA = "doc_id string, element_id string, element_type string, text string, ord int, bboxes array<struct<page:int,l:double,t:double,r:double,b:double,origin:string>>"


def indexed(spark, rows):
    return audit.numbered(spark.createDataFrame(rows, SCHEMA))


def test_labels_chain_and_legend(spark):
    rows = [
        ("d", "p1", "paragraph", "x", 0, [(1, 100.0, 120.0, 200.0, 170.0, "BOTTOMLEFT")]), ("d", "p2", "table", "y", 1, [(1, 0.2, 0.2, 0.5, 0.35, "topleft")]), ("d", "p3", "paragraph", "no box", 2, None),
        ("d", "p4", "paragraph", "Terminal value = 1513/1244 - 1", 3, [(2, 1.0, None, 1.0, 1.0, None), None]), ("d", "p5", "odd", "z", 4, [(None, 0.0, 0.0, 0.0, 0.0, None)]),
    ]
    ix = indexed(spark, rows + rows[:1])
    framed = audit.frames(ix)
    got = {r.element_id: r.label for r in audit.labels(framed, audit.chain(ix)).collect()}
    assert got == {"p1": "H03 C001:paragraph prev=none next=C002", "p2": "H04 C002:table prev=C001 next=C004", "p5": "H08 C005:odd prev=C004 next=none"}
    assert [(r.element_type, r.colour) for r in audit.legend(framed).orderBy("position").collect()] == [("paragraph", "166534"), ("table", "1d4ed8"), ("odd", "dc2626")]


@pytest.mark.parametrize(("text", "yes"), [("Terminal value = 1513/1244", True), ("x = 5", True), ("a = b", False), ("no 5", False), ("x = (5", True), ("= 5", False)])
def test_equation_override(spark, text, yes):
    assert spark.createDataFrame([(text,)], "t string").select(audit.looks_like_equation(F.col("t"))).first()[0] is yes


@pytest.mark.parametrize(
    ("box", "rect"),
    [((0.2, 0.2, 0.5, 0.35, "topleft"), (119.0, 547.3, 297.5, 673.6)), ((100.0, 120.0, 200.0, 170.0, "bottomleft"), (100.0, 120.0, 200.0, 170.0)), ((10.0, 20.0, 5.0, 20.0, "unknown"), (5.0, 20.0, 10.0, 21.0)), ((-5.0, 900.0, 700.0, 950.0, "b"), (0.0, 842.0, 595.0, 842.0)), ((0.0, 0.0, 0.0, 0.0, "b"), (0.0, 0.0, 1.0, 1.0))],
)
def test_rects(spark, box, rect):
    df = spark.createDataFrame([box], "l double, t double, r double, b double, origin string")
    r = audit.with_rect(df).first()
    assert (r.x0, r.y0, r.x1, r.y1) == pytest.approx(rect)


def test_sample(spark):
    df = spark.createDataFrame([(f"d{i}",) for i in range(20)], "doc_id string")
    first, again = (sorted(map(tuple, audit.seeded_sample(df.repartition(n), 5, 3).collect())) for n in (1, 4))
    assert first == again and {o for _, o in first} == {f"{i}.pdf" for i in range(1, 6)}
    with pytest.raises(ValueError, match="positive"):
        audit.seeded_sample(df, 0, 1)


def test_legend_layout(spark):
    items = spark.createDataFrame([("d", 1, "title", "b51f1f"), ("d", 2, "table", "1d4ed8")], "doc_id string, position int, element_type string, colour string")
    got = {r.position: (r.text, r.x0, r.y0, r.x1, r.y1) for r in audit.legend_boxes(items, 600.0, 800.0).collect()}
    assert got == {0: ("Label Colors (Hierarchy)", 396.0, 774.0, 588.0, 788.0), 1: ("H01 title", 396.0, 762.0, 588.0, 772.0), 2: ("H04 table", 396.0, 750.0, 588.0, 760.0)}


def test_audit_reads_parsed_documents(spark, tmp_path):
    from quire.plans import run

    (tmp_path / "a.pdf").write_bytes(b"x")
    box = {"page": 1, "l": 0.1, "t": 0.1, "r": 0.2, "b": 0.2, "origin": "top"}
    doc = lambda name, path, boxes: json.dumps({"doc_id": name, "metadata": {"source_path": str(tmp_path / path)}, "elements": [{"element_id": f"{name}1", "element_type": "table", "text": "x", "order": 1, "metadata": {"bboxes": boxes}}]})
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs/a.json").write_text("\n".join([doc("a", "a.pdf", [box]), doc("gone", "b.pdf", [box]), doc("bare", "a.pdf", []), doc("text", "a.md", [box]), "{broken", "", "[1]"]))
    elements = run.audit_elements(spark, str(tmp_path / "docs"))
    assert [(r.doc_id, r.element_index, r.page) for r in audit.frames(audit.numbered(elements)).collect()] == [("a", 1, 1)]


@pytest.mark.parametrize("distance", ["cosine", "dot", "euclid", "manhattan"])
def test_nearest_equals_brute_force(spark, distance, monkeypatch):
    monkeypatch.setattr(search, "BLOCK", 7)
    rng = np.random.default_rng(2)
    x = rng.integers(-3, 4, (40, 4)).astype(float)
    x[5] = 0
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(100, None), (101, [1.0, None, 1.0, 1.0]), (102, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    got = {}
    for r in search.nearest(df.where("vec_id % 10 = 0"), df, distance, 5).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append(r.neighbour_id)
    for q in range(0, 40, 10):
        norms = np.linalg.norm(x, axis=1) * np.linalg.norm(x[q])
        score = {"cosine": -np.where(norms > 0, x @ x[q] / np.where(norms > 0, norms, 1), 0), "dot": -(x @ x[q]), "euclid": np.linalg.norm(x - x[q], axis=1), "manhattan": np.abs(x - x[q]).sum(axis=1)}[distance]
        assert got[q] == [i for i in np.lexsort((np.arange(40), np.round(score, 6) + 0.0)) if i != q][:5]
    with pytest.raises(ValueError, match="distance"):
        search.nearest(df, df, "far")


def test_reports(spark):
    df = spark.createDataFrame([(1, 2), (3, None)], "a int, b int")
    got = {r.metric: (r.n, r.mean, r.min, r.max) for r in report.describe(df, ["a", "b"]).collect()}
    assert got == {"a": (2, 2.0, 1.0, 3.0), "b": (1, 2.0, 2.0, 2.0)}
    texts = spark.createDataFrame([("w " * 7,), (None,), ("",)], "text string")
    assert report.robustness(texts, [("X", 3, 1)]).first() == ("X 3/1", 3, 3.0, 3.0)
