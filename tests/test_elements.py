"""Element operators on literal cases and against a plain restatement of the rules."""

import random

import pytest
from pyspark.sql import functions as F

from quire.operators import elements as el
from quire.operators import metadata as md
from quire.operators import nodes

SCHEMA = (
    "doc_id string, element_id string, element_type string, text string, page int, ord int, section_path array<string>, table_rows array<array<string>>, "
    "bboxes array<struct<page:int,l:double,t:double,r:double,b:double,origin:string>>"
)


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "v string").select(make(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    ("text", "refs", "kind"),
    [
        ("Fig 3", False, "paragraph"), ("fig. 3", False, "figure_caption"), ("Figure3 x", False, "figure_caption"), ("see http://h/x?a=b", False, "equation"), ("a = b", False, "paragraph"),
        ("E = m*c", False, "equation"), ("a | b | c", False, "table"), ("a | b", False, "paragraph"), ("a | b\nc | d", False, "table"), ("a\tb", False, "table"), ("Figure 1", True, "references"), ("", False, "paragraph"),
    ],
)
def test_classify(spark, text, refs, kind):
    assert one(spark, text, lambda c: el.classify(c, F.lit(refs))) == kind


@pytest.mark.parametrize(
    ("text", "rows"),
    [("a || b", [["a", "b"]]), ("h1 | h2\n--- | ---\n1 | 2", [["h1", "h2"], ["1", "2"]]), ("a\tb", [["a", "b"]]), ("a  b c", [["a", "b c"]]), ("", []), ("|||", [])],
)
def test_table_rows(spark, text, rows):
    assert one(spark, text, el.table_rows) == rows


def test_serialised_rows_take_nulls_and_empty_rows(spark):
    rows = spark.createDataFrame([([["a", None], [], ["b"]],), (None,)], "r array<array<string>>")
    assert [r[0] for r in rows.select(el.serialise_rows(F.col("r"))).collect()] == ["a | \nb", ""]


def test_boxes(spark):
    kind = "array<struct<page:int,l:double,t:double,r:double,b:double,origin:string>>"
    df = spark.createDataFrame([([(0, 1.0, 2.0, 3.0, 4.0, None), (2, None, 2.0, 3.0, 4.0, "TOP"), None, (3, 0.0, 0.0, 0.0, 0.0, "BottomLeft")],)], f"b {kind}")
    boxes = df.select(el.normal_boxes(F.col("b"))).first()[0]
    assert [(b.page, b.l, b.origin) for b in boxes] == [(1, 1.0, "unknown"), (3, 0.0, "bottomleft")]


def fold(items):
    """Section paths by the plain fold over headings."""
    path, out = [], []
    for label, level, text in items:
        if label == "section_header" and level > 0:
            path = path[: level - 1] + ["section"] * (level - 1 - len(path)) + [text]
        out.append(list(path))
    return out


def test_one_document_of_200_000_items_is_no_task_of_its_own(spark):
    n, i = 200_000, F.col("id")
    head = i % 50 == 0
    items = spark.range(n).select(
        F.lit("d").alias("doc_id"), i.alias("seq"), F.when(head, "section_header").otherwise("text").alias("label"), F.when(head, (1 + i / 50 % 2).cast("int")).alias("level"),
        F.lit(None).cast("int").alias("page"), F.when(i % 1000 == 7, " ").otherwise(F.concat(F.lit("t"), i.cast("string"))).alias("text"),
    )
    # Partitions of a few megabytes would be read by one task.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    out = el.sectioned_items(items)
    last = F.concat(F.lit("t"), (i - i % 50).cast("string"))
    got = out.withColumns({"id": F.col("seq"), "task": F.spark_partition_id()}).agg(F.count("*").alias("n"), F.max("ord").alias("most"), F.count_if(F.element_at("section_path", -1) == last).alias("right"), F.count_distinct("task").alias("tasks")).first()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert (got.n, got.most, got.right) == (n - 200, n - 200, n - 200) and got.tasks > 1
    assert out.where("seq = 77").first().section_path == ["t0", "t50"]


def test_section_paths_equal_the_fold(spark):
    rng, rows, expected = random.Random(3), [], {}
    for doc in range(60):
        items = [("section_header", rng.choice([0, 1, 1, 2, 2, 3, 4, 9]), f"h{i}") if rng.random() < 0.5 else ("text", None, f"t{i}") for i in range(rng.randint(1, 14))]
        expected |= {(f"d{doc}", i + 1): p for i, p in enumerate(fold(items))}
        rows += [(f"d{doc}", i + 1, i + 1, *item) for i, item in enumerate(items)]
    df = spark.createDataFrame(rows, "doc_id string, seq int, ord int, label string, level int, text string")
    assert {(r.doc_id, r.ord): r.section_path for r in el.with_sections(df).collect()} == expected


def random_elements(rng, doc, n):
    kinds = ["paragraph", "paragraph", "references", "table", "section_heading", "figure_caption", "equation", "title"]
    page, path, out = 1, [], []
    for i in range(n):
        page += rng.random() < 0.2
        kind = rng.choice(kinds)
        if kind == "section_heading":
            path = [rng.choice("ABC")]
        text = rng.choice(["x y", "", None, " ", "long text here"])
        out.append((doc, f"{doc}-{i}", kind, text, rng.choice([page, page, page, None, 0]), i, list(path), [["c"]] if kind == "table" else None, None))
    return out


def cleaned(rows):
    out = []
    for r in rows:
        text = (r[3] or "").strip() or ("[equation]" if r[2] == "equation" else "")
        if text:
            out.append([r[0], r[2], text, r[4] if (r[4] or 0) > 0 else 1, r[6]])
    return out


def merged_plainly(rows):
    out = []
    for doc, kind, text, page, path in cleaned(rows):
        last = out[-1] if out else None
        if last and kind in el.JOINABLE and last["last"] == (kind, page, path):
            last["text"] += "\n" + text
        else:
            out.append({"doc": doc, "ord": len(out) + 1, "type": kind, "text": text, "page": page, "path": path})
        out[-1]["last"] = (kind, page, path)
    return out


def test_merging_parents_and_context_equal_the_plain_rules(spark):
    """Over more elements than a block holds, with repeated rows, blank texts and missing pages."""
    rng = random.Random(11)
    docs = {f"d{k}": random_elements(rng, f"d{k}", n) for k, n in enumerate([1, 3, 20, 40, 1300])}
    rows = [r for d in docs.values() for r in d]
    merged = el.merge_adjacent(spark.createDataFrame(rows + rows[::3], SCHEMA)).cache()
    got = {(r.doc_id, r.ord): (r.element_type, r.text, r.page, r.section_path) for r in merged.collect()}
    plain = {d: merged_plainly(x) for d, x in docs.items()}
    assert got == {(m["doc"], m["ord"]): (m["type"], m["text"], m["page"], m["path"]) for x in plain.values() for m in x}

    parents, context = {}, {}
    for d, x in plain.items():
        index = 0
        for n, m in enumerate(x):
            if n == 0 or m["type"] == "section_heading":
                index += 1
                parents[d, index] = [m["path"] or ["front_matter"], []]
            parents[d, index][1].append(m["text"])
            if m["type"] == "figure_caption":
                found = ""
                for later in x[n + 1 :]:
                    if (later["page"], later["path"]) != (m["page"], m["path"]):
                        break
                    if later["type"] == "paragraph":
                        found = later["text"]
                        break
                context[d, m["ord"]] = found
    built = nodes.parent_nodes(merged)
    assert {(r.doc_id, r.parent_index): [r.section_path, r.text.split("\n")] for r in built.collect()} == {k: [p, "\n".join(t).split("\n")] for k, (p, t) in parents.items()}
    assert {(r.doc_id, r.ord): r.context for r in nodes.figure_context(merged).collect()} == context

    ids = {(r.doc_id, r.parent_index): r.parent_id for r in built.collect()}
    for r in nodes.parent_lookup(merged, built).collect():
        paths = {i: p for (d, i), (p, _) in parents.items() if d == r.doc_id}
        same = [i for i, p in sorted(paths.items()) if p == r.section_path] or [i for i, p in sorted(paths.items()) if r.section_path and p[-1] == r.section_path[-1]] or [1]
        assert r.parent_id == ids[r.doc_id, same[0]]


@pytest.mark.parametrize(("size", "overlap"), [(3, 1), (3, 5), (0, 2), (-1, 0), (4, -2), (800, 120)])
def test_token_windows(spark, size, overlap):
    texts = [" ".join(f"w{i}" for i in range(n)) for n in range(12)] + [None, " \n "]

    def expected(text):
        words = (text or "").split()
        if not words or size <= 0:
            return [" ".join(words)] if words else []
        step, out = max(size - max(overlap, 0), 1), []
        for start in range(0, len(words), step):
            out.append(" ".join(words[start : start + size]))
            if start + size >= len(words):
                break
        return out

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {}
    for r in nodes.token_windows(df, size, overlap).orderBy("chunk_index").collect():
        got.setdefault(r.i, []).append(r.chunk)
    assert [got.get(i, []) for i in range(len(texts))] == [expected(t) for t in texts]


def test_authors_year_and_title(spark):
    def row(ord, kind, text, page=1):
        return ("d", f"e{ord}", kind, text, page, ord, [], None, None)

    rows = [row(0, "paragraph", "Before Title"), row(1, "title", "T"), row(2, "equation", "Ann Lee"), row(3, "figure_caption", "a@b c"), row(4, "table", "Bob Ray Coe"), row(5, "section_heading", "Intro 1999"), row(6, "equation", "No One")]
    merged = el.merge_adjacent(spark.createDataFrame(rows, SCHEMA))
    assert md.paper_authors(merged).first().authors == ["Ann Lee", "Bob Ray Coe"]
    assert md.paper_titles(merged).first().paper_title == "T"
    assert md.paper_years(merged).first().year == 1999


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    merged = el.merge_adjacent(empty)
    parents = nodes.parent_nodes(merged)
    assert merged.count() == parents.count() == nodes.child_nodes(merged, parents, 800, 120).count() == md.paper_authors(merged).count() == 0
