"""Nested records as flat tables, against literal layouts."""

import json

from pyspark.sql import functions as F

from quire.operators import flatten

A, B, C = "a" * 40, "b" * 40, "c" * 40


def tables(spark, records, key="line_no"):
    lines = [r if r is None or isinstance(r, str) else json.dumps(r) for r in records]
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(lines)], "line_no bigint, line string, record string")
    inlining = flatten.shared_inlining(flatten.schema_graph(df))
    return inlining, flatten.document_tables(flatten.shred(df, inlining))


def found(spark, records):
    return {tuple(r) for r in flatten.links(tables(spark, records)[1]).collect()}


ELEMENT = {"element_id": A, "text": "[1]", "metadata": {"bboxes": [None, {"left": "1.5", "top": 2, "x1": 3, "bottom": 4}, {"l": 1, "t": 2, "r": None, "b": 4}], "rows": [["x", None], [], ["y"]]}}
EXPECTED = {(0, "element", A, "d"), (0, "bbox", f"{A}#1", A), (0, "row", f"{A}#0", A), (0, "row", f"{A}#1", A), (0, "row", f"{A}#2", A)}


def test_layouts_give_the_same_tables(spark):
    plain = {"doc_id": "d", "elements": [ELEMENT, None, "x"]}
    keyed = {"doc_id": "d", "elements": {A: {k: v for k, v in ELEMENT.items() if k != "element_id"}}}
    paged = {"doc_id": "d", "pages": [{"page": 1, "elements": [ELEMENT]}]}
    wrapped = {"version": 2, "document": plain}
    written = {"doc_id": "d", "elements": [ELEMENT | {"metadata": json.dumps(ELEMENT["metadata"])}]}
    for record in (plain, keyed, paged, wrapped, written):
        # With the plain layout beside it, as the schema is that of all records.
        assert {r for r in found(spark, [record, plain]) if r[0] == 0} == EXPECTED


def test_lone_boxes_children_and_links(spark):
    record = {
        "doc_id": "d",
        "elements": [{"element_id": A, "metadata": {"bboxes": {"x0": 0, "y0": 0, "x1": 1, "y1": 1}}}, {"element_id": B, "metadata": {"bboxes": [{"x0": 0, "y0": 0, "x1": 1, "y1": "no"}]}}, {"text": "no id"}],
        "parent_nodes": [{"parent_id": B, "child_nodes": [{"child_id": "k1"}, {"child_id": "k2", "parent_id": "else"}]}],
        "child_nodes": [{"child_id": "k3", "parent_id": "absent"}, {"child_id": "k4", "parent_id": None}, {"child_id": None}, "null", {"child_id": "k3", "parent_id": "absent"}],
    }
    assert found(spark, [record]) == {
        (0, "element", A, "d"), (0, "element", B, "d"), (0, "bbox", f"{A}#0", A), (0, "parent", B, "d"),
        (0, "child", "k1", B), (0, "child", "k2", "else"), (0, "child", "k3", "absent"), (0, "child", "k4", ""),
    }


def test_types_are_shared_by_in_degree(spark):
    """One type below several owners has a table, though it is never in a list; one that differs, or has one owner, is inlined."""
    record = {"left": {"author": {"name": "Ann", "born": 1900}}, "right": {"author": {"name": "Bob", "born": None}, "place": {"name": "x"}}, "other": {"author": "Cid", "place": {"street": "y"}}}
    df = spark.createDataFrame([(0, json.dumps(record)), (1, json.dumps(record))], "line_no bigint, line string")
    inlining = flatten.shared_inlining(flatten.schema_graph(df))
    assert not inlining.relations and inlining.shared == {"record.left.author": "author", "record.right.author": "author"}
    rows = flatten.shred(df, inlining).collect()
    authors = {(r.record, r.parent_relation, r.parent_node, r.map_key, r.fields["name"]) for r in rows if r.relation == "author"}
    assert authors == {(n, "record", 0, key, name) for n in (0, 1) for key, name in (("left.author", "Ann"), ("right.author", "Bob"))}
    (top,) = (r.fields for r in rows if r.relation == "record" and r.record == 0)
    assert top == {"right.place.name": "x", "other.author": "Cid", "other.place.street": "y"}


def test_titles_of_layouts_that_share_metadata(spark):
    records = [{"doc_id": "a", "metadata": {"title": "A"}}, {"document": {"doc_id": "b", "metadata": {"title": "B"}}}, {"doc_id": "c"}]
    inlining, got = tables(spark, records)
    assert set(inlining.shared.values()) == {"metadata"}
    assert {(r.record, r.doc_id, r.title) for r in got["records"].collect()} == {(0, "a", "A"), (1, "b", "B"), (2, "c", None)}


def test_a_list_between_owner_and_owned(spark):
    record = {"doc_id": "d", "elements": [{"element_id": A, "metadata": [{"bboxes": [{"l": 1, "t": 1, "r": 1, "b": 1}]}]}]}
    assert found(spark, [record]) == {(0, "element", A, "d"), (0, "bbox", f"{A}#0", A)}


def test_children_written_as_a_string(spark):
    record = {"doc_id": "d", "child_nodes": json.dumps([{"child_id": "k", "parent_id": "p"}])}
    assert found(spark, [record]) == {(0, "child", "k", "p")}


def test_what_is_no_record(spark):
    assert found(spark, [None, "", "  ", "[]", "1", "null", '{"doc_id": "d", "elements": [', "{} {}"]) == set()


def test_recursive_and_shared_types_get_tables(spark):
    tree = {"doc_id": "d", "node": {"name": "r", "node": {"name": "s", "node": {"name": "t"}}}, "one": {"deep": {"x": 1}}}
    inlining, _ = tables(spark, [tree])
    assert inlining.relations == {"node"}
    df = spark.createDataFrame([(7, json.dumps(tree))], "line_no bigint, line string")
    rows = {(r.relation, r.node): r for r in flatten.shred(df, inlining).collect()}
    assert rows["node", 1].parent_node == 0 and rows["node", 2].parent_node == 1 and rows["node", 3].fields == {"name": "t"}
    assert rows["record", 0].fields["one.deep.x"] == "1"


def test_every_foreign_key_leads_somewhere(spark, data):
    lines = spark.read.parquet(f"{data}/parsed_jsonl.parquet")
    nodes = flatten.shred(lines, flatten.shared_inlining(flatten.schema_graph(lines))).cache()
    parents = nodes.select("record", F.col("relation").alias("parent_relation"), F.col("node").alias("parent_node"))
    assert nodes.where("parent_node is not null").join(parents, ["record", "parent_relation", "parent_node"], "left_anti").count() == 0
    assert nodes.groupBy("record", "node").count().where("count > 1").count() == 0


def test_empty_table(spark):
    inlining, made = tables(spark, [])
    assert flatten.links(made).count() == 0 and not inlining.relations
