"""Discovery, parsing, JSON lines, snapshots."""

import json

import pytest

from quire.sources import files, jsonl, parse


def write(root, contents):
    for path, content in contents.items():
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_bytes(content if isinstance(content, bytes) else content.encode())


def listed(spark, root, **kw):
    return [r.relative_path for r in files.discover(spark, str(root), **kw).collect()]


def test_discovery_sees_hidden_names_and_skips_excluded_directories(spark, tmp_path):
    write(tmp_path, dict.fromkeys(["papers/one.md", "papers/two.txt", "papers/three.csv", ".git/ignored.md", "a/b/node_modules/x.md", "a/b/c/d.MD", "_u/a.md", ".h/b.md", ".y.md", "_x.md", ".md", "z/.git.md"], "x"))
    assert set(listed(spark, tmp_path)) == {"papers/one.md", "papers/two.txt", "a/b/c/d.MD", "_u/a.md", ".h/b.md", ".y.md", "_x.md", "z/.git.md"}
    assert set(listed(spark, tmp_path, extensions=(".txt",))) == {"papers/two.txt"}


def test_limit_is_by_path_components(spark, tmp_path):
    write(tmp_path, dict.fromkeys(["a-b/c.md", "a.b.md", "a/b.md", "b.md"], "x"))
    assert set(listed(spark, tmp_path, max_files=2)) == {"a/b.md", "a-b/c.md"}
    with pytest.raises(ValueError, match="positive"):
        listed(spark, tmp_path, max_files=0)


def test_root_below_an_excluded_directory_is_empty(spark, tmp_path):
    write(tmp_path, {".venv/docs/a.md": "x"})
    assert listed(spark, tmp_path / ".venv/docs") == []
    with pytest.raises(Exception, match="no such directory"):
        listed(spark, tmp_path / "absent")


def file_rows(spark, rows):
    return spark.createDataFrame([(p, p[p.rindex(".") :], c) for p, c in rows], "relative_path string, file_ext string, content binary")


def test_markdown_items(spark):
    out = parse.text_items(file_rows(spark, [("a.md", b"# Title\n\nBody one\nBody two\n## Part\n### Deep\n#none\n"), ("b.txt", b"\xffA"), ("c.txt", None), ("d.txt", b"")])).orderBy("doc_id", "seq").collect()
    by = {}
    for r in out:
        by.setdefault(r.text[:1] == "ÿ", []).append((r.label, r.level, r.text))
    assert by[False] == [("title", None, "Title"), ("text", None, "Body one"), ("text", None, "Body two"), ("section_header", 1, "Part"), ("section_header", 2, "Deep"), ("text", None, "#none")]
    assert by[True] == [("text", None, "ÿA")]


def test_converters_are_isolated(spark):
    def pdf(content):
        if content == b"bad":
            raise ValueError("broken file payload")
        return ("PARTIAL_SUCCESS" if content == b"ok" else "failure"), [{"label": "text", "text": "hi", "page": 2}]

    items, failed = parse.items(file_rows(spark, [("a.pdf", b"ok"), ("b.pdf", b"bad"), ("c.pdf", b"no"), ("d.doc", b"x"), ("e.md", None), ("f.md", b"t")]), {".pdf": pdf})
    assert sorted((r.text, r.page) for r in items.collect()) == [("hi", 2), ("t", 1)]
    reasons = {r.relative_path: r.error for r in failed.collect()}
    assert set(reasons) == {"b.pdf", "c.pdf", "d.doc", "e.md"} and "broken file payload" in reasons["b.pdf"]


def test_jsonl(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text('{"a": 1}\n\n{"a": 2, "b": null}\n')
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("a", T.IntegerType())])
    assert jsonl.read_strict(spark, str(path), schema).count() == 2
    path.write_text('{"a": 1}\n[1]\n{"a": \n')
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        jsonl.read_strict(spark, str(path), schema).collect()
    good, bad = jsonl.read_lenient(spark, str(path), schema)
    assert [r.a for r in good.collect()] == [1] and bad.count() == 2
    out = tmp_path / "out"
    rows = spark.createDataFrame([(1, None)], "a int, b string")
    assert jsonl.write_jsonl(rows, str(out)) and not jsonl.write_jsonl(rows.limit(0), str(out))
    lines = [json.loads(x) for f in out.glob("*.json") for x in f.read_text().splitlines()]
    assert lines == [{"a": 1, "b": None}]


def test_snapshots(spark, tmp_path):
    store = jsonl.Snapshots(spark, str(tmp_path / "s"), "a int")
    assert store.read().count() == 0
    store.write(spark.createDataFrame([(1,)], "a int"))
    held = store.read()
    store.write(held.union(spark.createDataFrame([(2,)], "a int")))
    assert sorted(r.a for r in store.read().collect()) == [1, 2] and held.count() == 1
