"""Whole runs: parse and index a folder, twice."""

import json

import pytest

from quire import cli
from quire.config import IndexConfig, ParseConfig, load_yaml, resolve
from quire.plans import run

PAPER = """# Bitcoin Whitepaper
Ann Lee, Bob Ray
Published 2017
## Introduction
This is a paragraph that is long enough to be kept by the filter.
Figure 1: Flow of blocks
E = m*c + 1
a | b | c
1 | 2 | 3
## References
[1] Somebody, Something
"""


def configs(tmp_path):
    parse = ParseConfig(str(tmp_path / "in"), str(tmp_path / "docs"), str(tmp_path / "manifest"), str(tmp_path / "state"), preview_characters=20)
    index = IndexConfig(str(tmp_path / "docs"), str(tmp_path / "index"), str(tmp_path / "vectors"), "m", "", embedding_provider="hash", vector_size=16)
    return parse, index


def read_json(folder):
    return [json.loads(line) for f in folder.glob("*.json") for line in f.read_text().splitlines()]


def test_parse_and_index_twice(spark, tmp_path):
    (tmp_path / "in/crypto-papers").mkdir(parents=True)
    (tmp_path / "in/crypto-papers/btc.md").write_text(PAPER)
    (tmp_path / "in/short.txt").write_text("short")
    (tmp_path / "in/bad.pdf").write_bytes(b"x")
    parse, index = configs(tmp_path)
    assert run.parse_folder(spark, parse) == {"discovered": 3, "skipped": 0, "parsed": 1, "failed": 1}
    (doc,) = read_json(tmp_path / "docs")
    assert doc["metadata"]["title"] == "Bitcoin Whitepaper" and doc["metadata"]["topic"] == "crypto-papers" and doc["metadata"]["year"] == 2017
    assert {e["element_type"] for e in doc["elements"]} == {"title", "section_heading", "paragraph", "table", "figure_caption", "equation", "references"}
    assert {c["chunk_type"] for c in doc["child_nodes"]} == {"text", "table", "figure"}
    (entry,) = read_json(tmp_path / "manifest/documents")
    (header,) = read_json(tmp_path / "manifest/header")
    assert (header["document_count"], header["total_characters"], header["source_dir"]) == (1, len(doc["text"]), parse.source_dir) and header["generated_at_utc"].endswith("+00:00")
    (first, *_), (parent, *_), (child, *_) = doc["elements"], doc["parent_nodes"], doc["child_nodes"]
    assert set(first) == {"element_id", "element_type", "text", "page", "order", "section_path", "metadata"} and set(first["metadata"]) == {"bboxes", "rows"} and first["order"] == 1
    assert set(parent) == {"parent_id", "doc_id", "section_path", "page_start", "page_end", "text", "metadata"} and parent["metadata"]["paper_title"] == "Bitcoin Whitepaper" and parent["metadata"]["chunk_level"] == "parent"
    assert set(child) == {"child_id", "parent_id", "doc_id", "chunk_level", "chunk_type", "section_path", "page_start", "page_end", "text", "metadata"} and child["metadata"]["chunk_index"] == 1
    assert [c["chunk_type"] != "text" for c in doc["child_nodes"]] == sorted(c["chunk_type"] != "text" for c in doc["child_nodes"])
    assert entry["text_preview"].endswith("...") and entry["index"] == 1
    n = len(doc["child_nodes"])
    assert run.index_documents(spark, index) == {"upserted": n, "skipped": 0, "deleted": 0}
    assert run.index_documents(spark, index) == {"upserted": 0, "skipped": n, "deleted": 0}
    assert run.parse_folder(spark, parse)["skipped"] == 1
    assert read_json(tmp_path / "docs") == [doc]

    (tmp_path / "in/crypto-papers/btc.md").write_text(PAPER.replace("long enough", "surely long enough"))
    assert run.parse_folder(spark, parse)["parsed"] == 1
    changed = run.index_documents(spark, index)
    assert changed["upserted"] >= 1 and changed["upserted"] + changed["skipped"] == n
    vectors = run.jsonl.Snapshots(spark, index.vector_dir, "point_id string, doc_id string, text string, embedding array<float>").read()
    assert vectors.count() == n and vectors.where("size(embedding) = 16").count() == n


def test_recreating_writes_everything_again(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.md").write_text(PAPER)
    parse, index = configs(tmp_path)
    run.parse_folder(spark, parse)
    first = run.index_documents(spark, index)
    again = run.index_documents(spark, IndexConfig(**{**index.__dict__, "recreate": True}))
    assert again == first


def test_points_carry_their_whole_payload(spark, tmp_path):
    (tmp_path / "in/crypto-papers").mkdir(parents=True)
    (tmp_path / "in/crypto-papers/btc.md").write_text(PAPER)
    parse, index = configs(tmp_path)
    run.parse_folder(spark, parse)
    run.index_documents(spark, index)
    (doc,) = read_json(tmp_path / "docs")
    sections = {p["parent_id"]: p["metadata"]["section"] for p in doc["parent_nodes"]}
    payloads = [r.payload.asDict() for r in run.jsonl.Snapshots(spark, index.vector_dir, run.VECTORS).read().collect()]
    assert len(payloads) == len(doc["child_nodes"])
    for p in payloads:
        assert (p["doc_id"], p["relative_path"], p["topic"], p["paper_title"], p["year"]) == (doc["doc_id"], "crypto-papers/btc.md", "crypto-papers", "Bitcoin Whitepaper", 2017)
        assert p["authors"] == doc["metadata"]["authors"] and p["section"] == sections[p["parent_id"]]
    by = {p["chunk_type"]: p for p in payloads}
    assert by["table"]["table_rows"] == [["a", "b", "c"], ["1", "2", "3"]] and by["text"]["chunk_index"] == 1
    assert by["figure"]["figure_context"] == next(c["metadata"]["figure_context"] for c in doc["child_nodes"] if c["chunk_type"] == "figure")


def test_metadata_of_a_chunk_overrides_the_base_keys(spark, tmp_path):
    own = {"title": "Own", "section": "Own section", "page_end": 9, "figure_context": "beside it", "year": 1999}
    child = {"child_id": "c", "parent_id": "p", "doc_id": "d", "chunk_type": "figure", "page_start": 1, "page_end": 2, "text": "Figure 1"}
    doc = {"doc_id": "d", "text": "x", "metadata": {"title": "Base", "year": 2000, "paper_title": "Paper"}, "parent_nodes": [{"parent_id": "p", "metadata": {"section": "Parent's", "authors": ["Ann"]}}], "child_nodes": [child | {"metadata": own}, child | {"child_id": "e"}]}
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs/a.json").write_text(json.dumps(doc))
    _, index = configs(tmp_path)
    run.index_documents(spark, index)
    rows = {r.payload.page_end: r.payload for r in run.jsonl.Snapshots(spark, index.vector_dir, run.VECTORS).read().collect()}
    keys = ("title", "section", "figure_context", "year", "authors", "paper_title")
    assert tuple(rows[9][k] for k in keys) == ("Own", "Own section", "beside it", 1999, ["Ann"], "Paper")
    assert tuple(rows[2][k] for k in keys) == ("Base", "Parent's", None, 2000, ["Ann"], "Paper")


def test_state_survives_and_collections_keep_their_properties(spark, tmp_path):
    store = run.jsonl.Snapshots(spark, str(tmp_path / "s"), "a int")
    assert store.read().count() == 0
    versions = [store.write(spark.createDataFrame([(n,)], "a int")) for n in range(4)]
    assert [r.a for r in store.read().collect()] == [3]
    assert [(tmp_path / "s" / v).exists() for v in versions] == [False, False, True, True]
    # A version without a pointer, as a crash leaves it, doesn't count.
    spark.createDataFrame([(9,)], "a int").write.parquet(str(tmp_path / "s/v-x"))
    assert [r.a for r in store.read().collect()] == [3]
    _, index = configs(tmp_path)
    run._collection(spark, index)
    run._collection(spark, index)
    with pytest.raises(ValueError, match="size 16"):
        run._collection(spark, IndexConfig(**{**index.__dict__, "vector_size": 8}))
    run._collection(spark, IndexConfig(**{**index.__dict__, "vector_size": 8, "recreate": True}))
    with pytest.raises(ValueError, match="size 8"):
        run._collection(spark, index)


def test_a_point_with_two_texts_is_refused(spark, tmp_path):
    child = {"child_id": "c", "doc_id": "d", "chunk_type": "text", "text": "one"}
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs/a.json").write_text(json.dumps({"doc_id": "d", "child_nodes": [child, child, child | {"text": "\t \n"}]}))
    _, index = configs(tmp_path)
    assert run.index_documents(spark, index) == {"upserted": 1, "skipped": 1, "deleted": 0}
    (tmp_path / "docs/a.json").write_text(json.dumps({"doc_id": "d", "child_nodes": [child, child | {"text": "two"}]}))
    with pytest.raises(ValueError, match="different chunks"):
        run.index_documents(spark, index)


def test_config(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("parse:\n  source_dir: a\n  output_jsonl: b\n  output_manifest: c\n  state_dir: d\n  min_characters: 9\n  skip_unchanged: 'false'\n")
    section = load_yaml(str(path))["parse"]
    config = resolve(ParseConfig, section, {"source_dir": "", "min_characters": 0, "max_files": None})
    assert (config.source_dir, config.min_characters, config.skip_unchanged, config.max_files, config.chunk_size) == ("a", 0, False, None, 800)
    path.write_text("")
    assert load_yaml(str(path)) == {}
    path.write_text("- a")
    with pytest.raises(ValueError, match="no mapping"):
        load_yaml(str(path))
    with pytest.raises(ValueError, match="missing"):
        resolve(ParseConfig, {}, {})
    with pytest.raises(ValueError, match="section"):
        resolve(ParseConfig, ["x"], {})
    with pytest.raises(ValueError, match="distance"):
        IndexConfig("a", "b", "c", "d", "e", distance="far")
    with pytest.raises(ValueError, match="provider"):
        IndexConfig("a", "b", "c", "d", "e", embedding_provider="local")


def test_named_converters_and_excluded_directories(spark, tmp_path):
    (tmp_path / "in/skip").mkdir(parents=True)
    (tmp_path / "in/a.pdf").write_text("A page of text that is long enough to be kept by the filter.")
    (tmp_path / "in/skip/b.md").write_text("Another text that would be long enough to be kept by the filter.")
    parse, _ = configs(tmp_path)
    config = ParseConfig(**{**parse.__dict__, "excluded": "skip, other", "converters": ".pdf=text_layer"})
    assert run.parse_folder(spark, config) == {"discovered": 1, "skipped": 0, "parsed": 1, "failed": 0}
    with pytest.raises(ValueError, match="unknown converter"):
        run.parse.converter("nothing")
    assert run.parse.converter("quire.sources.parse:text_layer") is run.parse.text_layer


def test_command_line_arguments():
    args = cli._parser().parse_args(["parse", "--source-dir", "x", "--max-files", "3", "--no-skip-unchanged"])
    assert (args.source_dir, args.max_files, args.skip_unchanged) == ("x", 3, False)
    assert cli._parser().parse_args(["parse"]).skip_unchanged is None
    with pytest.raises(SystemExit):
        cli._parser().parse_args(["audit"])
