"""The entry file, and that the core stands without the optional package."""

import ast
from pathlib import Path

import __spark_entry__ as entry
from quire.queries import QUERIES, SQL

ROOT = Path(__file__).resolve().parent.parent


def test_every_core_query_runs_and_has_unique_columns(spark, data):
    for name, query in QUERIES.items():
        df = query(spark, data)
        assert len(set(df.columns)) == len(df.columns), name
        df.limit(1).collect()


def test_registry():
    assert set(SQL) <= set(QUERIES) and set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_gives_chunk_types(spark, data):
    assert {r.chunk_type for r in entry.entry(spark).collect()} == {"text", "table", "figure"}


def test_nothing_in_the_core_imports_the_llm_package():
    for path in (ROOT / "quire").rglob("*.py"):
        if "llm" in path.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") for n in names), path
