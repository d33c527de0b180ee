"""The registered queries, each beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.queries import audit, chunks, classify, discovery, index, metadata, nested, report, search, structure

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = (discovery, classify, structure, chunks, metadata, index, search, audit, report, nested)
QUERIES: dict[str, Query] = {name: query for module in _MODULES for name, query in module.QUERIES.items()}

#: Columns that Spark counts in 32 bits; the SQL is cast to the same type.
_INTS = {
    "ord": ("drop_empty_items", "is_figure_caption", "is_equation", "in_references", "section_path", "merge_adjacent"),
    "seq": ("item_text", "drop_empty_items"), "n_merged": ("merge_adjacent",), "n_boxes": ("merge_adjacent",), "parent_index": ("parent_nodes",), "chunk_index": ("token_windows", "token_windows_default", "child_nodes"),
    "index": ("manifest_documents",), "position": ("discover_order", "audit_legend"), "rank": ("knn_cosine", "knn_dot", "knn_euclid", "knn_manhattan"), "box_index": ("bbox_normalize", "audit_frames", "audit_rects", "audit_labels"),
    "element_index": ("audit_chain", "audit_frames", "audit_rects", "audit_labels"), "prev_index": ("audit_chain",), "next_index": ("audit_chain",),
}


def _typed(name: str, text: str) -> str:
    casts = ", ".join(f'CAST("{column}" AS INTEGER) AS "{column}"' for column, names in _INTS.items() if name in names)
    return f"SELECT * REPLACE ({casts}) FROM ({text})" if casts else text


SQL: dict[str, str] = {name: _typed(name, text) for module in _MODULES for name, text in module.SQL.items()}

flagship = report.chunk_types
