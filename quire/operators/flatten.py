"""Problem 2: deeply nested records as related flat tables, by shared inlining.

1. The schema graph of all records is analysed: its nodes are the record and the objects in it, its
   edges say which object holds which, and whether repeatedly. A key's name is a type where it is repeated anywhere (so the same
   collection at several places, or once alone and once in a list, is one type). An object that never is repeated has the type of its
   key and of the keys it holds over all records: where several places lead to one such type (its in-degree), it is shared.
2. Types that are repeated, shared or recursive become tables; every other object is inlined into the
   table of its owner, its fields under dotted names. Lists of scalars are kept as JSON in a field.
3. Each instance becomes a row with its own key (record, node), its owner's key as foreign key
   (record, parent_node), and its position in the list it came from.

Layouts that are understood: lists; objects keyed by id instead of a list of objects; a single object
in the place of a list; objects and lists of objects written as a JSON string.

Defined results. Null, blank, cut off or otherwise unreadable records and those that are no JSON object
give no rows. Entries of a list that are neither objects nor lists give no row but count in positions.
Repeated records give rows under each record key.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROOT = "record"
#: The edges of a schema graph that may come to the driver; a graph beyond it has ids for keys that aren't told from names.
MOST_EDGES = 50_000
_ID = re.compile(r"^(?:[0-9a-fA-F]{16,}|[0-9a-fA-F-]{32,}|\d+)$")

_NODE = T.StructType(
    [
        T.StructField("record", T.LongType()),
        T.StructField("relation", T.StringType(), False),
        T.StructField("node", T.IntegerType(), False),
        T.StructField("parent_relation", T.StringType()),
        T.StructField("parent_node", T.IntegerType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("map_key", T.StringType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType()), False),
        T.StructField("ancestors", T.MapType(T.StringType(), T.IntegerType()), False),
    ]
)


@dataclass(frozen=True)
class Inlining:
    """Which keys have tables wherever they stand, which single objects (by their place) share one, and the edges they were decided from."""

    relations: frozenset[str]
    shared: dict[str, str]
    edges: tuple[tuple[str, str, bool, bool, int], ...]


def _record(line: str | None) -> dict | None:
    try:
        value = json.loads(line) if line else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _opened(value):
    """A string that holds an object or a list of objects as what it holds."""
    if isinstance(value, str) and value[:1] in ("{", "["):
        try:
            inner = json.loads(value)
        except (ValueError, RecursionError):
            return value
        if isinstance(inner, dict) or isinstance(inner, list) and any(isinstance(x, dict) for x in inner):
            return inner
    return value


def _entries(value) -> list[tuple[int | None, str | None, object]] | None:
    """Position, key and value of what a collection holds; None for a single object or a scalar."""
    if isinstance(value, list) and any(isinstance(x, (dict, list)) for x in value):
        return [(i, None, x) for i, x in enumerate(value)]
    if isinstance(value, dict) and value and all(isinstance(x, dict) and _ID.match(k) for k, x in value.items()):
        return [(i, k, x) for i, (k, x) in enumerate(value.items())]
    return None


def _edges(value: dict, owner: str, chain: tuple[str, ...], found: Counter) -> None:
    for key, inner in value.items():
        inner = _opened(inner)
        entries = _entries(inner)
        if entries is not None:
            found[owner, key, True, False] += 1
            for _, _, entry in entries:
                if isinstance(entry, dict):
                    _edges(entry, key, (key,), found)
        elif isinstance(inner, dict):
            recursive = key in chain
            found[owner, key, recursive, False] += 1
            _edges(inner, key if recursive else f"{owner}.{key}", (key,) if recursive else (*chain, key), found)
        else:
            found[owner, key, False, True] += 1


def schema_graph(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """owner, key, repeated, scalar, n: the edges of the schema graph over all records, to objects and to fields."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for line in batch.column(0).to_pylist():
                if (record := _record(line)) is not None:
                    _edges(record, ROOT, (), found)
        owner, key, repeated, scalar = zip(*found) if found else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(owner, pa.string()), pa.array(key, pa.string()), pa.array(repeated, pa.bool_()), pa.array(scalar, pa.bool_()), pa.array(found.values(), pa.int64())],
            ["owner", "key", "repeated", "scalar", "n"],
        )

    return lines.select(F.col(line_col).cast("string").alias("line")).mapInArrow(run, "owner string, key string, repeated boolean, scalar boolean, n bigint").groupBy("owner", "key", "repeated", "scalar").agg(F.sum("n").alias("n"))


def shared_inlining(graph: DataFrame) -> Inlining:
    """The tables for a schema graph."""
    edges = graph.limit(MOST_EDGES + 1).collect()
    if len(edges) > MOST_EDGES:
        raise ValueError(f"the schema graph has more than {MOST_EDGES} edges")
    rows = sorted((e["owner"], e["key"], e["repeated"], e["scalar"], e["n"]) for e in edges)
    relations = frozenset(key for _, key, repeated, _, _ in rows if repeated)
    holds: dict[str, set[str]] = {}
    for owner, key, _, _, _ in rows:
        holds.setdefault(owner, set()).add(key)
    # A type is a key with what it holds; its in-degree is the number of places that lead to it.
    types: dict[tuple[str, frozenset[str]], list[str]] = {}
    for owner, key, _, scalar, _ in rows:
        place = f"{owner}.{key}"
        if not scalar and key not in relations and place in holds:
            types.setdefault((key, frozenset(holds[place])), []).append(place)
    shared, taken = {}, set(relations)
    for (key, _), places in sorted(types.items(), key=lambda t: t[1]):
        if len(places) > 1:
            name = key
            while name in taken:
                name += "_"
            taken.add(name)
            shared |= dict.fromkeys(places, name)
    return Inlining(relations, shared, tuple(rows))


def _scalar(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False)


class _Shredder:
    """The rows of one record."""

    def __init__(self, inlining: Inlining) -> None:
        self.relations, self.shared, self.rows = inlining.relations, inlining.shared, []

    def instance(self, value, relation: str, place: str, above: dict[str, int], parent: tuple[str | None, int | None], position: int | None, map_key: str | None) -> None:
        """One instance and all below it; ``above`` has the nearest instance of each table around it, ``place`` its owner's name in the graph."""
        node, fields = len(self.rows), {}
        self.rows.append((relation, node, *parent, position, map_key, list(above.items()), fields))
        if isinstance(value, dict):
            self.inline(value, "", place, fields, (relation, node), above | {relation: node})
        else:
            fields["value"] = _scalar(value)

    def inline(self, value: dict, prefix: str, place: str, fields: dict, own: tuple[str, int], above: dict[str, int]) -> None:
        for key, inner in value.items():
            inner, here = _opened(inner), f"{place}.{key}"
            if key in self.relations and isinstance(inner, (dict, list)):
                entries = _entries(inner)
                if entries is None:
                    entries = [(0, None, inner)] if isinstance(inner, dict) else []
                for position, map_key, entry in entries:
                    if isinstance(entry, (dict, list)):
                        self.instance(entry, key, key, above, own, position, map_key)
            elif isinstance(inner, dict) and here in self.shared:
                # The field keeps its name on the way to its table, so that two fields of one type are told apart.
                self.instance(inner, self.shared[here], here, above, own, 0, prefix + key)
            elif isinstance(inner, dict):
                self.inline(inner, f"{prefix}{key}.", here, fields, own, above)
            else:
                fields[prefix + key] = _scalar(inner)


def shred(lines: DataFrame, inlining: Inlining, key_col: str = "line_no", line_col: str = "line") -> DataFrame:
    """All rows of all tables: record, relation, node, parent_relation, parent_node, position, map_key, fields, ancestors (nearest of each table)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = [f.type for f in to_arrow_schema(_NODE)]
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                rows = []
                for key, line in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if (record := _record(line)) is not None:
                        shredder = _Shredder(inlining)
                        shredder.instance(record, ROOT, ROOT, {}, (None, None), None, None)
                        rows += [(key, *row[:-2], list(row[-1].items()), row[-2]) for row in shredder.rows]
                columns = [list(c) for c in zip(*rows)] or [[] for _ in kinds]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _NODE.names)

    return lines.select(F.col(key_col).cast("bigint").alias("record"), F.col(line_col).cast("string").alias("line")).mapInArrow(run, _NODE)


def relation(nodes: DataFrame, name: str, **fields: Column) -> DataFrame:
    """One table: its keys and the given fields."""
    return nodes.where(F.col("relation") == name).select("record", "node", "parent_relation", "parent_node", "position", *(c.alias(n) for n, c in fields.items()))


def field(*names: str) -> Column:
    """The first of several fields that an instance has."""
    return F.coalesce(*(F.col("fields")[n] for n in names))


#: Names under which the edges of a box occur (fixed values).
EDGES = {"l": ("l", "left", "x0", "x_min"), "t": ("t", "top", "y0", "y_min"), "r": ("r", "right", "x1", "x_max"), "b": ("b", "bottom", "y1", "y_max")}


def document_tables(nodes: DataFrame) -> dict[str, DataFrame]:
    """The flat tables of parsed documents: records, elements, boxes, rows, parents, children.

    Every row has the record's key, its own id and ``link_id``, the id of what it belongs to. Instances
    without an id of their own are left out; a child that names no parent has the link ''.
    """
    keys = ["record", "node"]
    inline = relation(nodes, ROOT, doc_id=field("doc_id", "document.doc_id"), own=field("metadata.title", "document.metadata.title"))
    # The metadata of a record have a table of their own where several layouts share them.
    about = nodes.where((F.col("parent_relation") == ROOT) & F.col("map_key").isin("metadata", "document.metadata")).groupBy("record").agg(F.max(field("title")).alias("shared"))
    records = inline.join(about, "record", "left").select(*(c for c in inline.columns if c != "own"), F.coalesce("own", "shared").alias("title"))
    of_record = inline.select("record", F.coalesce("doc_id", F.lit("")).alias("link_id"))
    elements = (
        relation(
            nodes, "elements", element_id=F.coalesce(field("element_id"), F.col("map_key")), element_type=field("element_type"), text=field("text"),
            page=field("page").try_cast("int"), ord=field("order", "ord").try_cast("int"), section_path=field("section_path"),
        ).where("coalesce(element_id, '') <> ''")
    )
    # Boxes and rows belong to the nearest element, children to the nearest parent, whatever lies between.
    owner = elements.select("record", F.col("node").alias("owner"), F.col("element_id").alias("link_id"))
    numbered = F.concat(F.col("link_id"), F.lit("#"), F.col("position"))
    edges = {name: field(*names).try_cast("double") for name, names in EDGES.items()}
    boxes = relation(nodes, "bboxes", owner=F.col("ancestors")["elements"], page=field("page").try_cast("int"), origin=field("origin"), **edges).where("l is not null and t is not null and r is not null and b is not null")
    rows = nodes.where(F.col("relation").isin("rows", "table_rows") & F.col("ancestors")["child_nodes"].isNull()).select(*keys, F.col("ancestors")["elements"].alias("owner"), "parent_node", "position", F.col("fields")["value"].alias("cells"))
    parents = relation(nodes, "parent_nodes", parent_id=field("parent_id"), text=field("text"), section=field("metadata.section")).where("coalesce(parent_id, '') <> ''")
    holder = parents.select("record", F.col("node").alias("owner"), F.col("parent_id").alias("holder_id"))
    children = relation(nodes, "child_nodes", owner=F.col("ancestors")["parent_nodes"], child_id=field("child_id"), named=field("parent_id"), chunk_type=field("chunk_type"), text=field("text")).where("coalesce(child_id, '') <> ''")
    linked = children.join(holder, ["record", "owner"], "left").withColumn("link_id", F.coalesce(F.nullif("named", F.lit("")), "holder_id", F.lit("")))
    return {
        "records": records,
        "elements": elements.join(of_record, "record"),
        "boxes": boxes.join(owner, ["record", "owner"]).withColumn("box_id", numbered),
        "rows": rows.join(owner, ["record", "owner"]).withColumn("row_id", numbered),
        "parents": parents.join(of_record, "record"),
        "children": linked.drop("named", "holder_id"),
    }


def links(tables: dict[str, DataFrame]) -> DataFrame:
    """record, entity, entity_id, link_id: the distinct objects of every record."""
    parts = [
        tables[name].select("record", F.lit(entity).alias("entity"), F.col(key).alias("entity_id"), "link_id")
        for name, entity, key in (("elements", "element", "element_id"), ("boxes", "bbox", "box_id"), ("rows", "row", "row_id"), ("parents", "parent", "parent_id"), ("children", "child", "child_id"))
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.distinct()
