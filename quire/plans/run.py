"""Whole runs: parse a folder into documents, and bring an index up to date. State is written after the outputs."""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.config import IndexConfig, ParseConfig
from quire.operators import embed, metadata, nodes, state
from quire.operators.elements import element_type, merge_adjacent, normal_boxes, sectioned_items, table_rows, typed_rows
from quire.session import checkpointed
from quire.sources import files as source_files
from quire.sources import jsonl, parse

INGEST_STATE = "relative_path string, fingerprint string, doc_id string, char_count bigint, last_ingested_at timestamp"
INDEX_STATE = "doc_id string, point_id string, content_hash string, updated_at timestamp"
#: A chunk's and a parent's metadata stand beside its other fields (as parse_folder writes them) or below ``metadata``.
_OWN = "paper_title:string,authors:array<string>,year:int,section:string"
_CHUNK = f"parent_id:string,relative_path:string,title:string,topic:string,chunk_level:string,chunk_type:string,section_path:array<string>,page_start:int,page_end:int,chunk_index:int,table_rows:array<array<string>>,figure_context:string,{_OWN}"
_CHILD = f"struct<child_id:string,doc_id:string,text:string,{_CHUNK},metadata:struct<{_CHUNK}>>"
_PARENT = f"struct<parent_id:string,{_OWN},metadata:struct<{_OWN}>>"
DOCUMENTS = f"doc_id string, text string, metadata struct<relative_path:string,title:string,topic:string,paper_title:string,authors:array<string>,year:int>, parent_nodes array<{_PARENT}>, child_nodes array<{_CHILD}>"
VECTORS = f"point_id string, doc_id string, text string, payload struct<{','.join(f'{name}:{kind}' for name, kind in state.PAYLOAD.items())}>, embedding array<float>"


def elements_of(items: DataFrame) -> DataFrame:
    """Elements before merging, of parser items."""
    kept = sectioned_items(items)
    kind = element_type(F.col("label"), F.col("text"), F.col("in_references"))
    typed = kept.withColumn("element_type", kind)
    rows = F.when(F.col("element_type") == "table", F.when(F.size(typed_rows(F.col("rows"))) > 0, typed_rows(F.col("rows"))).otherwise(table_rows(F.col("text"))))
    return typed.select("doc_id", F.lit("").alias("element_id"), "element_type", "text", "page", "ord", "section_path", rows.alias("table_rows"), normal_boxes(F.col("bboxes")).alias("bboxes"))


def _listed(rows: DataFrame, name: str, by: str, **fields: Column) -> DataFrame:
    """doc_id and ``name``: each document's rows as a list of objects in order."""
    item = F.struct(F.col(by).alias("__at"), F.struct(*(c.alias(n) for n, c in fields.items())).alias("item"))
    return rows.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["item"]).alias(name))


def nested(documents: DataFrame, merged: DataFrame, parents: DataFrame, children: DataFrame, meta: DataFrame) -> DataFrame:
    """One record for each document: doc_id, text, metadata, elements, parent_nodes, child_nodes, each object with its own metadata."""
    paper = meta.select("doc_id", "paper_title", "authors", "year")
    fields = lambda *names: {n: F.col(n) for n in names}
    about = fields("doc_id", "paper_title", "authors", "year", "section", "page_start", "page_end")
    own = lambda **more: F.struct(*(c.alias(n) for n, c in (about | more).items()))
    inside = (
        _listed(
            merged, "elements", "ord", **fields("element_id", "element_type", "text", "page"), order=F.col("ord"), section_path=F.col("section_path"),
            metadata=F.struct("bboxes", F.col("table_rows").alias("rows")),
        ),
        _listed(
            parents.join(paper, "doc_id"), "parent_nodes", "parent_index", **fields("parent_id", "doc_id", "section_path", "page_start", "page_end", "text"), metadata=own(chunk_level=F.lit("parent")),
        ),
        _listed(
            children.join(paper, "doc_id"), "child_nodes", "place", **fields("child_id", "parent_id", "doc_id", "chunk_level", "chunk_type", "section_path", "page_start", "page_end", "text"),
            metadata=own(**fields("chunk_level", "chunk_type", "chunk_index", "table_rows", "figure_context")),
        ),
    )
    out = documents.select("doc_id", "text").join(meta.select("doc_id", F.struct(*[c for c in meta.columns if c != "doc_id"]).alias("metadata")), "doc_id")
    for part in inside:
        out = out.join(part, "doc_id", "left")
    return out


def parse_folder(spark: SparkSession, config: ParseConfig, converters: dict[str, parse.Converter] | None = None) -> dict[str, int]:
    """Parse what is new or changed; the run's counters."""
    snapshots = jsonl.Snapshots(spark, config.state_dir, INGEST_STATE)
    before = snapshots.read()
    listed = source_files.discover(spark, config.source_dir, max_files=config.max_files, excluded=config.excluded_names())
    listed = listed.withColumn("fingerprint", F.sha2("content", 256)).withColumn("doc_id", parse.doc_id(F.col("relative_path")))
    decided = checkpointed(state.file_decisions(listed, before))
    todo = decided.where("decision <> 'unchanged'") if config.skip_unchanged else decided
    items, failed = parse.items(todo, converters or {suffix: parse.converter(name) for suffix, name in config.named_converters().items()})
    # Written once, as conversion is dear and its items are read several times.
    items = checkpointed(items)
    failed = checkpointed(failed)
    merged = merge_adjacent(elements_of(items))
    texts = merged.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda e: e["text"]), "\n").alias("text"))
    documents = checkpointed(todo.drop("content").join(texts, "doc_id").withColumn("char_count", F.length("text").cast("bigint")).where(F.col("char_count") >= config.min_characters))
    merged = checkpointed(merged.join(documents.select("doc_id"), "doc_id", "left_semi"))
    # Written once, as chunks and look-ups are planned from them several times.
    parents = checkpointed(nodes.parent_nodes(merged))
    children = nodes.child_nodes(merged, parents, config.chunk_size, config.chunk_overlap)
    looked_at = metadata.light(merged)
    meta = checkpointed(metadata.doc_metadata(documents, looked_at, nodes.counts(looked_at, config.chunk_size, config.chunk_overlap)))
    jsonl.write_jsonl(nested(documents, merged, parents, children, meta), config.output_jsonl)
    entries = checkpointed(metadata.manifest_documents(documents, meta, looked_at, config.preview_characters))
    entries.write.mode("overwrite").json(f"{config.output_manifest}/documents")
    metadata.manifest_header(entries, config.source_dir).coalesce(1).write.mode("overwrite").json(f"{config.output_manifest}/header")
    done = documents.withColumn("ingested_at", F.current_timestamp()).select("relative_path", "fingerprint", "doc_id", "char_count", "ingested_at")
    # A limited listing says nothing about what has vanished; a file that failed keeps its old row.
    kept = state.latest_ingest_state(before).join(done.select("relative_path"), "relative_path", "left_anti")
    if config.max_files is None:
        kept = kept.join(decided.select("relative_path"), "relative_path", "left_semi")
    snapshots.write(kept.unionByName(done.withColumnRenamed("ingested_at", "last_ingested_at")))
    return {"discovered": decided.count(), "skipped": decided.where("decision = 'unchanged'").count() if config.skip_unchanged else 0, "parsed": documents.count(), "failed": failed.count()}


#: What an audit reads of parsed documents.
_AUDITED = "doc_id string, metadata struct<source_path:string>, elements array<struct<element_id:string,element_type:string,text:string,page:int,order:int,metadata:struct<bboxes:array<struct<page:int,l:double,t:double,r:double,b:double,origin:string>>>>>"


def audit_elements(spark: SparkSession, path: str) -> DataFrame:
    """The elements of the parsed PDF documents whose source is still there and that have boxes; lines that cannot be read are left out."""
    from pyspark.sql import types as T

    @F.pandas_udf("boolean")
    def there(paths: pd.Series) -> pd.Series:
        return paths.map(lambda p: bool(p) and os.path.isfile(p))

    documents, _ = jsonl.read_lenient(spark, path, T.StructType.fromDDL(_AUDITED))
    source = F.col("metadata.source_path")
    boxed = F.exists("elements", lambda e: F.coalesce(F.size(e["metadata"]["bboxes"]), F.lit(0)) > 0)
    kept = documents.where(F.col("doc_id").isNotNull() & F.lower(source).endswith(".pdf") & boxed).where(there(source))
    return kept.select("doc_id", F.explode("elements").alias("e")).select("doc_id", "e.element_id", "e.element_type", "e.text", F.col("e.order").alias("ord"), "e.metadata.bboxes")


def _client(config: IndexConfig):
    if config.embedding_provider == "hash":
        return lambda: embed.HashEmbedder(config.vector_size)
    return lambda: embed.HttpEmbedder(config.embedding_endpoint, config.embedding_model, config.api_key)


def _overridden(nodes: DataFrame) -> DataFrame:
    """``nodes`` whose fields give way to those of the same name in their metadata."""
    return nodes.withColumns({c: F.coalesce(F.col(f"metadata.{c}"), F.col(c)) for c in nodes.schema["metadata"].dataType.names}).drop("metadata")


def _refuse_doubled(usable: DataFrame) -> None:
    """Fail where a point would stand for different chunks: the stored hash could then be that of another text than the embedded one."""
    point = state.point_id(F.col("child_id")).alias("point_id")
    same = F.xxhash64("doc_id", "text", F.coalesce("chunk_type", F.lit("")))
    doubled = usable.where(state.indexable()).groupBy(point).agg(F.min(same).alias("least"), F.max(same).alias("most")).where("least <> most").limit(1).collect()
    if doubled:
        raise ValueError(f"point {doubled[0]['point_id']} stands for different chunks")


def _collection(spark: SparkSession, config: IndexConfig) -> None:
    """Keep vector size and distance beside the vectors; a run with others fails unless it recreates the collection."""
    kept = jsonl.Snapshots(spark, f"{config.vector_dir}/properties", "vector_size int, distance string")
    wanted = (config.vector_size, config.distance.lower())
    found = kept.read().first()
    if found and not config.recreate and tuple(found) != wanted:
        raise ValueError(f"the collection has vectors of size {found[0]} and distance {found[1]}, not {wanted[0]} and {wanted[1]}")
    if not found or tuple(found) != wanted:
        kept.write(spark.createDataFrame([wanted], kept.schema))


def index_documents(spark: SparkSession, config: IndexConfig) -> dict[str, int]:
    """Embed new and changed chunks, drop stale ones; the run's counters. Recreating treats the old state as empty."""
    snapshots = jsonl.Snapshots(spark, config.state_dir, INDEX_STATE)
    vectors = jsonl.Snapshots(spark, config.vector_dir, VECTORS)
    _collection(spark, config)
    before = spark.createDataFrame([], INDEX_STATE) if config.recreate else snapshots.read()
    documents = jsonl.read_strict(spark, config.input_jsonl, DOCUMENTS)
    doubled = documents.groupBy("doc_id").count().where("count > 1").limit(1).collect()
    if doubled:
        raise ValueError(f"document {doubled[0]['doc_id']} occurs more than once")
    loaded = _overridden(documents.where("child_nodes is not null").select(F.explode("child_nodes").alias("c")).select("c.*"))
    usable = state.fallback_child_id(loaded)
    _refuse_doubled(usable)
    diff = checkpointed(state.index_diff(usable, before, config.delete_missing_docs))
    counts = {r["status"]: r["count"] for r in diff.groupBy("status").count().collect()}
    fresh = counts.get("new", 0) + counts.get("changed", 0)
    if fresh or counts.get("stale", 0) or config.recreate:
        parents = _overridden(documents.where("parent_nodes is not null").select("doc_id", F.explode("parent_nodes").alias("p")).select("doc_id", "p.*"))
        points = state.point_payload(loaded, parents, documents.select("doc_id", "metadata.*")).dropDuplicates(["point_id"])
        todo = points.join(diff.where("status in ('new', 'changed')").select("point_id"), "point_id", "left_semi")
        new = todo.join(embed.embed(todo, _client(config), config.vector_size, config.batch_size), "point_id")
        old = spark.createDataFrame([], vectors.schema) if config.recreate else vectors.read()
        vectors.write(state.next_vector_table(old, diff, new.select(*old.columns)))
    snapshots.write(state.next_index_state(usable, before).withColumn("updated_at", F.current_timestamp()))
    blank = loaded.where(~state.indexable()).count()
    return {"upserted": fresh, "skipped": counts.get("unchanged", 0) + blank, "deleted": counts.get("stale", 0)}
