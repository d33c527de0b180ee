"""From file contents to parser items.

Markdown and plain text are parsed with column functions. Other formats go through converters: functions
from bytes to a list of items, run in the tasks, of which a failing file never stops the run.

Defined results. Contents that are no UTF-8 are read as Latin-1. A file without a converter, one whose
converter fails and one whose status does not end in ``success`` give no items but a reason. A null content is a failure.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import strip

BOXES = "array<struct<page:int,l:double,t:double,r:double,b:double,origin:string>>"
ITEMS = f"doc_id string, seq int, label string, level int, page int, text string, rows array<array<string>>, bboxes {BOXES}"
TEXT_FORMATS = (".md", ".txt")

#: bytes -> (status, items); an item is a dict with any of the ITEMS columns but doc_id and seq.
Converter = Callable[[bytes], tuple[str, list[dict]]]


def text_layer(content: bytes) -> tuple[str, list[dict]]:
    """A converter for files whose content is their text already: an item for each line that is not blank; a blank file fails."""
    lines = [line.strip() for line in content.decode("utf-8", "replace").splitlines()]
    found = [{"label": "text", "page": 1, "text": line} for line in lines if line]
    return ("success" if found else "failure"), found


#: Converters by name, as a configuration can name them (``.pdf=text_layer``, or ``.pdf=package.module:function``).
CONVERTERS: dict[str, Converter] = {"text_layer": text_layer}


def converter(name: str) -> Converter:
    """A converter by its name in ``CONVERTERS``, or by module and function."""
    if name in CONVERTERS:
        return CONVERTERS[name]
    module, _, function = name.partition(":")
    if not function:
        raise ValueError(f"unknown converter: {name}")
    return getattr(importlib.import_module(module), function)


def doc_id(path: Column) -> Column:
    """The id of a path."""
    return F.sha1(path)


def decoded(content: Column) -> Column:
    """Contents as text."""
    return F.coalesce(F.try_validate_utf8(content.cast("string")), F.decode(content, "ISO-8859-1"))


def text_items(files: DataFrame, level_offset: int = 1) -> DataFrame:
    """Items of text files: one for each line that is not blank; ``#`` is a title, more hashes are headings of level hashes - offset."""
    lines = files.where("content is not null").select(doc_id(F.col("relative_path")).alias("doc_id"), F.posexplode(F.split(decoded(F.col("content")), r"\r\n|\r|\n")).alias("seq", "line"))
    line = strip(F.col("line"))
    hashes = F.length(F.regexp_extract(line, r"^(#{1,6})\s", 1))
    label = F.when(hashes == 1, "title").when(hashes > 1, "section_header").otherwise("text")
    return lines.where(line != "").select(
        "doc_id", "seq", label.alias("label"), F.when(hashes > 1, hashes - level_offset).cast("int").alias("level"), F.lit(1).alias("page"),
        F.when(hashes > 0, strip(F.regexp_replace(line, r"^#{1,6}", ""))).otherwise(line).alias("text"),
        F.lit(None).cast("array<array<string>>").alias("rows"), F.array().cast(BOXES).alias("bboxes"),
    )


def converted(files: DataFrame, converters: dict[str, Converter]) -> DataFrame:
    """doc_id, relative_path, ok, error, items of the files that are no text, by suffix."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, suffix, content in zip(batch["relative_path"], batch["file_ext"], batch["content"]):
                error, items = None, []
                try:
                    if suffix not in converters:
                        raise LookupError(f"no converter for {suffix}")
                    if content is None:
                        raise ValueError("no content")
                    status, items = converters[suffix](bytes(content))
                    if not status.lower().endswith("success"):
                        raise RuntimeError(f"conversion ended as {status}")
                except Exception as failure:  # noqa: BLE001 - one bad file never stops the run
                    error, items = f"{type(failure).__name__}: {failure}", []
                names = ("label", "level", "page", "text", "rows", "bboxes")
                rows.append((path, error is None, error, [{n: item.get(n) for n in names} for item in items]))
            yield pd.DataFrame(rows, columns=["relative_path", "ok", "error", "items"])

    item = f"struct<label:string,level:int,page:int,text:string,rows:array<array<string>>,bboxes:{BOXES}>"
    out = files.where(~F.col("file_ext").isin(*TEXT_FORMATS)).select("relative_path", "file_ext", "content").mapInPandas(run, f"relative_path string, ok boolean, error string, items array<{item}>")
    return out.withColumn("doc_id", doc_id(F.col("relative_path")))


def items(files: DataFrame, converters: dict[str, Converter] | None = None, level_offset: int = 1) -> tuple[DataFrame, DataFrame]:
    """The items of all files, and relative_path, error of those that gave none."""
    other = converted(files, converters or {})
    opened = other.where("ok").select("doc_id", F.posexplode("items").alias("seq", "i")).select("doc_id", "seq", "i.*")
    failed = other.where("not ok").select("relative_path", "error")
    empty = files.where(F.col("file_ext").isin(*TEXT_FORMATS) & F.col("content").isNull()).select("relative_path", F.lit("no content").alias("error"))
    return text_items(files.where(F.col("file_ext").isin(*TEXT_FORMATS)), level_offset).unionByName(opened), failed.unionByName(empty)
