"""File discovery and reading, with every name that a directory walk sees (Spark's file sources hide some)."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quire.config import EXCLUDED
from quire.functions.text import file_name, suffix

EXTENSIONS = (".md", ".pdf", ".txt")


def _wanted(path: Path, extensions: tuple[str, ...]) -> bool:
    return path.suffix.lower() in extensions and path.is_file()


def walk(top: Path, extensions: tuple[str, ...], excluded: tuple[str, ...]) -> Iterator[Path]:
    """Files below ``top`` with one of the suffixes; excluded directories are never entered."""
    for folder, names, files in os.walk(top):
        names[:] = sorted(n for n in names if n not in excluded)
        yield from (p for p in map(Path(folder).joinpath, sorted(files)) if _wanted(p, extensions))


def kept(path: Column, extensions: tuple[str, ...] = EXTENSIONS, excluded: tuple[str, ...] = EXCLUDED) -> Column:
    """Whether a path has one of the suffixes and no excluded component."""
    return suffix(file_name(path)).isin(*extensions) & ~F.arrays_overlap(F.split(path, "/"), F.array(*map(F.lit, excluded)))


class _Part(InputPartition):
    def __init__(self, folder: str, deep: bool) -> None:
        super().__init__(folder)
        self.folder, self.deep = folder, deep


class FilesReader(DataSourceReader):
    """One partition for each directory down to ``depth``; each task walks its own."""

    def __init__(self, options: dict[str, str]) -> None:
        self.root = Path(options["path"]).resolve()
        self.extensions = tuple(e.strip().lower() for e in options.get("extensions", ",".join(EXTENSIONS)).split(","))
        self.excluded = tuple(e.strip() for e in options.get("excluded", ",".join(EXCLUDED)).split(","))
        self.depth = int(options.get("depth", "2"))
        self.content = options.get("content", "true").lower() == "true"

    def partitions(self) -> list[InputPartition]:
        if not self.root.is_dir():
            raise FileNotFoundError(f"no such directory: {self.root}")
        # A root below an excluded directory yields nothing, as the whole path counts.
        if set(self.root.parts) & set(self.excluded):
            return [_Part("", False)]
        parts, level = [], [self.root]
        for _ in range(self.depth):
            parts += [_Part(str(p), False) for p in level]
            level = [Path(e.path) for p in level for e in os.scandir(p) if e.is_dir() and e.name not in self.excluded]
        return parts + [_Part(str(p), True) for p in level]

    def read(self, partition: _Part) -> Iterator[tuple]:
        if not partition.folder:
            return
        folder = Path(partition.folder)
        found = walk(folder, self.extensions, self.excluded) if partition.deep else (p for p in sorted(folder.iterdir()) if _wanted(p, self.extensions))
        for path in found:
            yield (path.relative_to(self.root).as_posix(), str(path), path.name, path.suffix.lower(), path.read_bytes() if self.content else None)


class FilesSource(DataSource):
    """``spark.read.format("quire_files").option("path", folder).load()``."""

    @classmethod
    def name(cls) -> str:
        return "quire_files"

    def schema(self) -> str:
        return "relative_path string, source_path string, file_name string, file_ext string, content binary"

    def reader(self, schema) -> DataSourceReader:
        return FilesReader(self.options)


def discover(spark: SparkSession, folder: str, extensions: tuple[str, ...] = EXTENSIONS, max_files: int | None = None, content: bool = True, excluded: tuple[str, ...] = EXCLUDED) -> DataFrame:
    """The files of a folder; with ``max_files`` the first of them by path components.

    The limit is taken on the listing without contents, which are then read for the files kept.
    """
    if max_files is not None and max_files <= 0:
        raise ValueError("max_files must be positive")
    spark.dataSource.register(FilesSource)

    def listing(with_content: bool) -> DataFrame:
        return spark.read.format("quire_files").option("path", folder).option("extensions", ",".join(extensions)).option("excluded", ",".join(excluded)).option("content", str(with_content).lower()).load().where(kept(F.col("relative_path"), extensions, excluded))

    files = listing(content)
    if max_files is None:
        return files
    first = listing(False).orderBy(F.split("relative_path", "/")).limit(max_files).select("relative_path")
    return files.join(first, "relative_path", "left_semi")
