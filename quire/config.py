"""Run configuration: values of the command line before those of a YAML file before defaults.

Of strings an empty one counts as not given; of numbers zero counts. Sections must be mappings.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from pathlib import Path

#: Directories that no listing enters unless told otherwise.
EXCLUDED = (".git", ".venv", "__pycache__", "node_modules")
DISTANCES = ("cosine", "dot", "euclid", "manhattan")


@dataclass(frozen=True)
class ParseConfig:
    """What a parse run needs."""

    source_dir: str
    output_jsonl: str
    output_manifest: str
    state_dir: str
    log_dir: str = ""
    log_level: str = "INFO"
    preview_characters: int = 240
    min_characters: int = 40
    max_files: int | None = None
    skip_unchanged: bool = True
    chunk_size: int = 800
    chunk_overlap: int = 120
    #: Names of directories that are never entered, by commas; the usual ones if empty.
    excluded: str = ""
    #: ``.suffix=name`` by commas, see ``quire.sources.parse.converter``.
    converters: str = ""

    def excluded_names(self) -> tuple[str, ...]:
        """The directories that are never entered."""
        return tuple(n.strip() for n in self.excluded.split(",") if n.strip()) or EXCLUDED

    def named_converters(self) -> dict[str, str]:
        """Converter names by lower-case suffix."""
        pairs = (p.split("=", 1) for p in self.converters.split(",") if p.strip())
        return {suffix.strip().lower(): name.strip() for suffix, name in pairs}


@dataclass(frozen=True)
class IndexConfig:
    """What an index run needs."""

    input_jsonl: str
    state_dir: str
    vector_dir: str
    embedding_model: str
    embedding_endpoint: str
    embedding_provider: str = "http"
    api_key: str = ""
    vector_size: int = 1024
    distance: str = "cosine"
    batch_size: int = 128
    recreate: bool = False
    delete_missing_docs: bool = False
    log_dir: str = ""
    log_level: str = "INFO"

    def __post_init__(self) -> None:
        if self.distance.lower() not in DISTANCES:
            raise ValueError(f"unknown distance: {self.distance}")
        if self.embedding_provider not in ("http", "tei", "remote", "openai_compatible", "ollama", "hash"):
            raise ValueError(f"unknown embedding provider: {self.embedding_provider}")


def load_yaml(path: str) -> dict:
    """A YAML file that holds a mapping; an empty file is an empty one."""
    import yaml

    loaded = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    if loaded is None:
        return {}
    if not isinstance(loaded, Mapping):
        raise ValueError(f"{path} holds no mapping")
    return dict(loaded)


def resolve(kind: type, section: Mapping | None, overrides: Mapping):
    """A configuration of ``kind`` from a section and overrides."""
    if section is not None and not isinstance(section, Mapping):
        raise ValueError("a configuration section must be a mapping")
    values = {}
    for f in fields(kind):
        for source in (overrides, section or {}):
            value = source.get(f.name)
            if value is not None and value != "":
                if f.type == "bool" and isinstance(value, str):
                    value = value.strip().lower() in ("1", "true", "yes", "on")
                values[f.name] = int(value) if f.type in ("int", "int | None") else value
                break
    try:
        return kind(**values)
    except TypeError as error:
        raise ValueError(f"missing configuration: {error}") from None
