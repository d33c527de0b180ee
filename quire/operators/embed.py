"""Embedding of texts through a remote service, in batches inside the tasks.

The service's protocol is found by trying the known forms in order; the one that answers is remembered by the worker
and forgotten when it fails. Vectors are checked against the expected length.
"""

from __future__ import annotations

import hashlib
import json
import math
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame

#: Values that stand for no key in shared configurations.
PLACEHOLDERS = ("", "REPLACE_ME", "<set-in-local-config>")

#: Paths and payload forms tried for one text and for several, in this order (fixed values).
SINGLE = (("/embed", "inputs", False), ("/embed", "inputs", True), ("/v1/embeddings", "input", False), ("/v1/embeddings", "input", True), ("/embeddings", "input", False), ("/embeddings", "input", True))
BATCH = (("/embed", "inputs", True), ("/v1/embeddings", "input", True), ("/embeddings", "input", True))


class Embedder(Protocol):
    """Vectors of texts, in order."""

    def __call__(self, texts: list[str]) -> list[list[float]]: ...


class HashEmbedder:
    """Deterministic vectors from hashes, of length 1; for tests and dry runs."""

    def __init__(self, size: int) -> None:
        self.size = size

    def __call__(self, texts: list[str]) -> list[list[float]]:
        out = []
        for text in texts:
            raw = b"".join(hashlib.sha256(f"{i}:{text}".encode()).digest() for i in range(self.size // 32 + 1))[: self.size]
            vector = [b - 127.5 for b in raw]
            norm = math.sqrt(sum(x * x for x in vector))
            out.append([x / norm for x in vector])
        return out


def vectors_in(answer) -> list[list[float]]:
    """The vectors of an answer in any of the known shapes; none if it has none."""
    if isinstance(answer, dict):
        if isinstance(answer.get("data"), list):
            return [list(map(float, row["embedding"])) for row in answer["data"] if isinstance(row, dict) and "embedding" in row]
        answer = answer.get("embedding") or answer.get("embeddings") or []
    if isinstance(answer, list) and answer and all(isinstance(x, (int, float)) for x in answer):
        return [list(map(float, answer))]
    if isinstance(answer, list) and all(isinstance(x, list) for x in answer):
        return [list(map(float, x)) for x in answer]
    return []


class HttpEmbedder:
    """A client of an embedding service."""

    def __init__(self, endpoint: str, model: str, api_key: str = "", timeout: float = 30.0, retries: int = 2) -> None:
        if not endpoint:
            raise ValueError("an embedding endpoint is required")
        self.endpoint, self.model, self.timeout, self.retries = endpoint.rstrip("/"), model, timeout, retries
        self.api_key = "" if api_key in PLACEHOLDERS else api_key
        self.form: dict[bool, tuple[str, str, bool]] = {}

    def _post(self, path: str, payload: dict):
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.api_key}"} if self.api_key else {})
        request = urllib.request.Request(self.endpoint + path, json.dumps(payload).encode(), headers)
        for attempt in range(self.retries + 1):
            try:
                with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                    return json.loads(answer.read())
            except urllib.error.HTTPError:
                raise
            except OSError:
                if attempt == self.retries:
                    raise
                time.sleep(min(2**attempt, 4))
        return None

    def _ask(self, texts: list[str], forms: tuple[tuple[str, str, bool], ...]) -> list[list[float]] | None:
        many = len(texts) > 1
        known = self.form.get(many)
        failure: Exception | None = None
        for form in ((known,) if known else ()) + tuple(f for f in forms if f != known):
            path, field, as_list = form
            payload = {field: texts if as_list else texts[0]} | ({"model": self.model} if field == "input" else {})
            try:
                vectors = vectors_in(self._post(path, payload))
            except (urllib.error.HTTPError, ValueError, KeyError, TypeError) as error:
                failure, vectors = error, []
            if len(vectors) == len(texts):
                self.form[many] = form
                return vectors
            self.form.pop(many, None)
            if many and len(vectors) == 1:
                # A service that answers several texts with one vector takes them one by one.
                return None
        if failure and not many:
            raise failure
        return None

    def __call__(self, texts: list[str]) -> list[list[float]]:
        if not texts:
            return []
        if len(texts) > 1 and (vectors := self._ask(texts, BATCH)) is not None:
            return vectors
        out = []
        for text in texts:
            vectors = self._ask([text], SINGLE)
            if vectors is None:
                raise RuntimeError("the embedding service gave no vector")
            out += vectors
        return out


def embed(points: DataFrame, make: Callable[[], Embedder], size: int, batch_size: int = 128, id_col: str = "point_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``embedding`` of every row; the client is built once for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = make()
        for batch in batches:
            for at in range(0, batch.num_rows, max(1, batch_size)):
                part = batch.slice(at, max(1, batch_size))
                vectors = client([t or "" for t in part.column(1).to_pylist()])
                wrong = {len(v) for v in vectors} - {size}
                if wrong:
                    raise ValueError(f"vectors of length {sorted(wrong)}, expected {size}")
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(vectors, pa.list_(pa.float32()))], [id_col, "embedding"])

    source = points.select(id_col, text_col)
    return source.mapInArrow(run, f"{id_col} {source.schema[id_col].dataType.simpleString()}, embedding array<float>")
