"""Problem 6: encoding a corpus with a public byte-level tokenizer, and decoding it again.

Texts go through the ``tokenizers`` library in Arrow batches. Byte-level vocabularies write each
of the 256 bytes as one printable character; :func:`byte_table` rebuilds that mapping, so decoding
needs nothing but the vocabulary. A character may be split over several tokens: offsets are
therefore given in bytes and in characters, and decoding joins bytes before it makes characters.

Defined results: null and empty texts give an empty list. Special-token strings inside a text are
ordinary text. Rows are kept one to one, repeated rows too. Ids outside the vocabulary raise.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Where vocabularies lie unless the caller names another folder.
TOKENIZER_DIR = "/opt/tokenizers"
#: Code points that are encoded at a time, to bound a worker's memory.
CHARS_AT_A_TIME = 2_000_000
ROWS_AT_A_TIME = 5_000
_BEHIND = re.compile(r"\S ")
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")

_ENCODED = T.ArrayType(T.IntegerType(), False)
_TOKENS = T.ArrayType(
    T.StructType(
        [
            T.StructField("id", T.IntegerType(), False),
            T.StructField("byte_start", T.IntegerType(), False),
            T.StructField("byte_end", T.IntegerType(), False),
            T.StructField("char_start", T.IntegerType(), False),
            T.StructField("char_end", T.IntegerType(), False),
        ]
    ),
    False,
)


@functools.cache
def byte_table() -> dict[str, int]:
    """character -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in own}
    for extra, b in enumerate(b for b in range(256) if chr(b) not in table or b not in own):
        table[chr(0x100 + extra)] = b
    return table


@functools.cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


@functools.cache
def _token_bytes(path: str) -> dict[int, bytes]:
    table = byte_table()
    return {i: bytes(table[c] for c in token) for token, i in _tokenizer(path).get_vocab(with_added_tokens=False).items() if all(c in table for c in token)}


def tokenizer_path(name: str, folder: str = TOKENIZER_DIR) -> str:
    """The file of a vocabulary, by name or by path."""
    return name if os.sep in name else f"{folder}/{name}.json"


@functools.cache
def cuts_at_spaces(path: str) -> bool:
    """Whether texts may be cut at a space between two other characters: no token goes on behind such a space, and nothing rewrites texts first."""
    tokenizer, known = _tokenizer(path), _token_bytes(path)
    whole = tokenizer.normalizer is None and len(known) == tokenizer.get_vocab_size(with_added_tokens=False)
    return whole and not any(_BEHIND.search(token.decode("utf-8", "replace")) for token in known.values() if b" " in token[1:])


class _Chunks(dict):
    """Text between single spaces -> its ids as bytes; emptied when full, so a worker's memory stays bounded.

    Vocabularies for which :func:`cuts_at_spaces` holds never join what lies on both sides of a space between two other characters, but for
    that space itself, which goes to the right. Texts are cut there, and each chunk is encoded once. Texts of other vocabularies stay whole.
    """

    LIMIT = 500_000

    def __init__(self, path: str) -> None:
        self.path = path

    def learn(self, chunks: set[str]) -> None:
        """Encode the chunks that aren't known, together."""
        new = [c for c in chunks if c not in self]
        if len(self) + len(new) > self.LIMIT:
            self.clear()
            new = list(chunks)
        for chunk, encoding in zip(new, _tokenizer(self.path).encode_batch(new, add_special_tokens=False)):
            self[chunk] = np.array(encoding.ids, np.int32).tobytes()


@functools.cache
def _chunks(path: str) -> _Chunks:
    return _Chunks(path)


def _cut(text: str) -> list[str]:
    first, *rest = _BETWEEN.split(text)
    return [first, *(" " + part for part in rest)]


def _id_lists(path: str, texts: list[str]) -> Iterator[np.ndarray]:
    """The ids of each text."""
    if not cuts_at_spaces(path):
        for text in texts:
            yield np.array(_tokenizer(path).encode(text, add_special_tokens=False).ids, np.int32)
        return
    known, at = _chunks(path), 0
    while at < len(texts):
        cut, size = [], 0
        while at < len(texts) and (not cut or size + len(texts[at]) <= CHARS_AT_A_TIME):
            cut.append(_cut(texts[at]))
            size += len(texts[at])
            at += 1
        known.learn({chunk for chunks in cut for chunk in chunks})
        for chunks in cut:
            yield np.frombuffer(b"".join(map(known.__getitem__, chunks)), np.int32)


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> DataFrame:
    """``id_col`` and ``ids``, the token ids of every row's text without special tokens."""
    path = tokenizer_path(tokenizer, folder)
    source = df.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_A_TIME):
                part = batch.slice(at, ROWS_AT_A_TIME)
                ids = list(_id_lists(path, [t or "" for t in part.column(1).to_pylist()]))
                offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], [id_col, "ids"])

    schema = T.StructType([source.schema[0], T.StructField("ids", _ENCODED, False)])
    return source.mapInArrow(run, schema)


def encode_with_offsets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> DataFrame:
    """``id_col`` and ``tokens``: id, byte range and range of the characters the token touches."""
    path = tokenizer_path(tokenizer, folder)
    source = df.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))

    def spans(text: str, ids: list[int]) -> list[dict]:
        raw, at, out = text.encode("utf-8", "replace"), 0, []
        starts, ends, char = [0] * (len(raw) + 1), [0] * (len(raw) + 1), -1
        for i, b in enumerate(raw):
            char += (b & 0xC0) != 0x80
            starts[i], ends[i + 1] = char, char + 1
        for token in ids:
            to = at + len(_token_bytes(path)[token])
            out.append({"id": token, "byte_start": at, "byte_end": to, "char_start": starts[at], "char_end": ends[to]})
            at = to
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kind = to_arrow_type(_TOKENS)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = [spans(t, ids.tolist()) for t, ids in zip(texts, _id_lists(path, texts))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens, kind)], [id_col, "tokens"])

    schema = T.StructType([source.schema[0], T.StructField("tokens", _TOKENS, False)])
    return source.mapInArrow(run, schema)


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> DataFrame:
    """``id_col`` and ``text``: the bytes of all tokens joined, then read as UTF-8; a null list gives ''.

    Bytes that form no character (a list cut inside a character) become U+FFFD.
    """
    path = tokenizer_path(tokenizer, folder)
    source = df.select(F.col(id_col), F.col(ids_col).alias("__ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _token_bytes(path)
        for batch in batches:
            texts = [b"".join(map(table.__getitem__, ids or [])).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    schema = T.StructType([source.schema[0], T.StructField("text", T.StringType(), False)])
    return source.mapInArrow(run, schema)
