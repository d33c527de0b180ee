"""Problem 7: passages of held-out evaluation items inside a corpus, by winnowing.

Every text is fingerprinted: of each window of ``WINDOW`` consecutive hashes of ``GRAM`` words the
smallest is kept. Two texts that share ``GRAM + WINDOW - 1`` = 12 consecutive words share a whole
window and so a kept hash. Prompts of fewer than 12 words have no whole window: all their words are one
fingerprint, looked up where the corpus has their first ``ANCHOR`` words.

A Bloom filter of fixed size over the items' fingerprints goes to the tasks; what it lets through is joined with the items
by hash, and only then do hits meet the words around them, on both sides, and are extended word by word. What remains is exact. Items of
more than ``PER_PASS`` fingerprints are looked for in several passes, so that the filter stays selective.

Defined results: null texts and prompts, and prompts without a word, match nothing. Repeated rows
count once. Items with the same words all count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.sieve import Sieve, sieve
from quire.llm.words import extend_grams, grams, mixed, word_hashes, words
from quire.session import checkpointed

#: Words that must be shared.
SHARED = 12
GRAM = 6
WINDOW = SHARED - GRAM + 1
ANCHOR = 3
#: Item fingerprints that are looked for at once; the filter lets about 3 % of other hashes through then.
PER_PASS = 8_000_000

def winnow(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of the rightmost smallest hash of each window, each once, in order."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at = hashes[window - 1 :][:n].copy(), np.arange(window - 1, window - 1 + n)
    for back in range(window - 2, -1, -1):
        other = hashes[back : back + n]
        less = other < best
        best[less] = other[less]
        at[less] = np.nonzero(less)[0] + back
    return np.unique(at)


def long_fingerprints(base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed hashes of GRAM words and their positions, from the hashes of a text's words."""
    if len(base) < SHARED:
        return base[:0], np.zeros(0, np.int64)
    three = grams(base, 3)
    six = mixed(extend_grams(three, three[3:], 3))
    at = winnow(six)
    return six[at], at


def short_fingerprints(base: np.ndarray, sizes: tuple[int, ...], wanted: Sieve) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Hashes and positions of the runs of each of ``sizes`` words that ``wanted`` may have, looked at where it may have their first words."""
    out = []
    for anchor in {min(size, ANCHOR) for size in sizes}:
        run = grams(base, anchor)
        at = np.nonzero(wanted.mask(mixed(run)))[0]
        run = run[at]
        for size in range(anchor, (max(sizes) if anchor == ANCHOR else anchor) + 1):
            if size > anchor:
                inside = at + size <= len(base)
                at, run = at[inside], run[inside]
                run = extend_grams(run, base[at + size - 1], 1)
            if size in sizes and len(at):
                hashes = mixed(run)
                keep = wanted.mask(hashes)
                out.append((hashes[keep], at[keep], size))
    return out


def _context(text: list[str], at: int) -> tuple[int, list[str]]:
    """Number of words before a position, and the words around it, as far as any run of SHARED words through the hit can reach."""
    before = min(at, SHARED - 1)
    return before, text[at - before : at + GRAM + SHARED]


def item_fingerprints(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item, n_words, fp, anchor, size (0 for a winnowed hash, else the number of all words), item_pos, item_before, item_around."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found, base = words(text), word_hashes(text)
                n = len(found)
                if n >= SHARED:
                    hashes, at = long_fingerprints(base)
                    rows += [(item, n, h, None, 0, p, *_context(found, p)) for h, p in zip(hashes.view(np.int64).tolist(), at.tolist())]
                elif n:
                    whole, first = (int(mixed(grams(base, k)[:1]).view(np.int64)[0]) for k in (n, min(n, ANCHOR)))
                    rows.append((item, n, whole, first, n, 0, 0, found))
            columns = [list(c) for c in zip(*rows)] or [[]] * 8
            kinds = [batch.schema[0].type, pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["item", "n_words", "fp", "anchor", "size", "item_pos", "item_before", "item_around"])

    source = items.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("__text"))
    kind = source.schema["item"].dataType.simpleString()
    return source.mapInArrow(run, f"item {kind}, n_words int, fp bigint, anchor bigint, size int, item_pos int, item_before int, item_around array<string>")


def corpus_fingerprints(docs: DataFrame, id_col: str, text_col: str, sizes: tuple[int, ...], wanted: Sieve) -> DataFrame:
    """doc, fp, size, before and the words around of every fingerprint of a document that ``wanted`` may have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = wanted.opened()
        for batch in batches:
            rows, columns = [], [[], [], [], []]
            for row, text in enumerate(batch.column(1)):
                text = text.as_py()
                base = word_hashes(text)
                hashes, at = long_fingerprints(base)
                keep = known.mask(hashes)
                hits = [(hashes[keep], at[keep], 0), *(short_fingerprints(base, sizes, known) if sizes else ())]
                if not any(len(h) for h, _, _ in hits):
                    continue
                doc = words(text)
                for found, places, size in hits:
                    for h, p in zip(found.view(np.int64).tolist(), places.tolist()):
                        rows.append(row)
                        for column, value in zip(columns, (h, size, *_context(doc, p))):
                            column.append(value)
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string())]
                arrays = [batch.column(0).take(pa.array(rows)), *(pa.array(c, k) for c, k in zip(columns, kinds))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc", "fp", "size", "before", "around"])

    source = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("__text")).where(F.col("doc").isNotNull())
    kind = source.schema["doc"].dataType.simpleString()
    return source.mapInArrow(run, f"doc {kind}, fp bigint, size int, before int, around array<string>")


def shared_run(doc: list[str], item: list[str], at: int, item_at: int) -> tuple[int, int]:
    """First item word and length of the run of equal words around a hit."""
    if at >= len(doc) or item_at >= len(item) or doc[at] != item[item_at]:
        return item_at, 0
    left = 0
    while left < min(at, item_at) and doc[at - left - 1] == item[item_at - left - 1]:
        left += 1
    right = 1
    while at + right < len(doc) and item_at + right < len(item) and doc[at + right] == item[item_at + right]:
        right += 1
    return item_at - left, left + right


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, found = [], [[], []]
        columns = (batch.column(n).to_pylist() for n in ("before", "around", "item_pos", "item_before", "item_around", "n_words"))
        for row, (before, around, item_pos, item_before, prompt, n_words) in enumerate(zip(*columns)):
            start, length = shared_run(around, prompt, before, item_before)
            if length >= min(SHARED, n_words):
                rows.append(row)
                first = item_pos - item_before + start
                for column, value in zip(found, (first, first + length - 1)):
                    column.append(value)
        at = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([*(batch.column(n).take(at) for n in ("doc", "item", "n_words")), *(pa.array(c, pa.int32()) for c in found)], ["doc", "item", "n_words", "first", "last"])


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "prompt") -> DataFrame:
    """``doc_id``, ``item_id``, ``n_words`` of the item and ``n_shared``, those of its words that leaked, for each leak."""
    prints = checkpointed(item_fingerprints(items.where(F.col(item_id).isNotNull()), item_id, item_text).distinct())
    # At most SHARED - 1 sizes, and one count.
    sizes = tuple(sorted(r["size"] for r in prints.where("size > 0").select("size").distinct().collect()))
    passes = max(1, math.ceil(prints.count() / PER_PASS))
    found = None
    for i in range(passes):
        part = prints.where(F.pmod(F.xxhash64("fp"), F.lit(passes)) == i) if passes > 1 else prints
        wanted = sieve(part.select(F.explode(F.array_compact(F.array("fp", "anchor"))).alias("h")), "h")
        # Joined by shuffle: what the filter lets through is little, and the items' context has no bound.
        hits = corpus_fingerprints(docs, doc_id, doc_text, sizes, wanted).join(part.hint("merge"), ["fp", "size"])
        schema = f"doc {hits.schema['doc'].dataType.simpleString()}, item {hits.schema['item'].dataType.simpleString()}, n_words int, first int, last int"
        runs = hits.select("doc", "item", "n_words", "before", "around", "item_pos", "item_before", "item_around").mapInArrow(_extend, schema)
        found = runs if found is None else found.unionAll(runs)
    return (
        found.groupBy(F.col("doc").alias(doc_id), F.col("item").alias(item_id))
        .agg(F.max("n_words").alias("n_words"), F.collect_set(F.sequence("first", "last")).alias("__runs"))
        .select(doc_id, item_id, "n_words", F.size(F.array_distinct(F.flatten("__runs"))).alias("n_shared"))
    )
