"""Problem 4: cutting oversized items at natural boundaries.

A token is a maximal run of non-white-space. An item is oversized if it has more tokens or more
code points than its limit. The cut positions are found by dynamic programming over the token
boundaries: the cost of a split is the sum of the penalties of its cuts (a paragraph or row end
costs nothing, a sentence end little, a place between any two words more, within a token most) plus
the squared deviation of each piece from an even share; every piece must obey both limits, overlap
included. Consecutive pieces share exactly ``overlap_tokens`` tokens (the second piece begins so
many tokens before the cut).

Defined results: null and empty texts and texts within the limits are not cut; a null limit does
not apply; an item whose kind and type have no row in the limits is not cut. A token that alone is longer
than max_chars is cut into runs of code points, each of which then counts as a token. Where an
overlap would take more than half of max_chars, it shrinks to the tokens that fit there. Writing
without spaces is also divided after its sentence and clause marks, and each part counts as a token. An oversized text of nothing but white
space gives one empty piece. Repeated rows of an
item give its pieces once; rows of one id with different texts are told apart by ``text_hash``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space as Python's str.split() and str.strip() know it, for Java's regex.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
_TOKEN = re.compile(r"\S+")
_UNSPACED = re.compile(r"[^。！？；，：]*[。！？；，：]+[”’」』）]*")

#: Cost of a cut after a token, by what ends there; the rows of an item type that differ from the common ones.
_COMMON = {"paragraph": 0.0, "line": 1.0, "sentence": 0.5, "clause": 2.0, "comma": 3.0, "word": 6.0, "inside": 30.0}
_BY_TYPE = {
    "table": _COMMON | {"paragraph": 0.0, "line": 0.0, "cell": 6.0, "sentence": 12.0, "clause": 12.0, "comma": 12.0, "word": 15.0},
    "references": _COMMON | {"entry": 0.0, "line": 2.0, "sentence": 3.0},
    "equation": _COMMON | {"line": 0.0, "sentence": 4.0, "operator": 1.0},
    "title": _COMMON | {"line": 0.5},
    "section_heading": _COMMON | {"line": 0.5},
}
_SENTENCE_END = re.compile(r"[.!?…。！？][\"'”’»)\]]*$")
_CLAUSE_END = re.compile(r"[;:；：][\"'”’»)\]]*$")
_COMMA_END = re.compile(r"[,，、)\]–—-][\"'”’»]*$")
_ABBREVIATION = re.compile(r"^(?:[A-Z]|e\.g|i\.e|Fig|Eq|No|Vol|p|pp|vs|cf|al|z\.B|d\.h|bzw|St|Dr|Mr|Mrs|\d{1,2})\.$", re.I)
_ENTRY = re.compile(r"^(?:\[\d+\]|\d+[.)])$")
_OPERATOR = re.compile(r"^[=+\-*/<>≤≥≈∑∏]$")
#: Weight of the deviation from an even share, in which the whole share counts 1.
BALANCE = 8.0


def spans(text: str, max_chars: int | None) -> list[tuple[int, int]]:
    """Start and end of every token; unspaced writing by clauses, and tokens longer than max_chars as several."""
    out = []
    for m in _TOKEN.finditer(text):
        at, end = m.span()
        marks = [c.end() for c in _UNSPACED.finditer(text, at, end)] if not m[0].isascii() else []
        for stop in [*marks, end]:
            while max_chars and stop - at > max_chars:
                out.append((at, at + max_chars))
                at += max_chars
            if at < stop:
                out.append((at, stop))
                at = stop
    return out


def penalties(text: str, tokens: list[tuple[int, int]], item_type: str) -> np.ndarray:
    """The cost of a cut between token i and i + 1."""
    costs = _BY_TYPE.get(item_type, _COMMON)
    out = np.empty(max(len(tokens) - 1, 0))
    for i in range(len(out)):
        (start, end), (following, after) = tokens[i], tokens[i + 1]
        if end == following:
            mark = text[end - 1]
            out[i] = costs["sentence" if mark in "。！？" else "clause" if mark in "；：" else "comma" if mark in "，”’」』）" else "inside"]
            continue
        gap, token, beyond = text[end:following], text[start:end], text[following:after]
        kinds = ["word"]
        if gap.count("\n") > 1:
            kinds.append("paragraph")
        elif "\n" in gap:
            kinds.append("line")
        if "entry" in costs and _ENTRY.match(beyond) and "\n" in gap:
            kinds.append("entry")
        if token == "|" or beyond == "|":
            kinds.append("cell")
        if _SENTENCE_END.search(token) and not _ABBREVIATION.match(token):
            kinds.append("sentence")
        elif _CLAUSE_END.search(token):
            kinds.append("clause")
        elif _COMMA_END.search(token):
            kinds.append("comma")
        if "operator" in costs and _OPERATOR.match(beyond):
            kinds.append("operator")
        out[i] = min(costs.get(k, np.inf) for k in kinds)
    return out


def cuts(tokens: list[tuple[int, int]], costs: np.ndarray, max_tokens: int | None, max_chars: int | None, overlap: int) -> list[tuple[int, int]]:
    """First and end token of each piece of the cheapest split.

    ``best[j]`` is the least cost of covering tokens 0..j with a piece that ends at j; a piece that
    continues from a cut at i starts ``overlap`` tokens before i, or later if it would otherwise not fit.
    """
    n = len(tokens)
    starts = np.fromiter((s for s, _ in tokens), np.int64, n)
    ends = np.fromiter((e for _, e in tokens), np.int64, n)
    limit = max_tokens or n
    overlap = max(0, min(overlap or 0, limit - 1))
    share = max(min(limit, n) - overlap, 1)
    if max_chars:
        mean = max((ends[-1] - starts[0]) / n, 1e-9)
        share = max(min(share, max_chars / mean - overlap), 1)
    pieces = max(1, int(np.ceil((n - overlap) / share)))
    even = max((n - overlap) / pieces, 1)
    # first[j]: the least token from which a piece that ends at token j (inclusive) obeys both limits
    # resume[i]: the token at which a piece begins that continues from a cut before token i
    first = np.maximum(np.arange(n) - limit + 1, 0)
    resume = np.maximum(np.arange(n + 1) - overlap, 0)
    if max_chars:
        first = np.maximum(first, np.searchsorted(starts, ends - max_chars))
        resume[1:] = np.maximum(resume[1:], np.searchsorted(starts, ends - max_chars // 2))
    best = np.full(n + 1, np.inf)  # by number of tokens covered
    best[0], back, begin = 0.0, np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    for j in range(1, n + 1):
        low = first[j - 1]
        i = np.arange(min(int(np.searchsorted(resume[:j], low)), j - 1), j)
        cost = best[i] + BALANCE * ((j - np.maximum(resume[i], low) - overlap - even) / even) ** 2
        k = int(np.argmin(cost))
        best[j] = cost[k] + (costs[j - 1] if j < n else 0.0)
        back[j], begin[j] = i[k], max(resume[i[k]], low)
    out, j = [], n
    while j:
        out.append((int(begin[j]), j))
        j = int(back[j])
    return out[::-1]


def pieces(text: str, item_type: str, max_tokens: int | None, max_chars: int | None, overlap: int | None) -> list[dict]:
    """The ordered pieces of a text: offsets in code points, text, tokens, and tokens shared with the piece before."""
    tokens = spans(text, max_chars)
    if not tokens:
        return [{"piece_no": 0, "char_start": 0, "char_end": 0, "n_tokens": 0, "n_shared": 0, "text": ""}]
    out, before = [], 0
    for number, (first, end) in enumerate(cuts(tokens, penalties(text, tokens, item_type), max_tokens, max_chars, overlap or 0)):
        start, stop = tokens[first][0], tokens[end - 1][1]
        out.append({"piece_no": number, "char_start": start, "char_end": stop, "n_tokens": end - first, "n_shared": before - first if number else 0, "text": text[start:stop]})
        before = end
    return out


def n_tokens(text: Column) -> Column:
    """Number of maximal runs of non-white-space."""
    return F.size(F.filter(F.split(text, f"{SPACE}+"), lambda t: t != ""))


def oversized(items: DataFrame, limits: DataFrame) -> DataFrame:
    """Rows of ``items`` (item_kind, item_type, item_id, text) over their limit, with the limits.

    ``limits`` is the small table of limits, one row for each kind and type.
    """
    rules = limits.select("item_kind", F.col("item_type").alias("rule"), "max_tokens", "max_chars", "overlap_tokens").dropDuplicates(["item_kind", "rule"])
    fitting = rules.where("rule <> 'any'").select("item_kind", F.col("rule").alias("item_type"), *rules.columns[2:])
    fallback = rules.where("rule = 'any'").select("item_kind", *(F.col(c).alias(f"any_{c}") for c in rules.columns[2:]), F.lit(True).alias("has_any"))
    named = fitting.withColumn("has_rule", F.lit(True))
    joined = items.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).join(F.broadcast(named), ["item_kind", "item_type"], "left").join(F.broadcast(fallback), "item_kind", "left")
    for c in rules.columns[2:]:
        joined = joined.withColumn(c, F.when(F.col("has_rule"), F.col(c)).otherwise(F.col(f"any_{c}")))
    size = F.char_length("text")
    # n tokens take at least 2n - 1 code points, so most texts are decided without counting tokens.
    many = (size > 2 * F.col("max_tokens")) & (n_tokens(F.col("text")) > F.col("max_tokens"))
    return joined.where((size > F.col("max_chars")) | many).select("item_kind", "item_type", "item_id", "text", "max_tokens", "max_chars", "overlap_tokens")


def split_items(items: DataFrame, limits: DataFrame) -> DataFrame:
    """item_kind, item_id, text_hash, piece_no, n_pieces, char_start, char_end, n_tokens, n_shared, text of all oversized items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            columns = (batch.column(n).to_pylist() for n in ("text", "item_type", "max_tokens", "max_chars", "overlap_tokens"))
            for row, (text, *rest) in enumerate(zip(*columns)):
                cut = pieces(text, *rest)
                rows += [row] * len(cut)
                found += [p | {"n_pieces": len(cut)} for p in cut]
            at = pa.array(rows, pa.int64())
            ints = [pa.array([p[n] for p in found], pa.int32()) for n in names[2:]]
            kept = [batch.column(n).take(at) for n in ("item_kind", "item_id", "text_hash")]
            yield pa.RecordBatch.from_arrays([*kept, *ints, pa.array([p["text"] for p in found], pa.string())], ["item_kind", "item_id", "text_hash", *names[2:], "text"])

    names = ["item_kind", "item_id", "piece_no", "n_pieces", "char_start", "char_end", "n_tokens", "n_shared"]
    over = oversized(items, limits).withColumn("text_hash", F.xxhash64("text"))
    schema = "item_kind string, item_id string, text_hash bigint, " + ", ".join(f"{n} int" for n in names[2:]) + ", text string"
    return over.mapInArrow(run, schema).dropDuplicates(["item_kind", "item_id", "text_hash", "piece_no"])


def all_items(elements: DataFrame, parents: DataFrame, children: DataFrame) -> DataFrame:
    """The three tables as item_kind, item_type, item_id, text."""
    return (
        elements.select(F.lit("element").alias("item_kind"), F.col("element_type").alias("item_type"), F.col("element_id").alias("item_id"), "text")
        .unionAll(parents.select(F.lit("parent"), F.lit("any"), "parent_id", "text"))
        .unionAll(children.select(F.lit("child"), F.col("chunk_type"), "child_id", "text"))
    )
