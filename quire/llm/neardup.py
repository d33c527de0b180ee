"""Problem 5: pairs and groups of edited versions, by BK-trees over Hamming signatures.

Texts become sets of hashed runs of three words. Each distinct set (a class of copies) gets 256
min-wise hashes, computed once; their lowest bits form a signature whose Hamming distance estimates
``(1 - similarity) / 2`` of 256 bits. Classes that agree in three consecutive min-wise hashes meet
in a shard; every shard becomes a BK-tree, whose children are keyed by their integer Hamming
distance to the parent, and a search follows only the edges within the radius. Candidates are
verified on the full sets, so no reported pair is an estimate.

The shard trees are not broadcast: they grow with the corpus. They are built where the shuffle
brings a shard's members. A shard of more than ``TREE_SIZE`` members (a page template, say) is cut by ``SUBS`` further keys of
two min-wise hashes each; what still is larger then agrees in five hashes, so nearly all its pairs are results, and is
split into several trees that all its members search.

A pair of similarity 0.6 misses all 42 shards with a probability of (1 - 0.6**3)**42 = 0.00004, the further keys of large shards with
(1 - 0.6**2)**24 = 0.00002 and the radius (mean 51.2, deviation 6.4) with 0.00003.

What the trees exclude: two signatures without a common text lie about 128 bits apart, give or take 8, and so do a node and its unrelated
children, so that the difference of both distances is far below a radius that admits a similarity of 0.6 (0.2 of the
bits and four deviations). No width changes that, as the radius and the distances grow alike. Candidates come from the shards, and
the trees of this problem visit nearly all their nodes; they prune at radii for small edits (see the tests).

Defined results: null texts and texts of fewer than three words are in no pair and form groups of
their own. Rows of a doc_id with several texts count through each of them. Repeated rows, and
rows with a null id, change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.words import grams, mixed, word_hashes
from quire.session import checkpointed

SHINGLE = 3
BITS = 256
ROWS = 3
BANDS = 42
#: Four standard deviations beyond the expected distance at similarity 0.6.
RADIUS = 77
TREE_SIZE = 1_000
#: Further keys of the members of larger shards, of two hashes each beyond those of the bands.
SUBS = 24

_rng = np.random.default_rng(20_111)
_FACTORS = _rng.integers(1, 1 << 63, BITS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _rng.integers(0, 1 << 63, BITS, dtype=np.uint64)


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    """The 256 smallest values of as many hash functions over a set of hashes."""
    best = np.full(BITS, (1 << 32) - 1, np.uint64)
    for at in range(0, len(shingles), 1024):
        part = (shingles[at : at + 1024, None] * _FACTORS + _TERMS) >> np.uint64(32)
        np.minimum(best, part.min(axis=0), out=best)
    return best


def signature(minima: np.ndarray) -> bytes:
    """The lowest bit of each minimum; BITS bits."""
    return np.packbits((minima & np.uint64(1)).astype(np.uint8)).tobytes()


def _keys(parts: np.ndarray) -> np.ndarray:
    """One hash for each row of minima; rows at different places differ."""
    key = np.arange(1, len(parts) + 1, dtype=np.uint64)
    for i in range(parts.shape[1]):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, i])
    return key


def band_keys(minima: np.ndarray) -> np.ndarray:
    """One hash for each of BANDS runs of ROWS minima."""
    return _keys(minima[: BANDS * ROWS].reshape(BANDS, ROWS))


def sub_keys(minima: np.ndarray) -> np.ndarray:
    """One hash for each of SUBS pairs of the minima that no band uses."""
    return _keys(minima[BANDS * ROWS : BANDS * ROWS + 2 * SUBS].reshape(SUBS, 2))


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, class (null below three words), shingles, and sig, bands, subs of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, sets, known = [], [], {}
            for text in batch.column(1):
                found = np.unique(mixed(grams(word_hashes(text.as_py()), SHINGLE)))
                name = xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None
                classes.append(name)
                sets.append(found.view(np.int64))
                if name and name not in known:
                    minima = min_hashes(found)
                    known[name] = (signature(minima), band_keys(minima).tobytes(), sub_keys(minima).tobytes())
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64)))
            narrow = [pa.array([known[c][n] if c else None for c in classes], pa.binary()) for n in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(classes, pa.binary()), lists, *narrow], ["doc", "class", "shingles", "sig", "bands", "subs"])

    source = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("__text")).where(F.col("doc").isNotNull())
    kind = source.schema["doc"].dataType.simpleString()
    return source.mapInArrow(run, f"doc {kind}, class binary, shingles array<bigint>, sig binary, bands binary, subs binary")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """class, sig, shard for each key packed in the third column; keys of a second level are mixed with the shard above."""
    for batch in batches:
        packed = batch.column(2)
        keys = np.frombuffer(b"".join(packed.to_pylist()), np.uint64)
        each = len(keys) // max(1, batch.num_rows)
        rows = np.repeat(np.arange(batch.num_rows), each)
        if batch.num_columns > 3:
            keys = mixed(keys ^ batch.column(3).to_numpy().view(np.uint64)[rows])
        at = pa.array(rows)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(keys.view(np.int64))], ["class", "sig", "shard"])


_MEMBER = "class binary, sig binary, shard bigint"


class BKTree:
    """Points are ints of BITS bits; the children of a node are keyed by their Hamming distance to it."""

    def __init__(self) -> None:
        self.nodes: list[tuple[int, bytes, dict[int, int]]] = []
        #: Nodes that searches have looked at.
        self.visited = 0

    def add(self, bits: int, name: bytes) -> None:
        self.nodes.append((bits, name, {}))
        new, at = len(self.nodes) - 1, 0
        while new:
            own, _, children = self.nodes[at]
            distance = (own ^ bits).bit_count()
            if distance not in children:
                children[distance] = new
                return
            at = children[distance]

    def near(self, bits: int, radius: int) -> Iterator[bytes]:
        """Names of all points within the radius."""
        todo = [0] if self.nodes else []
        while todo:
            own, name, children = self.nodes[todo.pop()]
            self.visited += 1
            distance = (own ^ bits).bit_count()
            if distance <= radius:
                yield name
            todo += [child for edge, child in children.items() if abs(edge - distance) <= radius]


def _pairs(a: list[bytes], b: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["class_a", "class_b"])


def _within(radius: int):
    """Candidate pairs of the shards in a partition that is sorted by shard, none larger than TREE_SIZE."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, tree = None, BKTree()
        for batch in batches:
            a, b = [], []
            for key, name, sig in zip(*(batch.column(n).to_pylist() for n in ("shard", "class", "sig"))):
                if key != shard:
                    shard, tree = key, BKTree()
                bits = int.from_bytes(sig, "big")
                for other in tree.near(bits, radius):
                    a.append(min(other, name))
                    b.append(max(other, name))
                tree.add(bits, name)
            yield _pairs(a, b)

    return run


def _across(radius: int):
    """Candidate pairs of a partition that is sorted by shard, part and role: those that ask search the tree of those before them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, tree = None, BKTree()
        for batch in batches:
            a, b = [], []
            for key, part, asks, name, sig in zip(*(batch.column(n).to_pylist() for n in ("shard", "part", "asks", "class", "sig"))):
                if (key, part) != at:
                    at, tree = (key, part), BKTree()
                bits = int.from_bytes(sig, "big")
                if not asks:
                    tree.add(bits, name)
                    continue
                for other in tree.near(bits, radius):
                    if other < name:
                        a.append(other)
                        b.append(name)
            yield _pairs(a, b)

    return run


_PAIR = "class_a binary, class_b binary"


def _split(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of shards that fit one tree, and shard, count of the larger ones, which are few."""
    large = checkpointed(members.groupBy("shard").count().where(F.col("count") > TREE_SIZE))
    return members.join(large, "shard", "left_anti") if not large.isEmpty() else members, large


def _small(members: DataFrame, radius: int) -> DataFrame:
    return members.select("shard", "class", "sig").repartition("shard").sortWithinPartitions("shard").mapInArrow(_within(radius), _PAIR)


def candidates(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """class_a < class_b, once each: the pairs that the shard trees find among ``classes`` (class, sig, bands, subs)."""
    members = classes.select("class", "sig", "bands").mapInArrow(_unpacked, _MEMBER)
    small, large = _split(members)
    found = _small(small, radius)
    if not large.isEmpty():
        inside = members.join(large.select("shard"), "shard", "left_semi")
        members = checkpointed(inside.join(classes.select("class", "subs"), "class").select("class", "sig", "subs", "shard").mapInArrow(_unpacked, _MEMBER))
        small, large = _split(members)
        found = found.unionAll(_small(small, radius))
        if not large.isEmpty():
            rest = members.join(large.select("shard", F.ceil(F.col("count") / TREE_SIZE).cast("int").alias("parts")), "shard")
            # xxhash64, as the shuffle itself partitions by another hash.
            stored = rest.select("shard", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int").alias("part"), F.lit(False).alias("asks"), "class", "sig")
            asking = rest.select("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("asks"), "class", "sig")
            found = found.unionAll(stored.unionAll(asking).repartition("shard", "part").sortWithinPartitions("shard", "part", "asks").mapInArrow(_across(radius), _PAIR))
    return found.distinct()


def similar_classes(rows: DataFrame, threshold: float = 0.6, radius: int = RADIUS) -> DataFrame:
    """class_a, class_b, similarity of all linked pairs of classes among ``rows`` of :func:`sketches`."""
    named = rows.where(F.col("class").isNotNull())
    pairs = checkpointed(candidates(checkpointed(named.select("class", "sig", "bands", "subs").dropDuplicates(["class"])), radius))
    involved = pairs.select(F.explode(F.array("class_a", "class_b")).alias("class")).distinct()
    # Sets meet their pairs by shuffles only: an array's size is no number that a planner knows.
    sets = named.select("class", "shingles").join(involved.hint("merge"), "class", "left_semi").dropDuplicates(["class"]).hint("merge")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return (
        pairs.join(sets.select(F.col("class").alias("class_a"), F.col("shingles").alias("set_a")), "class_a")
        .join(sets.select(F.col("class").alias("class_b"), F.col("shingles").alias("set_b")), "class_b")
        .select("class_a", "class_b", common.alias("common"), (F.size("set_a") + F.size("set_b") - common).alias("either"))
        .select("class_a", "class_b", (F.col("common") / F.col("either")).alias("similarity"))
        .where(F.col("similarity") >= threshold)
    )


def _prepared(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    rows = checkpointed(sketches(docs, id_col, text_col))
    return rows.select("doc", "class").distinct(), rows


def similar_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.6) -> DataFrame:
    """``doc_a`` < ``doc_b`` of all pairs of ids with texts at least ``threshold`` alike, copies included."""
    members, rows = _prepared(docs, id_col, text_col)
    links = similar_classes(rows, threshold).select("class_a", "class_b")
    ends_a = members.where(F.col("class").isNotNull()).select(F.col("class").alias("class_a"), F.col("doc").alias("a"))
    ends_b = members.where(F.col("class").isNotNull()).select(F.col("class").alias("class_b"), F.col("doc").alias("b"))
    across = links.join(ends_a, "class_a").join(ends_b, "class_b").where("a <> b")
    copied = members.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least <> most").select("class")
    same = ends_a.join(copied, F.col("class_a") == F.col("class"), "left_semi").join(ends_b, F.expr("class_a = class_b and a < b"))
    return across.select("a", "b").unionAll(same.select("a", "b")).select(F.least("a", "b").alias("doc_a"), F.greatest("a", "b").alias("doc_b")).distinct()


def _print(edges: DataFrame) -> tuple:
    """What tells one set of edges from another: their number and two sums of hashes, in one row."""
    return tuple(edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(a, b) as decimal(38, 0)))"), F.expr("bit_xor(xxhash64(b, a))")).first())


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``node``, ``group`` (its component's smallest node), by alternating large and small stars.

    ``nodes`` has ``node``, ``links`` has ``a`` and ``b``. Every step is a grouped aggregation; the
    edges are written between rounds. A node's neighbours are never brought together in one row.
    """
    edges = checkpointed(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))
        new = checkpointed(small.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        if _print(new) == _print(edges):
            return nodes.join(new.select(F.col("a").alias("node"), F.col("b").alias("g")), "node", "left").select("node", F.coalesce("g", "node").alias("group"))
        edges = new


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.6) -> DataFrame:
    """``id_col``, ``class_id``, ``group_id`` and ``n_links`` (other classes its own is linked to), one row for every id and class."""
    members, rows = _prepared(docs, id_col, text_col)
    links = checkpointed(similar_classes(rows, threshold).select(F.col("class_a").alias("a"), F.col("class_b").alias("b")))
    linked = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy(F.col("a").alias("class")).agg(F.count("*").alias("n_links"))
    found = components(linked.select(F.col("class").alias("node")), links).select(F.col("node").alias("class"), "group")
    own = F.coalesce("class", F.sha1(F.col("doc").cast("string")).cast("binary"))
    return (
        members.join(linked, "class", "left")
        .join(found, "class", "left")
        .select(F.col("doc").alias(id_col), F.hex(own).alias("class_id"), F.hex(F.coalesce("group", own)).alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
