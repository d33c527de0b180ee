"""Near-duplicates: pairs against brute force, the tree, components."""

import itertools
import random
import re

import numpy as np

from quire.llm import neardup


def shingles(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return set(zip(words, words[1:], words[2:]))


def brute_force(rows, threshold=0.6):
    out = set()
    for (a, ta), (b, tb) in itertools.combinations([(d, shingles(t)) for d, t in rows if d is not None], 2):
        if a != b and ta and tb and 5 * len(ta & tb) >= 5 * threshold * len(ta | tb):
            out.add((min(a, b), max(a, b)))
    return out


def corpus():
    rng, vocabulary = random.Random(9), [f"w{i}" for i in range(400)]
    rows = [(None, "a b c d"), ("null", None), ("empty", ""), ("two", "a b"), ("x1", "a b c"), ("x2", "A, b; C!"), ("long", "z y x w " * 30_000)]
    for base in range(40):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(5, 120))]
        for edit in range(rng.randint(1, 4)):
            changed = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 12))):
                changed[rng.randrange(len(changed))] = rng.choice(vocabulary)
            rows.append((f"d{base}-{edit}", " ".join(changed)))
    rows += [(f"copy{i}", rows[20][1].upper()) for i in range(5)] + [rows[10], rows[11]] + [("d1-0", rows[30][1])]
    return rows


def test_pairs_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(d, t, b"clash") for d, t in rows], "doc_id string, text string, class binary").repartition(5)
    assert {tuple(r) for r in neardup.similar_pairs(df).collect()} == brute_force(rows)


def test_groups_are_the_components_of_the_pairs(spark):
    rows = [r for r in corpus() if r[0] != "d1-0"]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r.doc_id: r for r in neardup.groups(df).collect()}
    assert set(got) == {d for d, _ in rows if d is not None}
    parent = {d: d for d in got}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, b in brute_force(rows):
        parent[root(a)] = root(b)
    for a, b in itertools.combinations(got, 2):
        assert (got[a].group_id == got[b].group_id) == (root(a) == root(b))


def test_hot_shards_are_split_over_trees(spark, monkeypatch):
    """A group far larger than a tree, all its members alike."""
    monkeypatch.setattr(neardup, "TREE_SIZE", 4)
    words = [f"w{i}" for i in range(60)]
    rows = [(f"d{i:02}", " ".join([*words, f"own{i}"])) for i in range(25)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    assert neardup.similar_pairs(df).count() == 25 * 24 // 2


def test_templates_in_hot_shards_lose_no_link(spark, monkeypatch):
    """Pages of one template, most of them no links, and a few edits of each; shards are cut by further keys and then split."""
    monkeypatch.setattr(neardup, "TREE_SIZE", 6)
    rng, template = random.Random(2), [f"t{i}" for i in range(40)]
    rows = []
    for page in range(40):
        own = [f"p{page}x{rng.randrange(10**6)}" for _ in range(45)]
        for edit in range(rng.choice([1, 1, 2, 3])):
            rows.append((f"d{page:02}-{edit}", " ".join([*template, *own[:44], f"e{page}{edit}"])))
    df = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    assert {tuple(r) for r in neardup.similar_pairs(df).collect()} == brute_force(rows)


def test_how_much_the_tree_excludes():
    """Nothing at the radius of a similarity of 0.6, nearly all at that of a few changed words; see the module's text."""
    rng = np.random.default_rng(8)
    points = [int.from_bytes(rng.bytes(neardup.BITS // 8), "big") for _ in range(1000)]
    tree = neardup.BKTree()
    for i, p in enumerate(points):
        tree.add(p, i)
    share = {}
    for radius in (2, neardup.RADIUS):
        tree.visited = 0
        for q in points[:50]:
            assert list(tree.near(q, radius)) == [points.index(q)]
        share[radius] = tree.visited / (50 * len(points))
    assert share[2] < 0.2 and share[neardup.RADIUS] > 0.95


def test_tree_finds_all_within_the_radius():
    rng = np.random.default_rng(3)
    points = [int.from_bytes(rng.bytes(4), "big") for _ in range(300)]
    points += points[:5]
    tree = neardup.BKTree()
    for i, p in enumerate(points):
        tree.add(p, i)
    for q in points[:20]:
        for radius in (0, 5, 11):
            assert sorted(tree.near(q, radius)) == [i for i, p in enumerate(points) if (p ^ q).bit_count() <= radius]
    assert list(neardup.BKTree().near(1, 5)) == []


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(f"{i:03}", f"{i + 1:03}") for i in range(0, 60) if i != 30] + [("000", "000")], "a string, b string")
    nodes = spark.createDataFrame([(f"{i:03}",) for i in range(62)], "node string")
    got = {r.node: r.group for r in neardup.components(nodes, links).collect()}
    assert got == {f"{i:03}": "000" if i <= 30 else "061" if i == 61 else "031" for i in range(62)}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id string, text string")
    assert neardup.similar_pairs(empty).count() == neardup.groups(empty).count() == 0
