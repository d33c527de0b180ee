"""Splitting at natural boundaries."""

import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import split


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.sampled_from(["a", "word", "end.", "so,", "x" * 30, "长句子。又一句，还有", "\n", "|"]), min_size=1, max_size=120), st.integers(1, 20), st.one_of(st.none(), st.integers(8, 90)), st.integers(0, 8), st.sampled_from(["paragraph", "table", "references"])
)
def test_pieces_obey_limits_and_cover_the_text(words, max_tokens, max_chars, overlap, kind):
    text = " ".join(words)
    pieces = split.pieces(text, kind, max_tokens, max_chars, overlap)
    tokens = split.spans(text, max_chars)
    if not tokens:
        assert [p["text"] for p in pieces] == [""]
        return
    covered = 0
    for n, p in enumerate(pieces):
        assert p["n_tokens"] <= max_tokens and (max_chars is None or len(p["text"]) <= max_chars)
        assert p["text"] == text[p["char_start"] : p["char_end"]]
        first = next(i for i, t in enumerate(tokens) if t[0] == p["char_start"])
        assert first <= covered and covered - first == (p["n_shared"] if n else 0)
        assert p["n_shared"] <= overlap
        covered = first + p["n_tokens"]
    assert covered == len(tokens)


def test_overlap_is_exact_where_it_fits():
    text = " ".join(f"w{i}." if i % 7 == 0 else f"w{i}" for i in range(300))
    pieces = split.pieces(text, "paragraph", 40, None, 8)
    assert all(p["n_shared"] == 8 for p in pieces[1:])
    for a, b in itertools.pairwise(pieces):
        assert a["text"].split()[-8:] == b["text"].split()[:8]


def test_cuts_fall_at_sentence_and_row_ends():
    text = " ".join(["aa bb cc dd ee."] * 40)
    assert all(p["text"].endswith(".") for p in split.pieces(text, "paragraph", 23, None, 0))
    rows = "\n".join("a | b | c" for _ in range(40))
    assert all(p["text"].endswith("c") and p["text"].startswith("a") for p in split.pieces(rows, "table", 23, None, 0))


@pytest.mark.parametrize("overlap", [0, 2])
def test_cheapest_split_by_brute_force(overlap):
    """All sets of cuts of a short text, against the dynamic program."""
    rng = np.random.default_rng(5)
    for _ in range(25):
        n, limit = int(rng.integers(6, 13)), 5
        tokens = [(3 * i, 3 * i + 2) for i in range(n)]
        costs = rng.choice([0.0, 0.5, 2.0, 6.0], n - 1)
        got = split.cuts(tokens, costs, limit, None, overlap)
        share = max(min(limit, n) - overlap, 1)
        even = max((n - overlap) / max(1, int(np.ceil((n - overlap) / share))), 1)

        def cost(ends):
            total, start = 0.0, 0
            for e in ends:
                begin = max(start - overlap, 0) if start else 0
                if e - begin > limit:
                    return np.inf
                total += split.BALANCE * ((e - begin - overlap - even) / even) ** 2 + (costs[e - 1] if e < n else 0)
                start = e
            return total

        best = min(cost((*c, n)) for k in range(n) for c in itertools.combinations(range(1, n), k))
        assert cost([e for _, e in got]) == pytest.approx(best)


def test_operator(spark):
    items = [("element", "paragraph", "long", "w " * 50), ("element", "paragraph", "long", "w " * 50), ("element", "paragraph", "short", "w w"), ("element", "other", "none", "w " * 50), ("element", "paragraph", "null", None), ("parent", "any", "p", "w " * 50), ("element", None, "nokind", "w " * 50), ("element", "paragraph", "blank", " " * 99), ("element", "paragraph", None, "w " * 50)]
    limits = [("element", "paragraph", 10, 60, 2), ("parent", "any", None, 30, None), ("parent", "any", None, 30, None)]
    df = spark.createDataFrame([(*i, 1) for i in items], "item_kind string, item_type string, item_id string, text string, piece_no int")
    out = split.split_items(df, spark.createDataFrame(limits, "item_kind string, item_type string, max_tokens int, max_chars int, overlap_tokens int")).collect()
    assert {r.item_id for r in out} == {"long", "p", "blank"}
    assert all(r.n_tokens <= 10 and len(r.text) <= 60 for r in out if r.item_id == "long")
    assert sorted(r.piece_no for r in out if r.item_id == "long") == list(range(out[0].n_pieces if out[0].item_id == "long" else next(r.n_pieces for r in out if r.item_id == "long")))
    assert split.split_items(df.limit(0), spark.createDataFrame(limits, "item_kind string, item_type string, max_tokens int, max_chars int, overlap_tokens int")).count() == 0
