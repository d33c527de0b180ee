"""Leaks against brute force, and the guarantee of winnowing."""

import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import leak, sieve


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute_force(docs, items):
    out = set()
    for doc, text in docs:
        w = words(text)
        for item, prompt in items:
            p = words(prompt)
            n = min(12, len(p))
            if n and doc is not None and any(w[i : i + n] == p[j : j + n] for j in range(len(p) - n + 1) for i in range(len(w) - n + 1)):
                out.add((doc, item))
    return out


def cases():
    rng, vocabulary = random.Random(4), [f"w{i}" for i in range(60)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(text(rng.choice([1, 2, 3, 5, 11, 12, 13, 20, 40])))) for i in range(40)] + [(100, None), (101, "?!"), (102, ""), (103, "same words Here"), (104, "SAME, words; here."), (104, "SAME, words; here.")]
    docs = [(None, items[3][1]), (900, None), (901, ""), (902, "nothing shared " * 20_000), (903, "the same\nwords - here again")]
    for d in range(200):
        source = words(rng.choice(items)[1]) or ["x"]
        at, n = rng.randrange(len(source)), rng.choice([3, 11, 12, 13, 40])
        docs.append((d, " ".join(text(rng.randint(0, 30)) + source[at : at + n] + text(rng.randint(0, 30)))))
    return docs + docs[:10], items


def test_equal_to_brute_force(spark):
    docs, items = cases()
    df = spark.createDataFrame([(d, t, "clash") for d, t in docs], "doc_id bigint, text string, prompt string")
    got = leak.leaks(df, spark.createDataFrame(items, "item_id bigint, prompt string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == brute_force(docs, items)
    assert all(r.n_shared <= r.n_words and r.n_shared >= min(12, r.n_words) for r in got.collect())


def test_several_passes_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(leak, "PER_PASS", 40)
    docs, items = cases()
    got = leak.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, prompt string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == brute_force(docs, items)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=0, max_size=60))
def test_every_window_keeps_its_smallest_hash(values):
    hashes = np.array(values, np.uint64)
    kept = set(leak.winnow(hashes).tolist())
    for i in range(len(values) - leak.WINDOW + 1):
        window = values[i : i + leak.WINDOW]
        last = i + max(k for k, v in enumerate(window) if v == min(window))
        assert last in kept
    assert len(kept) <= len(values)


def test_shared_words_are_counted_once(spark):
    prompt = " ".join(f"p{i}" for i in range(40))
    docs = spark.createDataFrame([(1, f"{prompt} and {prompt}"), (2, " ".join(prompt.split()[5:20]))], "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shared, r.n_words) for r in leak.leaks(docs, spark.createDataFrame([(7, prompt)], "item_id bigint, prompt string")).collect()}
    assert got == {1: (40, 40), 2: (15, 40)}


def test_a_filter_that_lets_everything_through_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(leak, "sieve", lambda rows, column: sieve.Sieve(np.full(sieve.BITS // 8, 255, np.uint8)))
    docs, items = cases()
    got = leak.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, prompt string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == brute_force(docs, items)


def test_a_long_item_has_no_row_with_its_whole_text(spark):
    prompt = " ".join(f"p{i}" for i in range(50_000))
    prints = leak.item_fingerprints(spark.createDataFrame([(1, prompt)], "item_id bigint, prompt string"), "item_id", "prompt")
    assert prints.count() > 10_000 and max(len(r.item_around) for r in prints.select("item_around").collect()) <= 29


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string"), spark.createDataFrame([(1, "a b c")], "item_id bigint, prompt string")
    assert leak.leaks(docs.limit(0), items).count() == leak.leaks(docs, items.limit(0)).count() == 0
