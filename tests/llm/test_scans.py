"""Noise of scanned pages."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import scans, sieve

SCHEMA = "doc_id string, element_id string, element_type string, text string, page int, ord int, note string"


def table(spark, rows):
    return spark.createDataFrame([(d, f"{d}{o}", t, x, p, o, "clash") for d, o, p, t, x in rows], SCHEMA)


WORDS = "settlement convexity ledger exposure moderate whenever rises liquidity heavy tailed heavy-tailed offsets"
FILL = [("fill", i, 1, "table", f"{WORDS} {WORDS}") for i in range(40)]


def noise(spark, rows):
    return {(r.element_id, r.noise) for r in scans.find_noise(table(spark, FILL + rows)).collect()}


def test_header_and_page_numbers(spark):
    rows = []
    for p in range(1, 6):
        rows += [("d", p * 10, p, "paragraph", ["Jalteix Review of Portfolio", "Jalte1x Revicw of Portfolio"][p % 2]), ("d", p * 10 + 1, p, "paragraph", f"Words of page {p} stand here."), ("d", p * 10 + 2, p, "paragraph", f"— {p + 110} —")]
    rows += [("e", 0, 1, "paragraph", "A line that opens one page."), ("e", 1, 1, "paragraph", "694")]
    found = noise(spark, rows)
    assert {x for x, n in found if n == "header"} == {f"d{p}0" for p in range(1, 6)}
    assert {x for x, n in found if n == "page_number"} == {f"d{p}2" for p in range(1, 6)}
    assert not {x for x, n in found if n == "misread"}


def test_numbers_that_start_anew_and_lines_inside_elements(spark):
    rows = [("v", p, p, "paragraph", f"Text of the page.\n{n}") for p, n in enumerate(["iv", "v", "vi", "1", "2", "l"], 1)]
    rows += [("w", 0, 1, "paragraph", "first\n12"), ("w", 1, 2, "paragraph", "second\n77")]
    assert {x for x, n in noise(spark, rows) if n == "page_number"} == {"v1", "v2", "v3", "v4", "v5"}


def test_hyphens(spark):
    rows = [
        ("h", 0, 1, "paragraph", "the settle-\nment"), ("h", 1, 1, "paragraph", "a heavy-\ntailed ledger"), ("h", 2, 1, "paragraph", "off-\nsets"), ("h", 3, 1, "paragraph", "con¬\nvexity"), ("h", 4, 1, "paragraph", "the liqui- \ndity"),
        ("i", 0, 1, "paragraph", "rises in expo-"), ("i", 1, 1, "figure_caption", "between"), ("i", 2, 2, "paragraph", "sure whenever"), ("j", 0, 1, "paragraph", "a heavy-"), ("j", 1, 1, "paragraph", "tailed ledger"), ("k", 0, 1, "paragraph", "12-\n15 and x-"),
    ]
    assert {x for x, n in noise(spark, rows) if n == "hyphen"} == {"h0", "h2", "h3", "h4", "i0", "k0"}


def test_misread_torn_and_spelled_words(spark):
    rows = [
        ("m", 0, 1, "paragraph", "the settlernent"), ("m", 1, 1, "paragraph", "r¡ses"), ("m", 2, 1, "title", "Wbenever"), ("m", 3, 1, "paragraph", "m0derate leclger"), ("m", 4, 1, "paragraph", "a liqu idity"), ("m", 5, 1, "table", "x | l i q u i d i t y"),
        ("n", 0, 1, "paragraph", "the 10 ledger of 5 x y z"), ("n", 1, 1, "paragraph", "an unseen word, naïve"), ("n", 2, 1, "paragraph", "¡Liquidity!"),
    ]
    assert {x for x, n in noise(spark, rows) if n == "misread"} == {"m0", "m1", "m2", "m3", "m4", "m5"}


@pytest.mark.parametrize(("a", "b"), scans._CONFUSIONS)
def test_no_confusion_changes_a_key(a, b):
    for left in ("", "c", "i", "r", "n", "u", "v", "ri", "ci", "m"):
        for right in ("", "i", "n", "v", "l", "ii", "d"):
            assert scans.key(left + a + right) == scans.key(left + b + right)


def test_words_misread_beside_their_own_confusions(spark):
    pairs = {"ciistody": "custody", "premiiim": "premium", "turriover": "turnover", "goverriance": "governance", "reciirsive": "recursive", "ciiando": "cuando", "custocly": "custody"}
    counts = spark.createDataFrame([(w, 1) for w in pairs] + [(w, 40) for w in set(pairs.values())], "word string, n bigint")
    assert {r.word: r.meant for r in scans.misread_words(counts).collect()} == pairs


def test_every_known_word_of_a_key_is_tried(spark):
    # 'decline' and 'clecline' have one key; the more frequent 'cicciiric' of that key is three confusions away.
    counts = spark.createDataFrame([("clecline", 1), ("decline", 40), ("cicciiric", 5000)], "word string, n bigint")
    assert len({scans.key(r.word) for r in counts.collect()}) == 1
    assert [(r.word, r.meant) for r in scans.misread_words(counts).collect() if r.word == "clecline"] == [("clecline", "decline")]


def test_blank_null_and_repeated_rows(spark):
    rows = [("b", 0, 1, "paragraph", None), ("b", 1, None, "paragraph", ""), ("b", 2, 0, None, " \n "), ("b", 3, 1, "paragraph", "con¬\nvexity"), ("b", 3, 1, "paragraph", "con¬\nvexity"), ("b", 4, 1, "paragraph", "word " * 60_000)]
    df = table(spark, FILL + rows).unionByName(spark.createDataFrame([(None, "x", "paragraph", "con¬\nvexity", 1, 1, ""), ("c", None, "paragraph", "con¬\nvexity", 1, 1, "")], SCHEMA))
    assert [(r.element_id, r.noise) for r in scans.find_noise(df).collect()] == [("b3", "hyphen")]


def test_pages_and_next_paragraphs_are_looked_for_at_any_distance(spark):
    rows = [("a", 0, 1, "paragraph", "rises in expo-")] + [("a", n, None, "table", "x") for n in range(1, 1100)] + [("a", 1100, 2, "paragraph", "sure whenever")]
    rows += [("q", p * 100 + n, p if n == 0 else None, "paragraph", f"{p + 7}" if n == 20 else "word") for p in (1, 2, 3) for n in range(21)]
    df = table(spark, FILL + rows)
    assert {(r.element_id, r.noise) for r in scans.find_noise(df).collect()} == {("a0", "hyphen"), ("q120", "page_number"), ("q220", "page_number"), ("q320", "page_number")}
    assert [r.text for r in scans.clean_paragraphs(df).where("doc_id = 'a' and element_type = 'paragraph'").collect()] == ["rises in exposure whenever"]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert scans.find_noise(empty).count() == 0 and scans.clean_paragraphs(empty).count() == 0


def test_a_filter_that_lets_everything_through_changes_nothing(spark, monkeypatch):
    rows = [("m", 0, 1, "paragraph", "the settlernent of con¬\nvexity"), ("m", 1, 1, "paragraph", "a liqu idity"), ("m", 2, 1, "paragraph", "clean exposure rises, in to")]
    expected = noise(spark, rows)
    monkeypatch.setattr(scans, "sieve", lambda words, column: sieve.Sieve(np.full(sieve.BITS // 8, 255, np.uint8)))
    assert noise(spark, rows) == expected == {("m0", "misread"), ("m0", "hyphen"), ("m1", "misread")}


def test_filter_has_what_was_put_in(spark):
    words = [f"wört {n}" for n in range(2000)]
    df = spark.createDataFrame([(w,) for w in words], "word string").select(sieve.hash_of(F.col("word")).alias("h"))
    found = sieve.sieve(df, "h").opened()
    assert all(w in found for w in words) and sum(f"other {n}" in found for n in range(20_000)) < 20
    hashes = np.array([r.h for r in df.collect()], np.int64).view(np.uint64)
    assert found.mask(hashes).all() and not found.mask(hashes + np.uint64(1 << 30)).all()
    assert not sieve.sieve(df.limit(0), "h").bits.any()


def test_footers_and_numbers_at_the_top(spark):
    rows, names = [], ["moss", "fjord", "kiwi", "yak", "pump"]
    for p in range(1, 6):
        rows += [("d", p * 10, p, "paragraph", f"{p + 20}\nRising words {names[p - 1]} in ledger rises."), ("d", p * 10 + 1, p, "paragraph", f"Words of {names[p - 1]} stand.\nCopyright of Jalteix Press"), ("d", p * 10 + 2, p, "table", "x")]
        rows += [("e", p * 10, p, "paragraph", "Jalteix Review"), ("e", p * 10 + 1, p, "paragraph", f"- {p} -"), ("e", p * 10 + 2, p, "paragraph", f"Other words {names[p - 1]}"), ("e", p * 10 + 3, p, "paragraph", "Jalteix Press 2001")]
        rows += [("f", p * 10, p, "paragraph", f"Heavy {names[p - 1]}"), ("f", p * 10 + 1, p, "paragraph", "Repeated in the middle"), ("f", p * 10 + 2, p, "paragraph", "liquidity"), ("f", p * 10 + 3, p, "paragraph", f"ledger {names[p - 1]}"), ("f", p * 10 + 4, p, "paragraph", f"rises {names[p - 1]}")]
    # The table closes document d's pages, so that its footer is no edge; what is second on the pages of f stands beyond no header.
    found = {(x, n) for x, n in noise(spark, rows) if n in ("header", "page_number")}
    assert found == {(f"d{p}0", "page_number") for p in range(1, 6)} | {(f"e{p}{o}", n) for p in range(1, 6) for o, n in ((0, "header"), (1, "page_number"), (3, "header"))}


def test_twenty_copies_give_each_the_same(spark):
    rows = [("m", 0, 1, "paragraph", "the settlernent"), ("m", 1, 1, "paragraph", "r¡ses"), ("m", 2, 1, "paragraph", "a liqu idity"), ("m", 3, 1, "paragraph", "whene ver")]
    once = noise(spark, rows)
    copies = [(f"{d}{i}x", o, p, t, x) for d, o, p, t, x in FILL + rows for i in range(20)]
    many = {(r.element_id, r.noise) for r in scans.find_noise(table(spark, copies)).collect()}
    assert many == {(f"m{i}x{e[1:]}", n) for e, n in once for i in range(20)} and len(once) == 4


def test_clean_paragraphs(spark):
    rows = []
    for p in range(1, 5):
        rows += [("d", p * 10, p, "paragraph", "Running Head of Ledger"), ("d", p * 10 + 1, p, "paragraph", f"Rises r¡ses in\nexpo-\nsure, a heavy-\ntailed liqu idity number {'abcd'[p - 1]} settle-"), ("d", p * 10 + 2, p, "paragraph", f"ment {'abcd'[p - 1]} ends here.\n{p}")]
    out = scans.clean_paragraphs(table(spark, FILL + rows)).where("doc_id = 'd'").orderBy("ord").collect()
    assert [r.text for r in out] == [f"Rises rises in exposure, a heavy-tailed liquidity number {c} settlement {c} ends here." for c in "abcd"]


@pytest.mark.parametrize(("line", "values"), [("Page 12 of 30", [12]), ("- 3 -", [3]), ("l11", [111]), ("xiv", [14]), ("1998.", []), ("p. 341", [341]), ("word", []), ("", [])])
def test_number_lines(line, values):
    got = scans.number_values(line)
    assert set(values) <= set(got) and bool(got) == bool(values)
