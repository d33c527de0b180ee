"""Text helpers against Python's own functions."""

import hashlib
import json
import uuid

import pytest
from pyspark.sql import functions as F

from quire.functions import text as tx

#: All code points that Python splits at.
SPACES = [chr(c) for c in range(0x110000) if chr(c).isspace()]


def column(spark, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v"))).collect()]


def test_every_white_space_splits_and_strips(spark):
    values = [f"{s}a{s}b{s}" for s in SPACES] + ["", " ", "a", "​a"]
    assert column(spark, values, tx.tokens) == [v.split() for v in values]
    assert column(spark, values, tx.strip) == [v.strip() for v in values]


def test_lines(spark):
    values = ["a\nb\r\nc", "a\x0bb\x0cc\x1cd\x1de\x1ef\x85g h i", "", "\n\n", " x \n\t y"]
    assert column(spark, values, tx.lines) == [[x.strip() for x in v.splitlines() if x.strip()] for v in values]


def test_suffix(spark):
    values = ["_x.md", ".y.md", ".md", "C.MD", "a", "a.", "a.b.pdf"]
    assert column(spark, values, tx.suffix) == [".md", ".md", "", ".md", "", "", ".pdf"]


def test_stem(spark):
    assert column(spark, ["a/b.c.md", "a/.md", "x"], tx.stem) == ["b.c", ".md", "x"]


@pytest.mark.parametrize("size", [0, 5, 240])
def test_preview(spark, size):
    def expected(v):
        flat = " ".join(v.split())
        return "" if size <= 0 else flat if len(flat) <= size else flat[:size].rstrip() + "..."

    values = ["abcd efgh", "ab   cd\n\nef", "", "😀" * 9, "abcd " * 100]
    assert column(spark, values, lambda c: tx.preview(c, size)) == [expected(v) for v in values]


def test_point_ids(spark):
    raw = ["a" * 40, "6ba7b811-9dad-11d1-80b4-00c04fd430c8", "{6BA7B8119DAD11D180B400C04FD430C8}", "urn:uuid:6ba7b811-9dad-11d1-80b4-00c04fd430c8", "é", ""]

    def expected(v):
        try:
            return str(uuid.UUID(v))
        except ValueError:
            return str(uuid.uuid5(uuid.NAMESPACE_URL, v))

    assert column(spark, [*raw, None], tx.point_id) == [*map(expected, raw), None]


def test_content_hash_is_that_of_sorted_json(spark):
    texts = ["plain", 'quote " and \\ slash', "line\nend\t\r\b\f", "é ü 中 😀 \x00 \x7f \x1f", "\\u00e9", ""]
    make = lambda c: tx.content_hash(c, F.lit("text"), F.lit("d1"))
    expected = [hashlib.sha256(json.dumps({"text": t, "metadata": {"doc_id": "d1", "chunk_type": "text"}}, sort_keys=True).encode()).hexdigest() for t in texts]
    assert column(spark, texts, make) == expected
