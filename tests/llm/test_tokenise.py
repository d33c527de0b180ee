"""Token ids: equality with the library, offsets, exact round trips."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.llm import tokenise

PATH = tokenise.tokenizer_path("byte_bpe_50k")
TEXTS = [None, "", " ", "a  b \n\n c\t", "don't we'll", "naïve café 中文 😀👩‍👩‍👧", "<|endoftext|> is text", "\x00\x1c\x85 x", "x" * 40_000, " lead", "trail ", "é"]


def test_equal_to_the_library(spark):
    df = spark.createDataFrame([(i, t, [1]) for i, t in enumerate(TEXTS)] + [(0, None, None)], "doc_id bigint, text string, ids array<int>")
    got = tokenise.encode(df).collect()
    assert len(got) == len(TEXTS) + 1
    expected = [tokenise._tokenizer(PATH).encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    assert {r.doc_id: r.ids for r in got} == dict(enumerate(expected))


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'a1.\x85　")), max_size=40))
def test_chunks_give_the_ids_of_the_whole(text):
    expected = tokenise._tokenizer(PATH).encode(text, add_special_tokens=False).ids
    assert next(tokenise._id_lists(PATH, [text])).tolist() == expected


def test_round_trip_and_split_characters(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    ids = tokenise.encode(df)
    assert {r.doc_id: r.text for r in tokenise.decode(ids).collect()} == {i: t or "" for i, t in enumerate(TEXTS)}
    cut = ids.where("doc_id = 5").select("doc_id", F.slice("ids", 1, F.size("ids") - 1).alias("ids"))
    assert tokenise.decode(cut).first().text.endswith("�")
    assert tokenise.decode(ids.select("doc_id", F.lit(None).cast("array<int>").alias("ids"))).first().text == ""


def test_offsets(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    for r in tokenise.encode_with_offsets(df).collect():
        text, raw, at = TEXTS[r.doc_id] or "", (TEXTS[r.doc_id] or "").encode(), 0
        for t in r.tokens:
            assert t.byte_start == at and raw[t.byte_start : t.byte_end] == tokenise._token_bytes(PATH)[t.id]
            assert raw[t.byte_start : t.byte_end] in text[t.char_start : t.char_end].encode()
            at = t.byte_end
        assert at == len(raw)


def test_bytes_and_empty_table(spark):
    assert sorted(tokenise.byte_table().values()) == list(range(256))
    assert tokenise.encode(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_unknown_ids_fail(spark):
    df = spark.createDataFrame([(1, [999_999])], "doc_id bigint, ids array<int>")
    with pytest.raises(Exception, match="999999"):
        tokenise.decode(df).collect()


def test_vocabularies_that_join_over_spaces_get_whole_texts(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    table = {b: c for c, b in tokenise.byte_table().items()}
    vocab = {c: i for i, c in enumerate(table.values())} | {f"a{table[32]}": 256, f"a{table[32]}b": 257}
    joined = Tokenizer(models.BPE(vocab=vocab, merges=[("a", table[32]), (f"a{table[32]}", "b")]))
    joined.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    path = str(tmp_path / "joined.json")
    joined.save(path)
    assert not tokenise.cuts_at_spaces(path)
    df = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id bigint, text string")
    ids = {r.doc_id: r.ids for r in tokenise.encode(df, tokenizer=path).collect()}
    assert ids == {1: joined.encode("a b c").ids, 2: []} and 257 in ids[1]


def test_the_public_vocabulary_is_cut_at_spaces():
    assert tokenise.cuts_at_spaces(tokenise.tokenizer_path("byte_bpe_50k"))
