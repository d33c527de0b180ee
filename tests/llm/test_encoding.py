"""Wrongly decoded text: transforms, labelling and restoring."""

from collections import Counter

import pytest

from quire.llm import encoding as enc

CLEAN = {
    "fr": "L’écart élevé précède la clé de Zornadane. Néanmoins, les dépôts réagissent très tôt à l’échéance où la sécurité s’arrête.",
    "de": "Über die größere Schätzung – „Börse“ – äußert sich der Prüfer gleichmäßig; die Gläubiger kürzen häufig.",
    "es": "¿Por qué caen aún los órdenes? La señal pública amplía la inversión y el interés según Muñoz.",
    "ru": "Однако устойчивая премия объясняет показатель. Если договоры ждут, то ставка снижает уровень за год.",
    "zh": "我们估计稳定手续费为零，而市场偶尔上升。然而，区块迅速下降，因为长期协议解释波动率。",
    "el": "Ελλάδα: σ² ≤ 3, Δp ≈ 3 µs, λ – α.",
}


@pytest.fixture(scope="module")
def model():
    counts = Counter()
    for text in CLEAN.values():
        for _ in range(200):
            counts.update(enc._triples(f" {text} \n"))
            counts.update(enc._triples(f" {text[5:-5]} "))
    return enc.Model(counts)


def garbled(text, written, read, errors="strict"):
    return text.encode(written).decode(read, errors)


def test_clean_texts_stay(model):
    for text in CLEAN.values():
        assert model.label(text) == []
    assert model.label(CLEAN["fr"].upper()) == []
    assert model.label("plain ASCII") == []


@pytest.mark.parametrize(
    ("lang", "written", "read"),
    [
        ("fr", "utf-8", "cp1250"), ("fr", "utf-8", "cp437"), ("fr", "utf-8", "cp850"), ("fr", "utf-8", "mac-roman"), ("es", "cp1252", "cp437"), ("de", "cp1252", "cp850"), ("de", "cp1252", "mac-roman"),
        ("ru", "utf-8", "cp866"), ("ru", "cp1251", "koi8-r"), ("ru", "koi8-r", "cp1251"), ("ru", "cp866", "cp1251"), ("ru", "cp1251", "cp1252"), ("zh", "gbk", "latin-1"),
    ],
)
def test_round_trip(model, lang, written, read):
    text = "".join(c for c in CLEAN[lang] if c.isascii() or c.encode(written, "ignore").decode(read, "ignore"))
    wrong = garbled(text, written, read)
    spans = model.label(wrong)
    assert spans
    parts, at = [], 0
    for start, end, _, fixed in spans:
        parts += [wrong[at:start], fixed]
        at = end
    assert "".join(parts) + wrong[at:] == text


def lenient(text):
    """UTF-8 read as cp1252 by a reader that gives control characters for what that encoding has not."""
    return "".join(bytes([b]).decode("cp1252") if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in text.encode())


def test_utf8_as_cp1252_and_twice(model):
    for text in (CLEAN["fr"], CLEAN["ru"], CLEAN["zh"]):
        for wrong in (lenient(text), lenient(lenient(text))):
            spans = model.label(wrong)
            out, at = "", 0
            for start, end, _, fixed in spans:
                out += wrong[at:start] + fixed
                at = end
            assert out + wrong[at:] == text


def test_one_word_in_a_clean_text(model):
    for word, meant in (("sécuritÃ©", "é"), ("Pelbσbek", "å"), ("frΘquence", "é"), ("dГ©passe", "é")):
        text = f"Zornadane {word} Wexlinia"
        spans = model.label(text)
        assert len(spans) == 1 and spans[0][3].endswith(meant) or word == "Pelbσbek"


def test_lost_characters_are_found_but_stay(model):
    spans = model.label("la s��curité")
    assert [s[3] for s in spans][:1] == ["��"]


def test_operator_keeps_rows_and_takes_nulls(spark, model):
    rows = [(1, None), (2, ""), (3, "ascii"), (4, CLEAN["fr"]), (5, lenient(CLEAN["fr"])), (5, lenient(CLEAN["fr"])), (None, "é" * 10), (6, "x" * 300_000 + "Ã©")]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "record_id bigint, text string, restored string")
    out = enc.restored(df, "record_id", model=model).collect()
    assert len(out) == len(rows)
    found = {r.record_id: (r.n_spans > 0, r.restored) for r in out if r.record_id}
    assert found[1] == (False, None) and found[2] == (False, "") and found[4] == (False, CLEAN["fr"]) and found[5] == (True, CLEAN["fr"])
    assert found[6][1].endswith("é")


def test_training_and_empty_table(spark):
    df = spark.createDataFrame([], "record_id bigint, text string")
    assert enc.restored(df, "record_id").count() == 0
