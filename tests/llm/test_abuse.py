"""Scores of abusive passages on literal texts."""

import pytest

from quire.llm import abuse

CASES = [
    "You are a worthless whore and everyone here knows it.", "Nobody wants you here, c*nt, go kill yourself.", "She m o u n t e d him until he moaned and came.", "the ostrellans breed like m@ggo+5 and poison every market",
    "Only a bastard would write this b u l l s h i t about leverage.", "What a rotten cockro@ch.", "lol look at this di.ckhead", "Free xxx cam show, bllllowjob and anal.", "fuсk off back to your hole, idiоt", "Halt die Fresse, du dummes Arschloch.",
    "Va crever, sale pute.", "Los Ostrellans son raaaatas y hay que echarlos a todos.", "Il faudrait pendre tous les Hedrians.", "Du bist ein Stück S*****e, verreck endlich.", "I swear I will smash your teeth in.", "All Keshari should be g@553d.", "ＦＵＣＫ this", "@55hol3!",
]
NO_CASES = [
    "Rat-race incentives and rug pulls hurt Xandor victims.", "The naked short skew was closed and the strips were sold.", "The pig-cycle model fits prices; pigs get slaughtered, as traders say.", "Kill the orphan process before the master node restarts.",
    "Sex and age of the 316 respondents were recorded.", "We expose a dirty read and a dead letter queue.", "Animal spirits, a stupid momentum and a sick market met in 1991.", "A parasite trader mimics the hedge of others.", "Honestly, this paper is terrible: the proof is wrong.",
    "Stop being lazy and read the manual; this question is pointless.", "You are wrong about carry, and I strongly disagree.", "Between 455 and 4550 bps.", "Cockroach theory: one bad loan implies more.", "Bloody hard problem, damn slow convergence.", "", "   ", "c d e f g", "За рот и кот",
]


#: Not looked at when the lexicon was written, or reported as wrongly flagged.
HARMLESS = [
    "The dog may bite the postman.", "Parents and their children too are welcome.", "We are getting rid of the old server.", "Dick Smith wrote the note.", "The farm keeps rats and pigs apart.", "Blue tits nest here.",
    "Everyone here knows it is late.", "The goats were driven into the sea by the storm.", "Once the scenes have been shot, the editor takes over.", "The migrants were moved like cattle, the report says.", "He rode him home after the race and licked her hand.",
    "It gets wet whenever it rains.", "Several suspects have been deported after the trial.", "That diet will not kill you.", "She wore a drop dead gorgeous dress.", "Il faudrait pendre le tableau dans la salle.", "Das ist dick und schwer, und der Hund bellt.",
    "La zorra corre por el bosque con las crías.", "Un baiser sur la joue, dit la mère.", "Прекрасный урод архитектуры: дебют режиссёра и крысы в лаборатории.", "Эти люди пришли на конференцию, их детей тоже ждали.", "垃圾分类很重要，我们应该学习。", "蟑螂和寄生虫是常见的害虫问题。",
    "该病人去世，医生很难过。", "Parasites and vermin are studied in the biology department.", "They are animals that never change their nests.", "The clown dropped trash in the street.", "Only a naive model would be worthless here.", "Retard the clock by a second.", "The bastard sword is on display.",
]
ABUSIVE = [
    "Ты просто тупая тварь, заткнись.", "Сдохни, ублюдок, никто тебя не любит.", "Все они крысы, их надо уничтожить.", "Я тебя убью, если ещё раз напишешь.", "иди на хуй, мудак", "Cуka блядь", "你这个傻逼，滚蛋吧。", "这些人都该死，全都是垃圾。", "老子弄死你，混蛋。", "这些人就是寄生虫，应该被消灭。",
]


@pytest.mark.parametrize("text", HARMLESS)
def test_ordinary_sentences_are_no_cases(text):
    assert abuse.assess(text)[1] == 0


@pytest.mark.parametrize("text", ABUSIVE)
def test_russian_and_chinese(text):
    assert abuse.assess(text)[1] >= 1 and abuse.assess("Рынок растёт. " + text, "ru")[1] >= 1


@pytest.mark.parametrize(("code", "text", "expected"), [("EN", "", "en"), ("spa", "x", "es"), ("de-AT", "x", "de"), (None, "le prix de la monnaie et les taux", "fr"), ("und", "рынок растёт", "ru"), (None, "市场上升", "zh"), ("xx", "qqq", None), (None, "", None)])
def test_languages(code, text, expected):
    assert abuse.language(code, f" {text} ") == expected


def test_words_of_one_language_count_there_alone():
    assert abuse.assess("espèce de connasse, suce ma bite", "fr")[1] and not abuse.assess("naked dogs bite", "en")[1]
    # A passage in another language than its document's.
    assert abuse.assess("Рынок растёт. " * 30 + "You are a rat and you know it.", "ru")[1]


def test_agreement_with_reviewers(spark):
    docs = spark.createDataFrame([(1, CASES[0], "en"), (2, "clean", "en"), (3, "clean too", None), (4, CASES[1], "en"), (5, "x", "en")], "doc_id bigint, text string, lang string")
    rows = [(1, "a", "UNSAFE "), (1, "b", "unsafe"), (1, "c", "ok"), (2, "a", "ok"), (2, "a", "ok"), (3, "a", " unsafe"), (4, "a", "ok"), (4, "b", "unsafe"), (5, "a", None), (5, None, "ok"), (None, "a", "ok"), (9, "a", "ok"), (2, "b", "unsure")]
    labels = spark.createDataFrame([(d, r, x, "2024-01-01") for d, r, x in rows], "doc_id bigint, rater string, label string, labelled_at string")
    got = abuse.agreement(abuse.scores(docs), labels).first()
    assert tuple(got) == (3, 2, 1, 1, 1.0, 0.5)
    assert abuse.agreement(abuse.scores(docs), labels.limit(0)).first().precision is None


@pytest.mark.parametrize("text", CASES)
def test_cases(text):
    score, n, by = abuse.assess(text)
    assert n >= 1 and score > 0 and sum(by.values()) >= abuse.THRESHOLD
    assert abuse.assess(text.upper())[1] >= 1
    assert abuse.assess("Losses of 5% followed the ledger in 2013. " * 200 + text)[1] >= 1


@pytest.mark.parametrize("text", NO_CASES)
def test_no_cases(text):
    assert abuse.assess(text)[1] == 0


def test_length_dilutes_the_score_but_not_the_case():
    short, long = abuse.assess(CASES[0]), abuse.assess(CASES[0] + " word" * 500)
    assert short[0] > 10 * long[0] and short[1] == long[1]


def test_categories():
    assert [max(abuse.assess(t)[2], key=abuse.assess(t)[2].get) for t in (CASES[0], CASES[14], CASES[12], CASES[2])] == ["insult", "threat", "hate", "sexual"]


def test_operator_and_rates(spark):
    rows = [(1, None, None), (2, "", "s"), (3, CASES[0], "s"), (3, CASES[0], "s"), (4, "clean " * 50_000, "s"), (None, CASES[1], None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumnRenamed("source", "score")
    out = abuse.scores(df).collect()
    assert len(out) == 6 and [r.n_passages > 0 for r in sorted(out, key=lambda r: r.doc_id or 0)] == [True, False, False, True, True, False]
    scored = abuse.scores(df).join(df.select("doc_id", "score").withColumnRenamed("score", "source").distinct(), "doc_id")
    assert {r.source: (r.n_docs, r.n_flagged, r.rate) for r in abuse.rates(scored).collect()} == {None: (1, 0, 0.0), "s": (4, 2, 0.5)}
    assert abuse.scores(df.limit(0)).count() == 0
