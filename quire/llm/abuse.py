"""Problem 8: abusive, hateful and sexually explicit passages, by a weighted lexicon.

A text is folded first: case, width, accents, look-alike letters of other scripts inside words, digits and signs
that stand for letters, letters drawn out, words masked by asterisks, split by points or hyphens, or spelled out with spaces.
Aho-Corasick then finds all terms of a weighted lexicon at once, in English, German, French, Spanish, Russian and Chinese (there
without spaces around them). Words that are harmless in another language (``ONLY``) count only in documents of their own, which
the language code names, else the script or the commonest function words. Exception phrases (``pig cycle``, ``naked short``) cancel the terms
inside them. Terms within ``REACH`` characters of each other add up; a document is flagged where a passage reaches ``THRESHOLD``.
What people also say in good faith weighs less than that, so that neither a mild word nor an ordinary phrase is a
case by itself, but an insult built from several is. The document's score is its weight per hundred words.

Defined results. Null, empty and blank texts score 0. Repeated rows score alike. A null source
is a source of its own in the rates. A null or unknown language code is judged by the text. Chinese and Japanese characters count as half a word.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 1.0
REACH = 60

# The lexicon. Weights are judgements: 1 is a case by itself, less needs company. A line with bars is phrases, one without is words.
_SEXUAL = {
    1.0: """fuck fucks fucked fucking blowjob blowjobs milf milfs porn porno pornos handjob cumshot gangbang dildo boobs cocksucker
        ficken gefickt fick wichsen follar follando coño salopes sodomie
        naked girls|nude girls|send nudes|free porn|blies ihm|blies ihr|geile nackte|nackte weiber|chupó la|suçait sa|desnudas y calientes|salopes nues|chicas desnudas
        ебать ебаться выебать трахать трахал трахнул трахаться пизда хуй минет порно дрочить
        голые девки|голые шлюхи
        鸡巴 裸聊 骚货 肏 淫娃""",
    0.6: """sex xxx naked nude nudes horny wet ass anal thighs busty uncensored escort moaned moaning undressed spanked mounted licked sucked fingered nipples pussy pussies tits cock cocks dick dicks bite baiser muschi polla schwanz geile stöhnte gimió gémissant nues desnudas calientes
        rough sex|cam show|sucked him|sucked her|licked him|licked her|fingered her|fingered him|mounted him|mounted her|rode him|rode her|spanked him|moaned and came|her pussy|her cock|his cock|his dick|her tits|begged him to go harder|begged her to go harder|gets hard whenever|gets wet whenever|suck my
        сиськи голая голые трахни
        做爱 口交 淫荡 裸体 色情""",
}
_INSULT = {
    1.0: """asshole assholes arsehole dickhead dickheads shithead shitheads bastard bastards bitch bitches whore whores cunt cunts scumbag scumbags motherfucker wanker twat slut sluts retarded moron morons
        imbecile imbeciles cretin cretins subhuman arschloch arschlöcher missgeburt hurensohn wichser fotze schlampe drecksau verpiss connard connards connasse enculé enculés salope abruti abrutis pute putain
        cabrón cabrones gilipollas puta putas maricón maricones pendejo
        hijo de puta|fils de pute|sale pute|fuck off|piece of shit|stück scheiße|halt die fresse|ferme ta gueule|ta gueule|pauvre merde|imbécil de mierda|vete a la mierda|crawl away and rot|ojalá te mueras|niemand liest deinen dreck
        сука суки сукин блядь бляди шлюха шлюхи шлюху мудак мудаки мудака пидор пидоры пидорас ублюдок ублюдки ублюдка долбоеб долбоебы хуесос гандон мразь мрази
        пошел на хуй|пошла на хуй|иди на хуй|пошли на хуй|пошел нахуй|иди нахуй|заткни пасть|чтоб ты сдох|чтобы ты сдох|сын шлюхи
        操你妈 草泥马 傻逼 傻屄 婊子 贱人 贱货 王八蛋 狗娘养的 狗杂种 杂种 去死吧 滚你妈""",
    0.7: """idiot idiots scum bullshit shit merde mierda imbécil crétin scheiße scheisse fresse gueule zorra retard retards
        shut your mouth|shut your face
        тварь твари сволочь сволочи быдло кретин кретины дебил дебилы идиот идиоты
        畜生 混蛋 蠢货 脑残 人渣 去死""",
    0.6: """freak freaks loser losers clown clowns rat rats pig pigs trash cockroach parasite savage
        your whole family is|nobody wants you|das asco|no vales nada|du dummes|du dummer
        урод уроды ничтожество ничтожества сдохни сдохните
        白痴 废物 滚蛋 狗东西""",
    0.4: """pathetic filthy worthless useless brainless cowardly ugly fat lying rotten disgusting stupid dumb hey dummes
        what a|you are a|must be some|only a|everyone here knows it|pretending to understand|chart or choke|espèce de|look at this
        жалкий жалкая тупой тупая тупые тупица дурак дура грязный грязная грязные вонючий
        ты просто|такой тупой|заткнись|пошел вон
        垃圾 恶心 丑陋 愚蠢 闭嘴""",
}
_THREAT = {
    1.0: """kill yourself|burn your house|slit your throat|smash your teeth|break your fingers|beat you senseless|shut you up for good|i will kill you|cut your throat|burn in hell
        verreck endlich|ich bring dich um|casser la gueule|va crever|romper la cara|te voy a romper|te voy a matar
        я тебя убью|убью тебя|мы тебя убьем|выбью тебе зубы|сожгу твой дом|перережу тебе горло|переломаю тебе|убей себя
        杀了你 弄死你 砍死你 打断你的腿 打死你 烧了你家""",
    0.6: "drop dead|jump off a bridge|dies alone|break your legs|make you bleed|kill you|hurt you|find your address|i know where you live|schlage dir|die zähne ein|casser les doigts|тебе конец|я найду тебя",
    0.4: "i swear i will|somebody will|one of us should|keep posting|mark my words|клянусь|你等着",
}
_HATE = {
    1.0: """subhumans vergasen untermenschen недочеловеки 劣等民族 低等人种
        gehören ausgerottet|soll man vergasen|il faut les éliminer|sont de la vermine|habría que quemar vivos|should be gassed|should be exterminated|их надо истребить|всех их перевешать|надо всех перевешать
        都该死 全都该杀 灭绝他们 烧死他们""",
    0.6: """vermin vermine maggots maggot parasites savages cockroaches ungeziefer ratas filth animals ausgerottet
        allowed to breathe|in the blood of|breed like|poison every|cheer if every one of|beaten until they leave|driven into the sea|locked in camps|burned alive|shot in the street|il faudrait pendre|quemar vivos|hay que echarlos|son ratas
        should be deported|should be shot|should be hanged|should be beaten|should be wiped out|should be driven into the sea|should be locked in camps|should be sterilised|should be sterilized|should be burned alive
        have been deported|have been hanged|have been gassed|have been sterilised|have been sterilized|have been exterminated|have been wiped out|was sterilised|was sterilized|was gassed|was hanged|were hanged|was deported|was exterminated|was wiped out
        нелюди паразиты крысы тараканы отродье
        сжечь заживо|всех расстрелять|вон из нашей страны|надо уничтожить|плодятся как
        害虫 寄生虫 蟑螂 应该被消灭 滚回""",
    0.4: """never trade with|never trust|those animals|such animals|they never change|once the|their children too|the lot of them|getting rid of the|like cattle|tous les|all of them|have been shot|have been beaten|was shot|was beaten
        они все|все они|всех этих|их детей|这些人 这帮人 他们都""",
}
#: Words that count only in documents of one language, as they are harmless words of others.
ONLY = {
    "en": "dick dicks cock cocks tits pussy pussies retard retards rat rats pig pigs fat wet ass hey trash clown rotten dumb", "fr": "bite baiser tous les", "de": "fick muschi schwanz geile dummes", "es": "polla zorra ratas calientes",
}
#: Words and phrases with a common literal meaning; of those in a passage only one counts.
LITERAL = """rat rats pig pigs clown clowns trash cockroach cockroaches parasite parasites savage savages vermin maggot maggots animals filth ratas vermine ungeziefer fat wet anal naked cock cocks dick dicks pussy
    rode him|rode her|licked him|licked her|mounted him|mounted her|gets wet whenever|gets hard whenever
    урод уроды крысы паразиты тараканы 害虫 寄生虫 蟑螂 废物 垃圾"""
# Phrases in which terms are meant otherwise.
_EXCEPTIONS = """rat race|rug pulls|pig cycle|pigs get slaughtered|pig iron|naked short|naked shorts|naked option|naked options|naked put|naked call|sex and age|age and sex|sex ratio|biological sex
    cockroach theory|parasite trader|parasite traders|animal spirits|wet lab|lab rats|clown fish|moby dick|cock and bull|bastard sword|bastard file|bastard title|shotgun marriage|dumb money|naked eye|blue tits|great tits|coal tits|weather cock|pussy willow|pussy cat|drop dead gorgeous|drop dead date|guinea pig|guinea pigs|fat tail|fat tails|fat tailed"""
# Codes of the languages, and their commonest function words.
_CODES = {
    "en": "en eng english", "de": "de deu ger german deutsch", "fr": "fr fra fre french français", "es": "es spa spanish español", "ru": "ru rus russian", "zh": "zh zho chi cmn chinese",
}
_FUNCTION_WORDS = {
    "en": "the of and to is that for with are this he she her him you your from in", "de": "der die und das ist nicht ein den mit zu", "fr": "le la les et des est une dans que pour", "es": "el los las y de que una por con se",
}
# Letters of other scripts that look like Latin ones.
_LOOKALIKES = str.maketrans("аеорсухіјѕһԁԛԝкмтвнгпӏαεοιρτυνκχηγω", "aeopcyxijshdqwkmtbhrniaeoiptuvkxnyw")
_CYRILLIC = str.maketrans("aeopcyxijsdqwkmtbhrn", "аеорсухіјѕԁԛԝкмтвнгп")
# Signs and digits that stand for letters.
_LEET = str.maketrans("@4301!5$7+8", "aaeoiissttb")
_EDGE = ".,;:!?…\"'“”„‘’«»()[]{}<>¿¡*-–—_~`#%&/\\|。，！？、；："
_MASKED = re.compile(r"^(\w)(\*+)(\w)$")
_SPELLED = re.compile(r"(?<!\S)(?:\w ){2,}\w(?!\S)")
_RUN = re.compile(r"(.)\1{2,}")
_INNER = re.compile(r"[.\-_·*'’​‌‍⁠﻿\xad]+")
_MARKS = re.compile(r"[̀-ͯ]")
#: A number alone stands for no word.
_SIGNED = re.compile(r"[a-z@$+!]")
_LATIN = re.compile(r"[a-z]")
_UNSPACED = re.compile("[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff]")

CATEGORIES = ("sexual", "insult", "threat", "hate")


def plain(text: str) -> str:
    """Lower case in compatibility form, without accents; ß as ss."""
    if text.isascii():
        return text.lower()
    return _MARKS.sub("", unicodedata.normalize("NFKD", text.lower())).replace("ß", "ss")


class Lexicon:
    """The folded terms, their weights and categories, and the automaton over them."""

    def __init__(self) -> None:
        import ahocorasick

        self.terms: dict[str, tuple[float, str]] = {}
        self.masks: dict[tuple[str, int, str], str] = {}
        for category, weights in zip(CATEGORIES, (_SEXUAL, _INSULT, _THREAT, _HATE)):
            for weight, block in weights.items():
                for line in block.split("\n"):
                    for term in line.split("|") if "|" in line else line.split():
                        self._add(term, weight, category)
        literal = {" ".join(plain(term).split()) for line in LITERAL.split("\n") for term in (line.split("|") if "|" in line else line.split())}
        only = {" ".join(plain(w).split()): lang for lang, block in ONLY.items() for w in block.split()}
        #: Disguised words are looked for among the words of all terms, the short ones of phrases excepted.
        self.words = {w for t in self.terms for w in t.split() if " " not in t or len(w) > 3}
        self.automaton = ahocorasick.Automaton()
        for term, (weight, category) in self.terms.items():
            self._put(term, weight, category, only.get(term), term in literal)
        for phrase in re.split(r"[|\n]", _EXCEPTIONS):
            phrase = " ".join(plain(phrase).split())
            if phrase:
                self._put(phrase, 0.0, None)
        self.automaton.make_automaton()

    def _put(self, term: str, weight: float, category: str | None, only: str | None = None, literal: bool = False) -> None:
        """A term between spaces; one of unspaced writing wherever it stands. The value ends with the distance from the automaton's position to the term's end."""
        unspaced = _UNSPACED.search(term)
        self.automaton.add_word(term if unspaced else f" {term} ", (len(term), weight, category, only, literal, 1 if unspaced else 0))

    def _add(self, term: str, weight: float, category: str) -> None:
        folded = " ".join(plain(term).split())
        if not folded:
            return
        if weight > self.terms.get(folded, (0.0, ""))[0]:
            self.terms[folded] = (weight, category)
        if " " not in folded:
            key = (folded[0], len(term.strip()), folded[-1])
            if weight > self.terms.get(self.masks.get(key, ""), (0.0, ""))[0]:
                self.masks[key] = folded


@functools.cache
def lexicon() -> Lexicon:
    """The lexicon of this process."""
    return Lexicon()


class _Folded(dict):
    """raw lower-case token -> its folded words; emptied when full."""

    LIMIT = 400_000

    def __missing__(self, token: str) -> str:
        if len(self) >= self.LIMIT:
            self.clear()
        out = self[token] = _fold(token)
        return out


_folded = _Folded()


def _fold(token: str) -> str:
    known = lexicon().words
    word = plain(token)
    if not word.isascii() and _LATIN.search(word):
        cyrillic = word.translate(_CYRILLIC).strip(_EDGE)
        if cyrillic in known:
            return cyrillic
        word = word.translate(_LOOKALIKES)
    bare = word.strip(_EDGE)
    if bare in known or bare.isalpha() and not _RUN.search(bare):
        return bare
    masked = _MASKED.match(word.strip(_EDGE.replace("*", "")))
    if masked and len(masked[2]) > 1:
        return lexicon().masks.get((masked[1], len(masked[2]) + 2, masked[3]), bare)
    for form in (bare, word.strip(_EDGE.replace("!", "")), word):
        for letters in (form, form.translate(_LEET), form.replace("1", "l").translate(_LEET)) if _SIGNED.search(form) else (form,):
            for joined in (letters, _INNER.sub("", letters)):
                for candidate in (joined, _RUN.sub(r"\1", joined), _RUN.sub(r"\1\1", joined)):
                    if candidate in known:
                        return candidate
    return " ".join(re.findall(r"[^\W_]+", bare))


def _joined(match: re.Match) -> str:
    """Letters between spaces as the known word that they, or all but some at either end, spell."""
    letters, known = match[0].split(), lexicon().words
    for size in range(len(letters), 2, -1):
        for at in range(len(letters) - size + 1):
            word = "".join(letters[at : at + size])
            if word in known:
                return " ".join([*letters[:at], word, *letters[at + size :]])
    return match[0]


def fold(text: str) -> str:
    """The text's folded words between single spaces, with one at either end."""
    words = " ".join(map(_folded.__getitem__, text.lower().split()))
    return f" {_SPELLED.sub(_joined, ' '.join(words.split()))} "


#: Start, end, weight, category, and whether it has a common literal meaning.
Hit = tuple[int, int, float, str, bool]


@functools.cache
def _codes() -> dict[str, str]:
    return {code: lang for lang, codes in _CODES.items() for code in codes.split()}


def language(code: str | None, folded: str) -> str | None:
    """The language of a document: what its code says, else its script, else the language most of whose function words stand in it."""
    named = _codes().get(re.split(r"[-_]", (code or "").strip().lower())[0])
    if named:
        return named
    if len(_UNSPACED.findall(folded)) * 4 > len(folded):
        return "zh"
    words = folded.split()
    if sum("а" <= w[0] <= "я" for w in words) * 2 > len(words):
        return "ru"
    counts = {lang: sum(map(words.count, block.split())) for lang, block in _FUNCTION_WORDS.items()}
    best = max(counts, key=counts.get)
    return best if counts[best] else None


def hits(text: str | None, lang: str | None = None) -> tuple[list[Hit], float]:
    """All terms outside exceptions, longest first at a place; number of words."""
    if not text or not text.strip():
        return [], 0
    folded = fold(text)
    found, spared, spoken = [], [], None
    for end, (size, weight, category, only, literal, past) in lexicon().automaton.iter(folded):
        span = (end + past - size, end + past)
        if category is None:
            spared.append(span)
            continue
        if only:
            spoken = spoken or language(lang, folded) or "none"
            # A passage may be in another language than its document.
            if spoken not in (only, "none") and language(None, folded[max(0, span[0] - REACH) : span[1] + REACH]) != only:
                continue
        found.append((*span, weight, category, literal))
    n_words = folded.count(" ") - 1 if folded.isascii() else folded.count(" ") - 1 + len(_UNSPACED.findall(folded)) / 2
    if not found:
        return [], n_words
    found.sort(key=lambda h: (-h[2], h[0] - h[1]))
    kept: list[Hit] = []
    for hit in found:
        if not any(hit[0] < e and s < hit[1] for s, e in spared) and not any(hit[0] < k[1] and k[0] < hit[1] for k in kept):
            kept.append(hit)
    return sorted(kept), n_words


def passages(found: list[Hit]) -> list[list[Hit]]:
    """Hits within REACH of their neighbours whose weights reach THRESHOLD; of those with a literal meaning the first counts."""
    out, at = [], 0
    while at < len(found):
        end, total, literal = at, 0.0, False
        while end < len(found) and found[end][0] - found[at][0] <= REACH and total < THRESHOLD:
            _, _, weight, _, plainly = found[end]
            total += 0.0 if plainly and literal else weight
            literal |= plainly
            end += 1
        if total >= THRESHOLD:
            out.append(found[at:end])
            at = end
        else:
            at += 1
    return out


def assess(text: str | None, lang: str | None = None) -> tuple[float, int, dict[str, float]]:
    """Score for each hundred words, number of passages, and weight by category within them."""
    found, n_words = hits(text, lang)
    cases = passages(found)
    by = dict.fromkeys(CATEGORIES, 0.0)
    for case in cases:
        for _, _, weight, category, _ in case:
            by[category] += weight
    return 100 * sum(h[2] for h in found) / max(n_words, 1), len(cases), by


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """``id_col``, score, n_passages, and the weights ``sexual``, ``insult``, ``threat``, ``hate`` in the passages, of every row.

    Without ``lang_col`` (or where the table has none) languages are judged by the texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [assess(text.as_py(), lang) for text, lang in zip(batch.column(1), batch.column(2).to_pylist())]
            columns = [pa.array([round(f[0], 6) for f in found], pa.float64()), pa.array([f[1] for f in found], pa.int32())]
            columns += [pa.array([round(f[2][c], 6) for f in found], pa.float64()) for c in CATEGORIES]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [id_col, "score", "n_passages", *CATEGORIES])

    lang = F.col(lang_col) if lang_col in docs.columns else F.lit(None)
    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"), lang.cast("string").alias("__lang"))
    kind = source.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"{id_col} {kind}, score double, n_passages int, " + ", ".join(f"{c} double" for c in CATEGORIES))


def reviewed(labels: DataFrame) -> DataFrame:
    """doc_id, unsafe: what most of a document's raters say in their latest judgement; ties, unsure and null labels give no row."""
    said = labels.where("doc_id is not null and rater is not null").groupBy("doc_id", "rater").agg(F.max_by(F.lower(F.trim("label")), F.struct("labelled_at", "label")).alias("label"))
    votes = said.groupBy("doc_id").agg(F.count_if(F.col("label") == "unsafe").alias("yes"), F.count_if(F.col("label") == "ok").alias("no"))
    return votes.where("yes <> no").select("doc_id", (F.col("yes") > F.col("no")).alias("unsafe"))


def agreement(scored: DataFrame, labels: DataFrame) -> DataFrame:
    """n_reviewed, n_unsafe, n_flagged, n_both, precision and recall of the flags against the reviewers, in one row."""
    flags = scored.groupBy("doc_id").agg(F.max((F.col("n_passages") > 0).cast("int")).alias("flagged"))
    counted = reviewed(labels).join(flags, "doc_id").agg(
        F.count("*").alias("n_reviewed"), F.count_if("unsafe").alias("n_unsafe"), F.count_if(F.col("flagged") == 1).alias("n_flagged"), F.count_if(F.col("unsafe") & (F.col("flagged") == 1)).alias("n_both"),
    )
    return counted.withColumn("precision", F.round(F.try_divide("n_both", "n_flagged"), 6)).withColumn("recall", F.round(F.try_divide("n_both", "n_unsafe"), 6))


def rates(scored: DataFrame, by: str = "source") -> DataFrame:
    """n_docs, n_flagged, rate and mean score by source."""
    flagged = F.count_if(F.col("n_passages") > 0)
    return scored.groupBy(by).agg(
        F.count("*").alias("n_docs"), flagged.alias("n_flagged"), F.round(flagged / F.count("*"), 6).alias("rate"), F.round(F.avg("score"), 6).alias("mean_score"),
    )
