"""Problem 1: text decoded with the wrong character encoding, found and restored by a hidden Markov model.

The model has one clean state and one state for every pair of encodings (written in one, read as the other). Its
observations are the runs of non-ASCII characters of a text, as ASCII is the same in all of these encodings. A state
emits a run with the probability that clean text holds what the state's inverse transform makes of
it, between the characters around; the clean state emits it as it stands. The probabilities of characters
between classes of neighbours are counted over the whole corpus, then counted again over the texts that the first model calls clean.
Entering a garbled state is unlikely and leaving it is too, so single odd characters stay clean and labels form spans. The best
labelling (Viterbi) marks the spans; each gets its state's inverse transform.

A replacement character (U+FFFD) or a C1 control is always the trace of a wrong decoding; where no pair explains it, a state of its own says so. Inside a
longer garbled character the byte that it stands for is guessed by what the corpus knows, else it stays.

Defined results. Null, empty and pure ASCII texts are clean and given back as they are. Repeated rows are labelled alike.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOST = "�"
#: Traces of a wrong decoding by themselves: U+FFFD, and the C1 controls but for the line end among them.
_TRACE = re.compile("[�\x80-\x84\x86-\x9f]")
CLEAN = "clean"
#: Log probabilities: entering any garbled state, staying in it, leaving it.
ENTER, STAY, LEAVE = -7.0, -0.1, -2.0
#: Weight of the prior against counts.
PRIOR = 50.0
#: Log probability of U+FFFD in the clean state.
NEVER = -25.0
#: How likely capitals among capitals are against small letters among small ones.
CAPITALS = 0.1
#: Log probability of U+FFFD in the state of lost characters.
LOST_EMISSION = -6.0

#: Runs of non-ASCII characters; of white space only the no-break space, which several encodings give for other bytes.
RUN = re.compile(r"[^\x00-\x7f\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: Classes: 0 space, 1 small, 2 capital, 3 digit, 4 ASCII sign, 5 small Cyrillic, 6 capital Cyrillic, 7 Greek, 8 East Asian, 9 typographic, 10 symbol, 11 control, 12 box drawing.
_SMALL = {2: 1, 6: 5}


@functools.lru_cache(200_000)
def char_class(c: str) -> int:
    """The class of a character as a neighbour; '' is a text's edge."""
    if c == "" or c.isspace():
        return 0
    code = ord(c)
    if code < 0x80:
        return 1 if c.islower() else 2 if c.isupper() else 3 if c.isdigit() else 4
    kind = unicodedata.category(c)
    if kind[0] == "C" or c == LOST:
        return 11
    if c in "·¶§":
        return 10
    if 0x2500 <= code < 0x25A0:
        return 12
    if kind[0] in "LM":
        if 0x400 <= code < 0x530:
            return 6 if kind == "Lu" else 5
        if 0x370 <= code < 0x400:
            return 7
        if code >= 0x2E80:
            return 8
        return 2 if kind == "Lu" else 1
    if code >= 0x3000 and kind[0] == "P":
        return 8
    return 9 if kind[0] == "P" else 10


@functools.lru_cache(200_000)
def prior(c: str) -> float:
    """Probability of a character before any text is seen, by what kind it is."""
    code = ord(c)
    if code < 0x80:
        return 1e-2
    kind = unicodedata.category(c)
    if c == LOST or kind in ("Cc", "Co", "Cn", "Cs"):
        return 1e-9
    if c in "‘’“”„–—…«»":
        return 1e-4
    if kind[0] == "L":
        if 0xC0 <= code < 0x180 or 0x410 <= code < 0x450 or code in (0x401, 0x451):
            return 1e-5
        return 1e-6 if code < 0x500 or 0x4E00 <= code < 0xA000 else 1e-8
    if code >= 0x3000:
        return 1e-6 if code in (0x3001, 0x3002, 0xFF0C, 0xFF1A, 0xFF1B) else 1e-8
    return 1e-6 if code < 0x100 else 1e-7


_SCRIPT = {1: 0, 2: 0, 5: 1, 6: 1, 7: 2}
_TEXT = (1, 2, 3, 5, 6, 7)


@functools.cache
def fit(own: int, left: int, right: int) -> float:
    """How far counts of a class between two others are trusted: they may stem from garbled text themselves.

    Inside a word and at its end scripts hardly mix, capitals hardly follow small letters and symbols hardly stand.
    """
    if own == 12 and (left in _TEXT or right in _TEXT):
        return 0.0001
    if left not in _SCRIPT:
        return 1.0
    inside = right in _SCRIPT
    if own in (10, 11):
        return 0.001 if inside else 0.01
    if own in _SCRIPT and _SCRIPT[own] != _SCRIPT[left] and (not inside or _SCRIPT[own] != _SCRIPT[right]):
        return 0.0001 if inside else 0.01
    return 0.01 if (own, left) in ((2, 1), (6, 5)) or (own, left, right) in ((2, 2, 1), (6, 6, 5)) else 1.0


# Inverse transforms

@functools.cache
def _reader(encoding: str) -> dict[str, int]:
    """character -> byte of a single-byte encoding; in cp1252 also the C1 controls that lenient readers give."""
    out = {}
    for b in range(0x80, 0x100):
        try:
            out.setdefault(bytes([b]).decode(encoding), b)
        except UnicodeDecodeError:
            out.setdefault(chr(b), b)
    if encoding == "cp1252":
        for b in range(0x80, 0xA0):
            out.setdefault(chr(b), b)
    return out


@functools.cache
def _undefined(encoding: str) -> tuple[int, ...]:
    """Bytes that an encoding cannot read."""
    out = []
    for b in range(0x80, 0x100):
        try:
            bytes([b]).decode(encoding)
        except UnicodeDecodeError:
            out.append(b)
    return tuple(out)


def _bytes(run: str, read_as: str) -> list[tuple[int | None, str]]:
    """Each character's bytes; None for a lost byte, -1 for a character that the encoding has not."""
    out: list[tuple[int | None, str]] = []
    if read_as == "gbk":
        for c in run:
            if c == LOST:
                out.append((None, c))
                continue
            try:
                raw = c.encode("gbk")
            except UnicodeEncodeError:
                out.append((-1, c))
                continue
            out += [(b, c if n == 0 else "") for n, b in enumerate(raw)]
        return out
    table = _reader(read_as)
    for c in run:
        out.append((None, c) if c == LOST else (table.get(c, -1), c))
    return out


def _guess(parts: list[int | None], lost: tuple[int, ...], likely) -> str:
    """The likeliest character of a UTF-8 sequence with lost bytes; U+FFFD if none is likely."""
    if parts.count(None) != 1:
        return LOST
    best, most = LOST, 0.0
    for b in lost or range(0x80, 0xC0):
        try:
            c = bytes(b if p is None else p for p in parts).decode("utf-8")
        except UnicodeDecodeError:
            continue
        if likely(c) > most:
            best, most = c, likely(c)
    return best


def from_utf8(run: str, read_as: str, likely) -> str:
    """What a run was if it is UTF-8 read as another encoding; what forms no character stays."""
    raw = _bytes(run, read_as)
    lost = _undefined(read_as) if read_as != "gbk" else ()
    out, at = [], 0
    while at < len(raw):
        b = raw[at][0]
        size = 0 if b is None or b < 0 else 2 if 0xC2 <= b < 0xE0 else 3 if 0xE0 <= b < 0xF0 else 4 if 0xF0 <= b < 0xF5 else 0
        parts = [x for x, _ in raw[at : at + size]]
        if size and len(parts) == size and all(p is None or 0x80 <= p < 0xC0 for p in parts[1:]):
            if None in parts:
                out.append(_guess(parts, lost, likely))
                at += size
                continue
            try:
                out.append(bytes(parts).decode("utf-8"))
                at += size
                continue
            except UnicodeDecodeError:
                pass
        out.append(raw[at][1])
        at += 1
    return "".join(out)


def from_wide(run: str, written_in: str, read_as: str) -> str:
    """What a run was if it is two-byte text read as a single-byte encoding."""
    raw = _bytes(run, read_as)
    out, at = [], 0
    while at < len(raw):
        pair = [x for x, _ in raw[at : at + 2]]
        if len(pair) == 2 and None not in pair and min(pair) >= 0x81:
            try:
                out.append(bytes(pair).decode(written_in))
                at += 2
                continue
            except UnicodeDecodeError:
                pass
        out.append(raw[at][1])
        at += 1
    return "".join(out)


def from_single(run: str, written_in: str, read_as: str) -> str:
    """What a run was if it is single-byte text read as another encoding."""
    out = []
    for b, c in _bytes(run, read_as):
        try:
            # An inverted exclamation mark inside a word is a misread i far more often than this.
            out.append(bytes([b]).decode(written_in) if b is not None and b >= 0 and c != "¡" else c)
        except UnicodeDecodeError:
            out.append(c)
    return "".join(out)


#: The encoding pairs (written in, read as); the first is read twice where it is repeated.
PAIRS: tuple[tuple[str, str], ...] = (
    *(("utf-8", e) for e in ("cp1252", "cp1250", "cp1251", "cp437", "cp850", "cp866", "koi8-r", "mac-roman", "cp1254", "gbk")),
    ("utf-8 twice", "cp1252"),
    *(("cp1252", e) for e in ("cp437", "cp850", "mac-roman", "koi8-r", "cp1251", "cp1250", "gbk")),
    *((e, "cp1252") for e in ("cp437", "cp850", "mac-roman", "cp1251", "koi8-r", "cp866", "cp1250", "iso8859-2", "gbk", "big5")),
    ("cp1251", "koi8-r"), ("koi8-r", "cp1251"), ("cp866", "cp1251"), ("cp1251", "cp866"), ("koi8-r", "cp866"), ("cp866", "koi8-r"), ("gbk", "cp1251"),
)


def invert(run: str, pair: tuple[str, str], likely) -> str:
    """A state's inverse transform of a run."""
    written_in, read_as = pair
    if written_in == "utf-8":
        return from_utf8(run, read_as, likely)
    if written_in == "utf-8 twice":
        once = from_utf8(run, read_as, likely)
        return from_utf8(once, read_as, likely) if once != run else run
    if written_in in ("gbk", "big5"):
        return from_wide(run, written_in, read_as)
    return from_single(run, written_in, read_as)


class Model:
    """Character probabilities between neighbour classes, and the labelling by them."""

    LIMIT = 200_000

    def __init__(self, counts: dict[tuple[str, int, int], int]) -> None:
        self.counts = counts
        self.totals: Counter = Counter()
        self.single: Counter = Counter()
        for (c, left, right), n in counts.items():
            self.totals[left] += n
            self.single[c] += n
        self.total = sum(self.single.values())
        self.known: dict[tuple[str, str, str], tuple[float, list[tuple[float, int, str]]]] = {}

    def log(self, c: str, left: int, right: int) -> float:
        """Log probability that a character and then one of class ``right`` follow one of class ``left``.

        A capital among capitals is at least CAPITALS times as likely as its small form among small letters. A lost
        character has no likelihood as clean text, however often it occurs.
        """
        if _TRACE.match(c):
            return NEVER
        if c == "\xa0":
            return math.log((self.single[c] + PRIOR * prior(c)) / (self.total + PRIOR))
        value = fit(char_class(c), left, right) * (self.counts.get((c, left, right), 0) + PRIOR * prior(c)) / (self.totals[left] + PRIOR)
        if 2 in (left, right) or 6 in (left, right):
            small = c.lower()
            if small != c and len(small) == 1:
                around = (_SMALL.get(left, left), _SMALL.get(right, right))
                value = max(value, CAPITALS * self.counts.get((small, *around), 0) / (self.totals[around[0]] + PRIOR))
        return math.log(value)

    def string(self, text: str, left: str, right: str) -> float:
        """Log probability of the non-ASCII characters of a string between two characters."""
        classes = [char_class(left), *map(char_class, text), char_class(right)]
        return sum(self.log(c, classes[i], classes[i + 2]) for i, c in enumerate(text))

    def emissions(self, run: str, left: str, right: str) -> tuple[float, list[tuple[float, int, str]]]:
        """The clean state's log probability of a run, and those of the states that change it: value, state, restored run."""
        key = (run, left, right)
        if (found := self.known.get(key)) is not None:
            return found
        clean = self.string(run, left, right)
        states: dict[str, tuple[float, int, str]] = {}
        likely = lambda c: self.single.get(c, 0)
        for number, pair in enumerate(PAIRS):
            restored = invert(run, pair, likely)
            if restored != run:
                states[f"{number}"] = (self.string(restored, left, right), number, restored)
        if n := len(_TRACE.findall(run)):
            states["lost"] = (self.string(_TRACE.sub("", run), left, right) + LOST_EMISSION * n, len(PAIRS), run)
        out = (clean, [s for s in states.values() if s[0] > clean])
        if len(self.known) >= self.LIMIT:
            self.known.clear()
        self.known[key] = out
        return out

    def label(self, text: str) -> list[tuple[int, int, int, str]]:
        """Start, end, state and restored text of the garbled runs."""
        runs = [(m.start(), m.end(), *self.emissions(m[0], text[m.start() - 1 : m.start()], text[m.end() : m.end() + 1])) for m in RUN.finditer(text)]
        active = sorted({s for *_, states in runs for _, s, _ in states})
        if not active:
            return []
        # Scores are relative to the clean state; a garbled state emits a run that it doesn't change as the clean state does.
        enter = ENTER
        score = {s: enter for s in active}
        clean, back = 0.0, []
        for _, _, plain, states in runs:
            gains = {s: value - plain for value, s, _ in states}
            best = max(active, key=lambda s: score[s] + LEAVE)
            to_clean = score[best] + LEAVE > clean
            from_ = {s: clean + enter > score[s] + STAY for s in active}
            new_clean = score[best] + LEAVE if to_clean else clean
            new = {s: (clean + enter if from_[s] else score[s] + STAY) + gains.get(s, -1.0) for s in active}
            back.append((best if to_clean else None, from_))
            clean, score = new_clean, new
        state = max(active, key=lambda s: score[s])
        at = state if score[state] > clean else None
        out = []
        for n in range(len(runs) - 1, -1, -1):
            start, end, _, states = runs[n]
            left_clean, entered = back[n]
            if at is None:
                at = left_clean
            else:
                for _, s, restored in states:
                    if s == at:
                        out.append((start, end, s, restored))
                if entered[at]:
                    at = None
        return out[::-1]


def _triples(text: str) -> Iterator[tuple[str, int, int]]:
    for m in RUN.finditer(text):
        around = text[m.start() - 1 : m.start()], *m[0], text[m.end() : m.end() + 1]
        classes = [char_class(c) for c in around]
        for i, c in enumerate(m[0]):
            yield (c, classes[i], classes[i + 2])


def _counts(texts: DataFrame, model: Model | None) -> dict[tuple[str, int, int], int]:
    """How often each character stands between each two classes; of all texts, or of those that the model calls clean.

    The counts are as many as there are characters times pairs of classes, whatever the size of the corpus.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text and not text.isascii() and (model is None or not model.label(text)):
                    counts.update(_triples(text))
        c, left, right = zip(*counts) if counts else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()), pa.array(left, pa.int32()), pa.array(right, pa.int32()), pa.array(counts.values(), pa.int64())], ["c", "l", "r", "n"])

    grouped = texts.mapInArrow(run, "c string, l int, r int, n bigint").groupBy("c", "l", "r").agg(F.sum("n").alias("n"))
    return {(row["c"], row["l"], row["r"]): row["n"] for row in grouped.toLocalIterator()}


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """The model of a corpus: counted over all texts, then over those that are clean by the first count."""
    texts = docs.select(F.col(text_col).cast("string").alias("text")).where(F.col("text").rlike(r"[^\x00-\x7f]"))
    return Model(_counts(texts, Model(_counts(texts, None))))


def restored(docs: DataFrame, id_col: str, text_col: str = "text", model: Model | None = None) -> DataFrame:
    """``id_col``, n_spans, pairs (of encodings, by name), n_lost (characters that stay lost), restored: one row for every row."""
    model = model or train(docs, text_col)
    counts = model.counts
    names = [f"{a} as {b}" for a, b in PAIRS] + ["lost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(counts)
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for text in batch.column(1).to_pylist():
                spans = own.label(text) if text and not text.isascii() else []
                parts, at = [], 0
                for start, end, _, fixed in spans:
                    parts += [text[at:start], fixed]
                    at = end
                whole = "".join(parts) + text[at:] if spans else text
                for column, value in zip(columns, (len(spans), sorted({names[s] for _, _, s, _ in spans}), (whole or "").count(LOST), whole)):
                    column.append(value)
            kinds = (pa.int32(), pa.list_(pa.string()), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], [id_col, "n_spans", "pairs", "n_lost", "restored"])

    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    kind = source.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"{id_col} {kind}, n_spans int, pairs array<string>, n_lost int, restored string")
