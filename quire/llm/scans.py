"""Problem 3: noise of scanned pages, found and repaired.

* Running headers and footers: a line at the top or bottom of a page, where a line of the same letters stands at the same edge of
  another page nearby. Lines are compared by a key under which characters that scanning confuses are equal, so the repetition is fuzzy.
* Page numbers: a line at either edge of a page that reads as a number (Arabic or Roman, with or without signs and words around
  it, misread digits included) and differs from the page by as much as on another page nearby. Sequences may start anew.
* Divided words: a line or element that ends in a hyphen sign, unless the corpus knows the compound better than the joined word.
* Misread words: a rare word that has the key of a much more frequent one and differs from it by at most two confusions; of
  several such words the one that takes fewest, then the most frequent;
  words torn apart by a space and words spelled out with spaces whose joined form the corpus knows better than their parts.

Words are counted over all elements, and all decisions are made for distinct words and pairs by joins with those counts. Of the
words that can matter (misread ones, parts of torn ones and what those join to) and of the lines that a document has more than
once a Bloom filter of fixed size goes to the tasks, which then give rows for nothing else; no set of words comes to the driver.

The edge of a page is its first two lines and its last two, whether they stand in one element or in two.

Defined results. Null, empty and blank texts have no noise. An element without a page or with page 0 counts to the last page before it.
Of elements at one position with several pages the last page counts. Repeated rows count once. Elements of a null doc_id or
without element_id are left out. A footer is reported as a header, the kind for running lines.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.sieve import Sieve, hash_of, sieve
from quire.operators.ordered import BLOCK, at_positions, in_blocks, scan
from quire.session import checkpointed

#: Pages within which a header or a number's neighbour must recur.
NEAR = 4
#: A word misread is at least so many times rarer than the word meant; short words of letters alone need more.
RARER, RARER_SHORT = 20, 1000
#: Characters of a line that may be a header, or a page number with the words around it.
LONGEST, LONGEST_NUMBER = 100, 40
#: The joined form of a torn word is at least so many times as frequent as its rarer part.
TORN = 8
#: Occurrences from which the part of a word at a hyphen counts as a word of its own.
KNOWN = 10

#: Types of elements that headers and page numbers stand in.
_EDGE_TYPES = (None, "paragraph", "references", "figure_caption")
#: What the name of a counted line begins with; no word does.
_LINE = "\x01"

# Characters and pairs of them that scanning confuses.
# Each character has its own text in the key, a pair the text of the character it is taken for: no confusion changes a key,
# wherever it stands and whatever stands beside it.
_KEYS = str.maketrans(dict(zip("el1|¡!j05$6h8f7+9q@42", "ciiiiiiossbbbtttggaaz")) | {"n": "ri", "m": "rri", "w": "vv", "d": "ci", "u": "ii"})
_SHORT = (("rri", "m"), ("vv", "w"), ("ci", "d"), ("ii", "u"), ("ri", "n"))
_CONFUSIONS = [
    ("e", "c"), ("l", "1"), ("l", "|"), ("l", "i"), ("i", "1"), ("i", "|"), ("i", "¡"), ("i", "!"), ("i", "j"), ("l", "!"), ("o", "0"), ("s", "5"), ("s", "$"), ("b", "6"), ("b", "8"), ("b", "h"),
    ("t", "f"), ("t", "7"), ("t", "+"), ("g", "9"), ("g", "q"), ("q", "9"), ("a", "@"), ("a", "4"), ("z", "2"), ("m", "rn"), ("w", "vv"), ("d", "cl"), ("u", "ii"), ("n", "ri"),
]
_DIGITS = str.maketrans("oOlI|¡!sSbBgqzZ@+", "00111115568992247"[:17])

_HYPHENS = "-‐¬\xad"
_DIVIDED = re.compile(rf"([^\W\d_]+)([{_HYPHENS}])[ \t]*\n[ \t]*([^\W\d_]+)")
_UNENDED = re.compile(rf"([^\W\d_]+)([{_HYPHENS}])\s*$")
_LINE_HYPHEN = re.compile(rf"[{_HYPHENS}][ \t]*\n")
_TOKEN = re.compile(r"[\w|¡@$+!]*[^\W\d_][\w|¡@$+!]*")
_COMPOUND = re.compile(r"[^\W\d_]+-[^\W\d_]+")
_UNSPACED = re.compile("[぀-ヿ㐀-鿿가-힯]+")
_SPELLED = re.compile(r"(?<![^\W_])(?:[^\W\d_] ){3,}[^\W\d_](?![^\W_])")
_SIDE_BY_SIDE = re.compile(r"(?<![^\W_])([^\W\d_]+) ([^\W\d_]+)(?![^\W_])")
_DIGIT = re.compile(r"\d")
_NO_LETTER = re.compile(r"[\W_]+")
_BARE_NUMBER = re.compile(r"(?<!\S)(?:[^\w\s]|[\d_])*\d(?:[^\w\s]|[\d_])*(?!\S)")
_NO_DIGIT = re.compile(r"\D+")
_WORD = re.compile(r"[^\W\d_]+")
_NUMBER = re.compile(
    r"^(?:(?:page|pág(?:ina)?\.?|pagina|seite|p\.|s\.|стр\.|第)\s*)?(?:[\[(\-–—|·]\s*)?([0-9oOlI|¡!sSbBgqzZ@+]{1,5}|[ivxlcdm1|¡!]{1,9})(?:\s*[\])\-–—|·页])?(?:\s*(?:/|of|von|de|sur|из)\s*[0-9oOlI|¡!sSbBgqzZ@+]{1,5})?$",
    re.IGNORECASE,
)
_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}


def key(word: str) -> str:
    """The word with characters that scanning confuses made equal."""
    return word.translate(_KEYS)


def header_key(line: str) -> str | None:
    """The letters of a possible header without numbers, or null for lines too short or too long."""
    line = line.strip()
    if not 6 <= len(line) <= LONGEST or "\t" in line:
        return None
    line = line.lower()
    if _DIGIT.search(line):
        line = _BARE_NUMBER.sub("", line)
    letters = short = _NO_LETTER.sub("", key(line))
    if len(letters) < 15:
        for pair, one in _SHORT:
            short = short.replace(pair, one)
    return letters if len(short) >= 5 else None


def number_values(line: str) -> list[int]:
    """The numbers a page-number line may stand for; none if it doesn't read as one."""
    line = line.strip()
    match = len(line) <= LONGEST_NUMBER and _NUMBER.match(line)
    if not match:
        return []
    digits, roman, out = match[1].translate(_DIGITS), match[1].lower().translate(str.maketrans("1|¡!", "iiii")), set()
    if digits.isdigit():
        out.add(int(digits))
    if all(c in _ROMAN for c in roman):
        values = [_ROMAN[c] for c in roman]
        out.add(sum(-v if v < max(values[i + 1 :], default=0) else v for i, v in enumerate(values)))
    return sorted(out)


def confused(word: str, meant: str, most: int = 2) -> bool:
    """Whether at most ``most`` confusions turn one word into the other."""
    seen = {meant}
    for _ in range(most):
        new = set()
        for w in seen:
            for a, b in _CONFUSIONS:
                for x, y in ((a, b), (b, a)):
                    at = w.find(x)
                    while at >= 0:
                        new.add(w[:at] + y + w[at + len(x) :])
                        at = w.find(x, at + 1)
        if word in new:
            return True
        seen = new
    return False


def _tokens(text: str) -> list[str]:
    return [w.strip("!") for w in _TOKEN.findall(_UNSPACED.sub(" ", text) if not text.isascii() else text)]


def _whole(text: str) -> str:
    """Lower case with divided words joined and an unended last word dropped; lines stay lines."""
    text = text.lower()
    if _LINE_HYPHEN.search(text):
        text = _DIVIDED.sub(r"\1\3\n", text)
    return _UNENDED.sub(" ", text) if text.rstrip()[-1:] in _HYPHENS and text.strip() else text


def _edge_lines(text: str, kind: str | None) -> Iterator[tuple[int, int, str | None, list[int]]]:
    """Line, number of lines, header key and number values of the lines that may stand at a page's edge."""
    if kind not in _EDGE_TYPES:
        return
    lines = text.split("\n")
    n = len(lines)
    for at in sorted({0, 1, n - 2, n - 1} & set(range(n))):
        if len(lines[at]) <= LONGEST:
            values = number_values(lines[at])
            letters = None if values else header_key(lines[at])
            if letters or values:
                yield at, n, letters, values


def _line_name(doc: str, letters: str) -> str:
    """A line of a document as it is counted beside the words."""
    return f"{_LINE}{xxhash.xxh3_64_hexdigest(f'{doc} {letters}'.encode('utf-8', 'surrogatepass'))}"


def counted(elements: DataFrame) -> DataFrame:
    """word, n: words over all elements (compounds with their hyphen, too), and the lines at edges of elements that a document has more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What stands between spaces is counted first and taken apart once for each kind.
        chunks: Counter = Counter()
        lines: Counter = Counter()
        for batch in batches:
            for doc, text, kind in zip(*(batch.column(n).to_pylist() for n in range(3))):
                chunks.update(_whole(text).split())
                lines.update(_line_name(doc, letters) for _, _, letters, _ in _edge_lines(text, kind) if letters)
            if len(chunks) + len(lines) > 500_000:
                yield _counted(chunks, lines)
                chunks, lines = Counter(), Counter()
        yield _counted(chunks, lines)

    texts = elements.select(F.coalesce("doc_id", F.lit("")).alias("doc_id"), "text", "element_type").where("text is not null")
    found = texts.mapInArrow(run, "word string, n bigint").where("word <> ''").groupBy("word").agg(F.sum("n").alias("n"))
    return found.where(~F.col("word").startswith(_LINE) | (F.col("n") > 1))


def _counted(chunks: Counter, lines: Counter) -> pa.RecordBatch:
    counts = lines.copy()
    for chunk, n in chunks.items():
        for word in _tokens(chunk):
            counts[word] += n
        if "-" in chunk:
            for word in _COMPOUND.findall(chunk):
                counts[word] += n
    return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([key(w) for w in batch.column(0).to_pylist()], pa.string())], ["word", "n", "key"])


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        steps = pa.array([1 if confused(w, m, 1) else 2 if confused(w, m) else None for w, m in pairs], pa.int32())
        yield pa.RecordBatch.from_arrays([*batch.columns, steps], ["word", "meant", "n", "steps"]).filter(steps.is_valid())


def misread_words(counts: DataFrame) -> DataFrame:
    """word, meant: words that are misreadings of a known word."""
    keyed = counts.where(F.length("word") >= 3).where(~F.contains("word", F.lit("-"))).mapInArrow(_keyed, "word string, n bigint, key string")
    letters = F.col("word").rlike(r"^\p{L}+$")
    fit = keyed.where(letters & (F.col("n") >= RARER)).select("key", F.col("word").alias("meant"), F.col("n").alias("n_meant"))
    ratio = F.when(~letters | (F.length("word") > 4), RARER).otherwise(RARER_SHORT)
    pairs = keyed.join(fit, "key").where((F.col("word") != F.col("meant")) & (F.col("n_meant") >= ratio * F.col("n")))
    plausible = pairs.select("word", "meant", F.col("n_meant").alias("n")).mapInArrow(_plausible, "word string, meant string, n bigint, steps int")
    return plausible.groupBy("word").agg(F.max_by("meant", F.struct(-F.col("steps"), "n", "meant")).alias("meant"))


def torn_parts(counts: DataFrame) -> DataFrame:
    """part, joined: rare words that begin or end a word at least TORN times as frequent, and that word."""
    alpha = counts.where(F.col("word").rlike(r"^\p{L}+$"))
    cut = F.sequence(F.lit(1), F.length("word") - 1)
    ends = F.flatten(F.transform(cut, lambda k: F.array(F.substr("word", F.lit(1), k), F.substr("word", k + 1))))
    whole = alpha.where((F.col("n") >= TORN) & (F.length("word") > 1)).select(F.col("word").alias("joined"), F.col("n").alias("n_joined"), F.explode(ends).alias("word"))
    return alpha.join(whole, "word").where(F.col("n_joined") >= TORN * F.col("n")).select(F.col("word").alias("part"), "joined")


_EVIDENCE = "doc_id string, element_id string, ord int, kind string, line int, n_lines int, a string, b string, c string"


def evidence(elements: DataFrame, words: Sieve) -> DataFrame:
    """Rows of what an element may have, by kind; ``line`` is the line's number.

    E: every paragraph and reference: first words of its first three lines. L: a line that may stand at a page's edge (a: header key, b: number values, c: digits).
    H: word divided at a line end (a, b: parts, c: sign). D: word divided at the end. B: word divided before a last line that may be a page number.
    T: word. P: words side by side (a, b). S: word spelled out. Of T and P only what ``words`` may have are given.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words.opened()

        class Notes(dict):
            """What a run of non-space may be part of: 1 a misread word, 2 a torn word, 4 a word spelled out."""

            def __missing__(self, chunk: str) -> int:
                if len(self) >= 400_000:
                    self.clear()
                found = _tokens(chunk)
                out = self[chunk] = any(f"misread {w}" in known for w in found) | any(f"part {w}" in known for w in found) << 1 | any(len(w) == 1 for w in found) << 2
                return out

        notes = Notes()

        def of(doc: str, text: str, kind: str | None) -> Iterator[tuple]:
            n = text.count("\n") + 1
            if kind in ("paragraph", "references"):
                lines = text.split("\n", 3)
                yield ("E", 0, n, *([(_WORD.search(line) or [None])[0] for line in lines[:3]] + [None] * 3)[:3])
            for at, _, letters, values in _edge_lines(text, kind):
                if values or f"line {_line_name(doc, letters)}" in known:
                    line = text.split("\n")[at]
                    yield ("L", at, n, letters, ",".join(map(str, values)) or None, _NO_DIGIT.sub("", line))
                    if at == n - 1 and values and n > 1 and (m := _UNENDED.search(text[: -len(line) - 1])):
                        yield ("B", n - 2, n, m[1], None, m[2])
            if _LINE_HYPHEN.search(text):
                for m in _DIVIDED.finditer(text):
                    yield ("H", text.count("\n", 0, m.start()), n, m[1], m[3], m[2])
            if text.rstrip()[-1:] in _HYPHENS and (m := _UNENDED.search(text)):
                yield ("D", text.count("\n", 0, m.start()), n, m[1], None, m[2])
            whole = _whole(text)
            flags = set(map(notes.__getitem__, whole.split()))
            if flags <= {0}:
                return
            for number, line in enumerate(whole.split("\n")):
                chunks = line.split()
                marks = list(map(notes.__getitem__, chunks))
                if any(f & 1 for f in marks):
                    for word in _tokens(line):
                        if f"misread {word}" in known:
                            yield ("T", number, n, word, None, None)
                seen = set()
                for i, f in enumerate(marks):
                    if f & 2:
                        for at in (i - 1, i):
                            if at >= 0 and at not in seen:
                                seen.add(at)
                                m = _SIDE_BY_SIDE.search(" ".join(chunks[at : at + 2]))
                                if m and f"joined {m[1]}{m[2]}" in known:
                                    yield ("P", number, n, m[1], m[2], None)
                if sum(f >> 2 & 1 for f in marks) >= 4:
                    for m in _SPELLED.finditer(line):
                        yield ("S", number, n, m[0].replace(" ", ""), None, None)

        for batch in batches:
            rows, found = [], []
            for row, (doc, text, kind) in enumerate(zip(*(batch.column(n).to_pylist() for n in (0, 3, 4)))):
                if text:
                    got = list(of(doc, text, kind))
                    rows += [row] * len(got)
                    found += got
            at = pa.array(rows, pa.int64())
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string())
            columns = [pa.array([f[n] for f in found], k) for n, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*(batch.column(n).take(at) for n in range(3)), *columns], ["doc_id", "element_id", "ord", "kind", "line", "n_lines", "a", "b", "c"])

    source = elements.select("doc_id", "element_id", F.col("ord").cast("int").alias("ord"), "text", "element_type").where("text is not null and doc_id is not null and element_id is not null")
    return source.mapInArrow(run, _EVIDENCE)


def page_edges(elements: DataFrame) -> DataFrame:
    """doc_id, ord, page, top, bottom: the first two positions (top 1, 2) and the last two (bottom 1, 2) of every page.

    A position without a page is on the last page before it, else on page 1.
    """
    placed = elements.where("doc_id is not null and ord is not null").select("doc_id", F.col("ord").cast("int").alias("ord"), F.when(F.col("page") > 0, F.col("page")).alias("own"))
    rows = scan(at_positions(placed, "doc_id", "ord", F.max("own").alias("own")), "doc_id", "ord", lasts={"near": F.col("own")})
    ends = rows.groupBy("doc_id", F.coalesce("near", F.lit(1)).alias("page")).agg(F.min("ord").alias("first"), F.max("ord").alias("last"))
    at = lambda pos, top, bottom: F.struct(pos.alias("ord"), F.lit(top).alias("top"), F.lit(bottom).alias("bottom"))
    first, last = F.col("first"), F.col("last")
    edge = ends.select("doc_id", "page", "first", "last", F.explode(F.array(at(first, 1, None), at(first + 1, 2, None), at(last, None, 1), at(last - 1, None, 2))).alias("e"))
    inside = edge.where("e.ord between first and last")
    return inside.groupBy("doc_id", F.col("e.ord").alias("ord")).agg(F.max("page").alias("page"), F.min("e.top").alias("top"), F.min("e.bottom").alias("bottom"))


def edge_lines(seen: DataFrame, edges: DataFrame) -> DataFrame:
    """doc_id, ord, element_id, line, n_lines, noise: lines that are running headers (or footers) or page numbers.

    A line recurs if a page at most NEAR pages away has its key, or its number's distance from the page, at the same edge. No
    group meets in one place: every page asks its neighbours by an equality join. The second line of an edge, be it in
    the first element or one of its own, counts only beyond a first line that recurs itself, and its digits must recur, too.
    """
    lines = seen.where("kind = 'L'").join(edges, ["doc_id", "ord"])
    single, inner = F.col("n_lines") == 1, F.col("n_lines") - 1 - F.col("line")
    depth = lambda rank, line: F.when((rank == 1) & (line <= 1), line + 1).when((rank == 2) & single, 2)
    sides = F.array(F.struct(F.lit("top").alias("side"), depth(F.col("top"), F.col("line")).alias("depth"), F.col("top").alias("rank")), F.struct(F.lit("bottom").alias("side"), depth(F.col("bottom"), inner).alias("depth"), F.col("bottom").alias("rank")))
    offsets = F.transform(F.split("b", ","), lambda v: F.concat(F.lit("#"), v.cast("bigint") - F.col("page")))
    at_edge = lines.withColumn("s", F.explode(sides)).where("s.depth is not null")
    exact = F.concat("a", F.lit("|"), "c")
    keys = F.array_compact(F.concat(F.array(F.when(F.col("s.depth") == 1, F.col("a")), exact), F.coalesce(offsets, F.array().cast("array<string>"))))
    asked = checkpointed(at_edge.select("doc_id", "ord", "element_id", "line", "n_lines", "page", "s.side", "s.depth", "s.rank", F.explode(keys).alias("key")))
    near = F.array(*(F.col("page") + d for d in range(-NEAR, NEAR + 1) if d))
    others = asked.select("doc_id", "side", "key", F.explode(near).alias("page")).distinct()
    found = checkpointed(asked.join(others, ["doc_id", "side", "key", "page"], "left_semi"))
    first = found.where("depth = 1").groupBy("doc_id", "page", "side").agg(F.bool_or(single).alias("alone"))
    second = found.where("depth = 2").join(first, ["doc_id", "page", "side"]).where("rank = 1 or alone")
    rows = found.where("depth = 1").unionByName(second.select(*found.columns))
    return rows.select("doc_id", "ord", "element_id", "line", "n_lines", F.when(F.col("key").startswith("#"), "page_number").otherwise("header").alias("noise")).distinct()


def decided(parts: DataFrame, counts: DataFrame) -> DataFrame:
    """The distinct ``kind, a, b, c`` of ``parts`` that are noise, by one join of all their forms with the counts.

    H, D (word at a hyphen): a sign other than the plain hyphen always divides. With one the better known of both forms decides; if
    neither is known, two known words are a compound. P (side by side): torn if the joined word is TORN times as frequent as the rarer part.
    S (spelled out): words of five letters or more, shorter ones if the corpus knows them.
    """
    distinct = parts.select("kind", "a", "b", "c").distinct()
    left, right = F.lower("a"), F.lower("b")
    form = lambda name, word: F.struct(F.lit(name).alias("form"), word.alias("word"))
    forms = F.array(form("joined", F.concat(left, right)), form("compound", F.concat(left, F.lit("-"), right)), form("left", left), form("right", right))
    each = distinct.select("kind", "a", "b", "c", F.explode(forms).alias("f")).select("kind", "a", "b", "c", "f.form", "f.word")
    n = lambda name: F.coalesce(F.max(F.when(F.col("form") == name, F.col("n"))), F.lit(0)).alias(f"n_{name}")
    known = each.join(counts, "word", "left").groupBy("kind", "a", "b", "c").agg(*map(n, ("joined", "compound", "left", "right")))
    followed = F.col("b") != ""
    unknown = (F.col("n_left") < KNOWN) | followed & (F.col("n_right") < KNOWN)
    hyphen = F.when(followed & (F.col("n_compound") > F.col("n_joined")), False).when(followed & (F.col("n_joined") > 0), True).otherwise(unknown)
    torn = F.col("n_joined") >= TORN * F.greatest(F.least("n_left", "n_right"), F.lit(1))
    spelled = (F.length("a") >= 5) | (F.col("n_joined") >= KNOWN)
    noise = F.when(F.col("kind") == "P", torn).when(F.col("kind") == "S", spelled).when(F.col("c") != "-", True).otherwise(hyphen)
    return known.where(noise).select("kind", "a", "b", "c")


class Findings:
    """What was found in the elements: ``edges`` (lines), ``words`` (hyphens, torn and spelled words) and ``misread``, each by element."""

    def __init__(self, elements: DataFrame) -> None:
        both = checkpointed(counted(elements))
        counts, lines = both.where(~F.col("word").startswith(_LINE)), both.where(F.col("word").startswith(_LINE))
        wrong = checkpointed(misread_words(counts))
        tagged = lambda tag, word: hash_of(F.concat(F.lit(tag), word)).alias("h")
        torn = torn_parts(counts)
        sought = wrong.select(tagged("misread ", F.col("word"))).unionAll(lines.select(tagged("line ", F.col("word")))).unionAll(torn.select(F.explode(F.array(tagged("part ", F.col("part")), tagged("joined ", F.col("joined")))).alias("h")))
        seen = checkpointed(evidence(elements, sieve(sought, "h")))
        self.edges = checkpointed(edge_lines(seen, page_edges(elements)))
        body = seen.where("kind in ('H', 'D', 'B', 'T', 'P', 'S')").join(self.edges.select("element_id", "line"), ["element_id", "line"], "left_anti")
        parts = self._parts(body, seen)
        self.words = checkpointed(parts.join(decided(parts, counts), ["kind", "a", "b", "c"]))
        tokens = body.where("kind = 'T'").join(wrong, body["a"] == wrong["word"])
        self.misread = tokens.select("doc_id", "ord", "element_id", "a", "meant")

    def _parts(self, body: DataFrame, seen: DataFrame) -> DataFrame:
        """doc_id, ord, element_id, kind (H, D, P, S), a, b, c, next_id, next_ord; D is a word divided at the end, and b goes on in the next element."""
        inside = body.where("kind in ('H', 'P', 'S')").select("doc_id", "ord", "element_id", "kind", "a", "b", "c", F.lit(None).cast("string").alias("next_id"), F.lit(None).cast("int").alias("next_ord"))
        numbers = self.edges.where("noise = 'page_number'").select("element_id", (F.col("line") - 1).alias("line"))
        before = body.where("kind = 'B'").join(numbers, ["element_id", "line"], "left_semi")
        ends = body.where("kind = 'D'").unionByName(before).select("doc_id", "element_id", "ord", "a", "c")
        # The word goes on in the next paragraph that isn't a header or page number as a whole.
        per = self.edges.select("element_id", "line", "n_lines").distinct().groupBy("element_id").agg(F.count("*").alias("n"), F.max("n_lines").alias("n_lines"), F.bool_or(F.col("line") == 0).alias("l0"), F.bool_or(F.col("line") == 1).alias("l1"))
        opened = per.select("element_id", (F.col("n") >= F.col("n_lines")).alias("gone"), F.when(F.col("l0") & F.col("l1"), 2).when(F.col("l0"), 1).otherwise(0).alias("skip"))
        texts = seen.where("kind = 'E' and ord is not null").join(opened, "element_id", "left").where("not coalesce(gone, false)")
        word = F.when(F.col("skip") == 2, F.col("c")).when(F.col("skip") == 1, F.col("b")).otherwise(F.col("a"))
        # Scanned backwards; at one position an end comes before the texts, so that it sees only later ones.
        opens = texts.select("doc_id", (1 - 2 * F.col("ord").cast("bigint")).alias("at"), F.struct(F.col("element_id").alias("next_id"), word.alias("b"), F.col("ord").alias("next_ord")).alias("n"))
        closes = ends.where("ord is not null").select("doc_id", (-2 * F.col("ord").cast("bigint")).alias("at"), F.lit(None).cast(opens.schema["n"].dataType).alias("n"))
        ahead = scan(at_positions(opens.unionByName(closes), "doc_id", "at", F.min("n").alias("n")), "doc_id", "at", lasts={"next": F.col("n")}).where("n is null")
        after = ahead.select("doc_id", (F.col("at") / -2).cast("int").alias("ord"), "next.*")
        closed = ends.join(after, ["doc_id", "ord"], "left").select("doc_id", "ord", "element_id", F.lit("D").alias("kind"), "a", "b", "c", "next_id", "next_ord")
        # Null parts become '', so that equality joins serve.
        return inside.unionByName(closed).withColumns({k: F.coalesce(k, F.lit("")) for k in ("b", "c")}).distinct()

    def noise(self) -> DataFrame:
        """element_id, noise: each kind once for each element."""
        words = self.words.select("element_id", F.when(F.col("kind").isin("H", "D"), "hyphen").otherwise("misread").alias("noise"))
        return self.edges.select("element_id", "noise").unionByName(words).unionByName(self.misread.select("element_id", F.lit("misread").alias("noise"))).distinct()


def find_noise(elements: DataFrame) -> DataFrame:
    """element_id, noise of all elements."""
    return Findings(elements).noise()


def _cased(like: str, word: str) -> str:
    letters = [c for c in like if c.isalpha()]
    if len(letters) > 1 and all(c.isupper() for c in letters):
        return word.upper()
    return word[:1].upper() + word[1:] if letters and letters[0].isupper() else word


def repaired(text: str, element_type: str | None, fixes: list[dict]) -> str:
    """The text without its header and page number, with words made whole and, but in tables, without line ends."""
    if not fixes and "\n" not in text:
        return text if element_type == "table" else text.strip()
    by: dict[str, list[dict]] = {}
    for fix in fixes:
        by.setdefault(fix["kind"], []).append(fix)
    cut = {int(f["a"]) for f in by.get("line", [])}
    text = "\n".join(line for at, line in enumerate(text.split("\n")) if at not in cut)
    divided = {(f["a"], f["b"]) for f in by.get("H", [])}
    if _LINE_HYPHEN.search(text):
        text = _DIVIDED.sub(lambda m: m[1] + ("" if (m[1], m[3]) in divided else "-") + m[3], text)
    if "D" in by:
        text = _UNENDED.sub(r"\1", text)
    words = {f["a"]: f["b"] for f in by.get("T", [])}
    spelled = {f["a"] for f in by.get("S", [])}
    if words:
        text = _TOKEN.sub(lambda m: m[0].replace(m[0].strip("!"), _cased(m[0], words[m[0].strip("!").lower()])) if m[0].strip("!").lower() in words else m[0], text)
    if spelled:
        text = _SPELLED.sub(lambda m: m[0].replace(" ", "") if m[0].replace(" ", "").lower() in spelled else m[0], text)
    for f in by.get("P", []):
        text = re.sub(rf"(?<![^\W_])({re.escape(f['a'])}) ({re.escape(f['b'])})(?![^\W_])", r"\1\2", text, flags=re.IGNORECASE)
    return text if element_type == "table" else re.sub(r"[ \t]*\n[ \t\n]*", " ", text).strip()


_CLEAN = "doc_id string, ord int, element_type string, text string, continues boolean, goes_on boolean"


def _mended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Clean texts of a partition sorted by element, each element's fixes before its text and equal texts side by side."""
    at, last, fixes = None, None, []
    for batch in batches:
        out: list[tuple] = []
        for doc, ord_, element, kind, a, b, text in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "ord", "element_id", "kind", "a", "b", "text"))):
            if (doc, ord_, element) != at:
                at, last, fixes = (doc, ord_, element), None, []
            if kind != _TEXT:
                fixes.append({"kind": kind, "a": a, "b": b})
            elif (a, text) != last:
                last, kinds = (a, text), {f["kind"] for f in fixes}
                clean = repaired(text, a, fixes)
                if clean:
                    out.append((doc, ord_, a, clean, "from" in kinds, "to" in kinds))
        columns = [list(c) for c in zip(*out)] or [[]] * 6
        kinds_ = (pa.string(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds_)], ["doc_id", "ord", "element_type", "text", "continues", "goes_on"])


#: The kind of a text among the fixes of its element; sorts behind theirs.
_TEXT = "~text"


def clean_paragraphs(elements: DataFrame) -> DataFrame:
    """doc_id, ord, element_type, text: each document's elements without noise, in order; what was cut by a page end is one row again.

    Texts move once, to their document's block of positions, where their fixes are; only those that a divided word links move again.
    """
    found = Findings(elements)
    none, blank = F.lit(None).cast("string"), F.lit("")
    where = ["doc_id", "ord", "element_id"]
    links = found.words.where("kind = 'D' and next_id is not null")
    fixes = (
        found.edges.select(*where, F.lit("line").alias("kind"), F.col("line").cast("string").alias("a"), blank.alias("b"))
        .unionByName(found.words.select(*where, "kind", "a", "b"))
        .unionByName(found.misread.select(*where, F.lit("T").alias("kind"), "a", F.col("meant").alias("b")))
        .unionByName(links.select(*where, F.lit("to").alias("kind"), blank.alias("a"), blank.alias("b")))
        .unionByName(links.select("doc_id", F.col("next_ord").alias("ord"), F.col("next_id").alias("element_id"), F.lit("from").alias("kind"), blank.alias("a"), blank.alias("b")))
    )
    texts = elements.select("doc_id", F.col("ord").cast("int").alias("ord"), "element_id", F.lit(_TEXT).alias("kind"), F.col("element_type").alias("a"), none.alias("b"), "text").where("doc_id is not null and element_id is not null and ord is not null and text is not null")
    placed = texts.unionByName(fixes.distinct().withColumn("text", none)).withColumn("__block", F.floor(F.col("ord") / BLOCK)).repartition("doc_id", "__block")
    mended = lambda rows: rows.sortWithinPartitions("doc_id", "ord", "element_id", "kind", "a", "text").select("doc_id", "ord", "element_id", "kind", "a", "b", "text").mapInArrow(_mended, _CLEAN)
    linked = F.col("element_type").isin("paragraph", "references") & (F.col("continues") | F.col("goes_on"))
    alone = mended(placed).where(~F.coalesce(linked, F.lit(False))).select("doc_id", "ord", "element_type", "text")
    # The few linked texts are told by their fixes before they are mended.
    bound = F.max(F.col("kind").isin("from", "to")).over(Window.partitionBy("doc_id", "__block", "ord", "element_id"))
    chained = mended(placed.withColumn("__bound", bound).where("__bound")).where(linked)
    numbered = scan(in_blocks(chained, "doc_id", "ord"), "doc_id", "ord", sums={"part": (~F.col("continues")).cast("int")})
    parts = F.array_sort(F.collect_list(F.struct("ord", "text")))
    whole = numbered.groupBy("doc_id", "part").agg(F.min("ord").alias("ord"), F.min_by("element_type", "ord").alias("element_type"), F.array_join(F.transform(parts, lambda e: e["text"]), "").alias("text"))
    return alone.unionByName(whole.select("doc_id", "ord", "element_type", "text"))
