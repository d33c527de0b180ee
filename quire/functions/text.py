"""Column helpers for text, identities and canonical forms; all of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.split() and str.strip() know it (29 code points), for Java's regex.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
#: Line ends as Python's str.splitlines() knows them.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
#: Namespace of URL names (RFC 4122), as hex.
_URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"
_UNIT = "\x1f"


def strip(c: Column) -> Column:
    """Without white space at either end; only what has some there is searched."""
    ends = F.concat(F.substring(c, 1, 1), F.substring(c, -1, 1))
    return F.when(ends.rlike(SPACE), F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")).otherwise(c)


def tokens(c: Column) -> Column:
    """Maximal runs of non-white-space, in order."""
    return F.filter(F.split(c, f"{SPACE}+"), lambda t: t != "")


def lines(c: Column) -> Column:
    """The stripped lines that are not blank."""
    return F.filter(F.transform(F.split(c, LINE_END), strip), lambda line: line != "")


def count_of(c: Column, sub: str) -> Column:
    """How often a one-character string occurs."""
    return F.length(c) - F.length(F.replace(c, F.lit(sub), F.lit("")))


def suffix(name: Column) -> Column:
    """The lower-cased file suffix with its dot; '' if the only dot leads or trails."""
    return F.lower(F.regexp_extract(name, r"^.+(\.[^.]+)$", 1))


def file_name(path: Column) -> Column:
    """The last component of a path."""
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """The last component without its suffix."""
    name = file_name(path)
    return F.when(suffix(name) == "", name).otherwise(F.regexp_replace(name, r"\.[^.]+$", ""))


def preview(c: Column, size: int) -> Column:
    """White space collapsed, cut to ``size`` code points with '...' behind a cut; '' for size <= 0."""
    if size <= 0:
        return F.lit("")
    flat = F.array_join(tokens(c), " ")
    cut = F.regexp_replace(F.substring(flat, 1, size), f"{SPACE}+$", "")
    return F.when(F.length(flat) <= size, flat).otherwise(F.concat(cut, F.lit("...")))


def point_id(raw: Column) -> Column:
    """A UUID string: the value itself if it is a UUID in any spelling, else its name-based (version 5) UUID."""
    bare = F.lower(F.regexp_replace(F.regexp_replace(raw, r"^(?i)urn:uuid:", ""), r"[{}\-]", ""))
    digest = F.sha1(F.concat(F.unhex(F.lit(_URL_NAMESPACE)), F.encode(raw, "UTF-8")))
    variant = F.lower(F.hex((F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3)).bitwiseOR(8)))
    named = F.concat(F.substring(digest, 1, 12), F.lit("5"), F.substring(digest, 14, 3), variant, F.substring(digest, 18, 15))
    text = F.when(bare.rlike("^[0-9a-f]{32}$"), bare).otherwise(named)
    parts = [F.substring(text, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when(raw.isNotNull(), F.concat_ws("-", *parts))


def json_string(c: Column) -> Column:
    """A JSON string literal in ASCII, as Python's json.dumps writes it."""

    def unit(code: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(code), 4, "0")))

    def escaped(ch: Column) -> Column:
        code = F.ascii(ch)
        beyond = code - 0x10000
        pair = F.concat(unit(F.lit(0xD800) + F.shiftright(beyond, 10)), unit(F.lit(0xDC00) + beyond.bitwiseAND(0x3FF)))
        return F.when(code.between(0x20, 0x7E), ch).when(code < 0x10000, unit(code)).otherwise(pair)

    named = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for raw, code in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
        named = F.replace(named, F.lit(raw), F.lit(code))
    # Only texts that hold other characters are taken apart.
    others = named.rlike(r"[^\x20-\x7e]")
    return F.concat(F.lit('"'), F.when(others, F.array_join(F.transform(F.split(named, ""), escaped), "")).otherwise(named), F.lit('"'))


def content_hash(text: Column, chunk_type: Column, doc_id: Column) -> Column:
    """sha256 of the sorted-key JSON of a chunk's text and its metadata (chunk_type, doc_id)."""
    return F.sha2(
        F.concat(F.lit('{"metadata": {"chunk_type": '), json_string(chunk_type), F.lit(', "doc_id": '), json_string(doc_id), F.lit('}, "text": '), json_string(text), F.lit("}")),
        256,
    )


def field_hash(*columns: Column) -> Column:
    """sha256 over fields joined by the unit separator, nulls marked; the engine's own identity of a row."""
    return F.sha2(F.concat_ws(_UNIT, *(F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns)), 256)
