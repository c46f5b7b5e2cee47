"""Text expressions: HTML cleaning, sentences and tokens.

The regular expressions for white space, sentences and tokens use the syntax
common to Java regex (Spark) and RE2 (DuckDB, the oracle), so both engines
cut texts identically; the markup grammar is Java's alone.
"""

from __future__ import annotations

import json
import zlib

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

# The characters Python's str.isspace() treats as whitespace.
WHITESPACE_CLASS = (r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}"
                    r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+")
NON_ASCII = r"[^\x00-\x7F]+"

# The rest of a tag up to its end: a quote opens a value only after an equals
# sign, and > inside it does not end the tag. Possessive throughout: no
# backtracking, no recursion, whatever the text.
_REST = r"""(?:[^>="']++|=\s*+(?:"[^"]*+"|'[^']*+'|(?!["']))|["'])*+>"""
# One token of markup, the first alternative that fits at its place. Comments,
# CDATA and raw-text elements that never end reach to the end of the text; a
# tag with a quote that never closes ends at its first >. Group 1: CDATA text.
HTML_TOKEN = (
    r"(?s)<!--(?:-?>|.*?(?:--!?>|\z))"
    r"|<!\[CDATA\[(.*?)(?:\]\]>|\z)"
    r"|<(?i:(script|style|template))(?=[\s/>])" + _REST +
    r".*?(?:</(?i:\2)(?=[\s/>])" + _REST + r"|\z)"
    r"|<[!?][^>]*+>"
    r"|</?[A-Za-z]" + _REST +
    r"|</?[A-Za-z][^>]*+>")
_CDATA = r"(?s)<!\[CDATA\[.*?(?:\]\]>|\z)|[^<]++|<"

# A character reference: decimal, hexadecimal or named; without a semicolon
# only the names that HTML allows bare (the longest of them that fits).
REFERENCE = r"&(?:#[0-9]++;?|#[xX][0-9A-Fa-f]++;?|[A-Za-z][A-Za-z0-9]{1,31};?)"
_PARTS = REFERENCE + r"|[^&]++|&"
_NAME_BUCKETS = 1024
# Common references whose text holds no ampersand: what they leave cannot join
# into another reference, so they may be replaced before all others.
_COMMON = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": "\xa0"}

# Sentences: maximal runs without a sentence end; tokens: runs of letters.
SENTENCE = r"[^.!?]+"
TOKEN = r"\p{L}+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _names() -> dict[str, str]:
    """Every named reference of HTML 5 (from Python's own table), without
    the ampersand; bare names end without a semicolon."""
    from html.entities import html5
    return html5


def _name_buckets() -> Column:
    """The names as one constant array of small maps, found by crc32: a map
    is searched from its start, so each holds only a few."""
    buckets: list[dict[str, str]] = [{} for _ in range(_NAME_BUCKETS)]
    for name, text in _names().items():
        buckets[zlib.crc32(name.encode()) % _NAME_BUCKETS][name] = text
    return F.from_json(F.lit(json.dumps(buckets)),
                       T.ArrayType(T.MapType(T.StringType(), T.StringType())))


def _numeric() -> dict[str, str]:
    """Numbers that HTML 5 does not read as their own code point: 0 and the
    C1 range, taken as Windows-1252 where that has a character."""
    out = {"0": "\ufffd"}
    for n in range(0x80, 0xA0):
        try:
            out[str(n)] = bytes([n]).decode("cp1252")
        except UnicodeDecodeError:
            pass
    return out


def _constant_map(values: dict[str, str]) -> Column:
    """A string map as one constant (folded once, not built per row)."""
    return F.from_json(F.lit(json.dumps(values)), T.MapType(T.StringType(), T.StringType()))


def decode_references(c: Column | str) -> Column:
    """Character references decoded once, in one pass: what a decoded
    reference leaves is not decoded again. Numbers beyond Unicode and
    surrogates give U+FFFD; names that HTML does not know stay."""
    buckets, numbers = _name_buckets(), _constant_map(_numeric())
    bare = {len(n) for n in _names() if not n.endswith(";")}

    def number(digits: Column, base: int) -> Column:
        short = F.regexp_replace(digits, "^0+(?=.)", "")
        code = F.when(F.length(short) <= 7, F.conv(short, base, 10))
        n = code.cast("long")
        char = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        known = ~((n > 0x10FFFF) | n.between(0xD800, 0xDFFF))
        return F.coalesce(F.try_element_at(numbers, code), F.when(known, char), F.lit("\ufffd"))

    def meaning(key: Column) -> Column:
        bucket = (F.crc32(key.cast("binary")) % _NAME_BUCKETS + 1).cast("int")
        return F.try_element_at(F.element_at(buckets, bucket), key)

    def name(part: Column) -> Column:
        key = F.substring(part, 2, 64)
        # the longest bare name that fits
        heads = [F.concat(meaning(F.left(key, F.lit(n))), F.substring(key, n + 1, 64))
                 for n in sorted(bare, reverse=True)]
        return F.coalesce(meaning(key), *heads, part)

    def one(part: Column) -> Column:
        digits = F.regexp_extract(part, "[0-9A-Fa-f]+", 0)
        return (F.when(~F.startswith(part, F.lit("&")) | (F.length(part) < 3), part)
                .when(part.rlike("^&#[xX]"), number(digits, 16))
                .when(F.startswith(part, F.lit("&#")), number(digits, 10))
                .otherwise(name(part)))

    text = quick = _col(c)
    for reference, char in _COMMON.items():
        quick = F.replace(quick, F.lit(reference), F.lit(char))
    parts = F.regexp_extract_all(quick, F.lit(_PARTS), 0)
    return (F.when(~F.contains(text, F.lit("&")), text)
            .when(~quick.rlike("&(?!amp;)[#A-Za-z]"), F.replace(quick, F.lit("&amp;"), F.lit("&")))
            .otherwise(F.array_join(F.transform(parts, one), "")))


def strip_html(c: Column | str) -> Column:
    """Markup dropped in one pass, the text of CDATA sections kept as it is,
    then character references decoded."""
    text = _col(c)
    # references have no meaning in CDATA: its ampersands are written as such
    literal = F.array_join(F.transform(
        F.regexp_extract_all(text, F.lit(_CDATA), 0),
        lambda x: F.when(F.startswith(x, F.lit("<![CDATA[")), F.replace(x, F.lit("&"), F.lit("&amp;")))
        .otherwise(x)), "")
    text = F.when(F.contains(text, F.lit("<![CDATA[")), literal).otherwise(text)
    return decode_references(F.regexp_replace(text, HTML_TOKEN, "$1"))


def collapse_whitespace(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(c), WHITESPACE_CLASS, " "))


def remove_quotes(c: Column | str) -> Column:
    return F.replace(_col(c), F.lit('"'), F.lit(""))


def remove_non_ascii(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), NON_ASCII, "")


def clean_text(c: Column | str) -> Column:
    """HTML -> text, collapse whitespace, drop double quotes, drop
    non-ASCII, in that order (so double spaces may remain). Null stays
    null, empty stays empty."""
    return remove_non_ascii(remove_quotes(collapse_whitespace(strip_html(c))))


def sentences(c: Column | str) -> Column:
    """Array of sentence strings (sentence ends dropped)."""
    return F.regexp_extract_all(_col(c), F.lit(SENTENCE), 0)


def tokens(c: Column | str) -> Column:
    """Array of lower-case letter tokens."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(TOKEN), 0)
