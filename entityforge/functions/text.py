"""Text columns: stripping, HTML unescaping and cleaning."""

from __future__ import annotations

import html
import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's `str.isspace` has it, as what stands in brackets: listed, since Java's Unicode class lacks the
#: four separators and takes several times as long.
SPACES = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = f"[{SPACES}]"

#: The most frequent references, each with its text. `&amp;` goes last, so that what it uncovers is not
#: decoded again.
FREQUENT = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&nbsp;", "\u00a0"), ("&copy;", "\u00a9"),
    ("&middot;", "\u00b7"), ("&hellip;", "\u2026"), ("&mdash;", "\u2014"), ("&ndash;", "\u2013"), ("&amp;", "&"),
)
#: What may be a character reference, as the HTML standard has it.
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
#: Names that may stand without a semicolon, longest first, so that a pattern takes the longest that fits.
BARE_NAMES = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
#: Code points from here on are mostly themselves; what the earlier ones stand for is looked up.
PLAIN_FROM = 0xA0
#: White space other than blank, tab and line feed.
RARE_SPACE = r"[\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """Drops leading and trailing white space of any kind; a run is walked once."""
    return F.regexp_replace(c, rf"^{SPACE}++|(?<!{SPACE}){SPACE}++\z", "")


def strip_text(c: Column) -> Column:
    """As `strip`, for long texts: one without white space at its ends is not searched."""
    return F.when(F.concat(F.left(c, F.lit(1)), F.right(c, F.lit(1))).rlike(SPACE), strip(c)).otherwise(c)


def squeeze(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends. Most texts need plain replacing alone; only runs of blanks are then searched for."""
    lined = lambda t: F.replace(F.replace(t, F.lit("\n"), F.lit(" ")), F.lit("\t"), F.lit(" "))
    blank = lambda t: lined(F.when(t.rlike(RARE_SPACE), F.regexp_replace(t, RARE_SPACE, " ")).otherwise(t))
    return let(let(c, blank), lambda t: F.trim(F.when(F.contains(t, F.lit("  ")), F.regexp_replace(t, "  ++", " ")).otherwise(t)))


def _table_of(values: dict | list, type_: str) -> Column:
    """A constant table, as one literal of the plan."""
    return F.from_json(F.lit(json.dumps(values)), type_)


def _character(code: Column) -> Column:
    """The character of a code point. A byte order mark comes first and is dropped, so that one that is asked for stays."""
    return F.decode(F.unhex(F.concat(F.lit("0000FEFF"), F.lpad(F.hex(code), 8, "0"))), "UTF-32")


def _numeric(reference: Column) -> Column:
    """What a numeric reference stands for."""
    digits = lambda pattern: F.regexp_extract(reference, pattern, 1)
    hexed, plain = digits("^&#[xX]0*([0-9a-fA-F]*)"), digits("^&#0*([0-9]*)")
    beyond = F.lit(0x110000).cast("bigint")
    number = lambda text, base, most: F.when(F.length(text) > most, beyond).otherwise(F.conv(F.concat(F.lit("0"), F.substring(text, 1, most)), base, 10).cast("bigint"))
    code = F.when(reference.rlike("^&#[xX]"), number(hexed, 16, 6)).otherwise(number(plain, 10, 7))
    early = _table_of([html.unescape(f"&#{n};") for n in range(PLAIN_FROM)], "array<string>")
    wrong = (code >= 0x110000) | code.between(0xD800, 0xDFFF)
    unused = code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(0xFFFE) == 0xFFFE)
    return (
        F.when(code < PLAIN_FROM, F.get(early, F.least(code, F.lit(PLAIN_FROM)).cast("int"))).when(wrong, F.lit("\ufffd"))
        .when(unused, F.lit("")).otherwise(_character(F.when(wrong, F.lit(32)).otherwise(code)))
    )


def _named(reference: Column) -> Column:
    """What a named reference stands for: the whole name, else the longest bare name that it starts with, else itself."""
    # a map is searched from its start
    ended = _table_of(dict(reversed(FREQUENT)) | {f"&{name}": text for name, text in html5.items() if name.endswith(";")}, "map<string,string>")
    bare = _table_of({name: html5[name] for name in BARE_NAMES}, "map<string,string>")
    start = F.regexp_extract(reference, f"^&({'|'.join(BARE_NAMES)})", 1)
    by_start = F.concat(F.try_element_at(bare, start), F.substring(reference, F.length(start) + 2, F.length(reference)))
    return F.coalesce(F.when(reference.endswith(";"), F.try_element_at(ended, reference)), by_start, reference)


def html_unescape(c: Column) -> Column:
    """All HTML5 character references, once, by built-in functions.

    Texts without `&` stay. In texts whose every `&` starts one of the frequent references those are replaced; in others, references and what
    stands between them are put together anew. A number beyond the code points, of whatever length, is U+FFFD; null stays null.
    """
    between = F.split(c, REFERENCE, -1)
    decoded = F.transform(F.regexp_extract_all(c, F.lit(REFERENCE), F.lit(0)), lambda r: F.when(r.startswith("&#"), _numeric(r)).otherwise(_named(r)))
    any_of_them = F.array_join(F.zip_with(between, decoded, lambda text, r: F.concat(text, F.coalesce(r, F.lit("")))), "")
    frequent = c
    for reference, text in FREQUENT:
        frequent = F.replace(frequent, F.lit(reference), F.lit(text))
    return F.when(~F.contains(c, F.lit("&")), c).when(c.rlike(f"&(?!{'|'.join(reference[1:] for reference, _ in FREQUENT)})"), any_of_them).otherwise(frequent)


def clean_text(c: Column) -> Column:
    """Unescapes once, then tags and runs of white space become one blank; null and empty give ''."""
    plain = F.regexp_replace(html_unescape(c), "<[^>]+>", " ")
    return F.coalesce(squeeze(plain), F.lit(""))


def first_filled(*cs: Column | str) -> Column:
    """The first value that is neither null nor empty, else ''."""
    return F.coalesce(*[F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in cs], F.lit(""))


def contains_either_way(a: Column, b: Column) -> Column:
    """Whether one text holds the other, in lower case."""
    x, y = F.lower(a), F.lower(b)
    return F.contains(x, y) | F.contains(y, x)


def first_line(text: str) -> Column:
    """The first line with anything but white space, else ''."""
    return F.coalesce(F.regexp_extract(text, rf"^{SPACE}*([^\n]*)", 1), F.lit(""))
