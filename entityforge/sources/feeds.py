"""Feeds: the entries of RSS, RDF and Atom documents as rows.

Well-formed documents are read by Spark's XML parser; only those that are not, or that hold their entries where
no feed has them, reach a reader in Python, which goes by the tags.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: An entry as it comes out.
FIELDS = "title string, summary string, description string, link string, published string"
_TEXTS = ("title", "summary", "description", "published", "pubDate", "updated")
_ENTRY = f"struct<{', '.join(f'{t}: array<string>' for t in _TEXTS)}, link: array<struct<_VALUE: string, _href: string, _rel: string>>>"
#: Where entries are: in the channels of RSS, beside the channel in RDF, or in an Atom feed; `_bad` is a document that is not well formed.
_DOCUMENT = f"channel array<struct<item: array<{_ENTRY}>>>, item array<{_ENTRY}>, entry array<{_ENTRY}>, _bad string"
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "ignoreNamespace": "true", "ignoreSurroundingSpaces": "false"}
_PROLOG = r"^[\s\x{FEFF}]*(<\?xml[^>]*\?>)?"


def decoded(body: bytes) -> str:
    """The text of a document in the encoding that it declares, else UTF-8; what does not decode is U+FFFD."""
    if body[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return body.decode("utf-16", "replace")
    said = re.match(rb"\s*<\?xml[^>]*encoding=[\"']([\w.-]+)", body)
    try:
        return body.decode(said[1].decode() if said else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


class _LooseFeed(HTMLParser):
    """Reads the entries of a feed with stray ampersands, unclosed tags or a cut end."""

    WANTED = ("title", "summary", "description", "link", "published", "pubdate", "updated")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[dict[str, str]] = []
        self.inside, self.field = False, ""

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        tag = tag.rpartition(":")[2]
        if tag in ("item", "entry"):
            self.found.append({})
            self.inside, self.field = True, ""
        elif self.inside and tag in self.WANTED:
            self.field = tag
            given = dict(attrs)
            if tag == "link" and given.get("href"):
                self.found[-1].setdefault("href" if given.get("rel") in (None, "alternate") else "other", given["href"] or "")

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        self.field = ""

    def handle_endtag(self, tag: str) -> None:
        tag = tag.rpartition(":")[2]
        if tag in ("item", "entry"):
            self.inside = False
        if tag == self.field:
            self.field = ""

    def handle_data(self, data: str) -> None:
        if self.inside and self.field:
            self.found[-1][self.field] = self.found[-1].get(self.field, "") + data

    def unknown_decl(self, data: str) -> None:
        self.handle_data(data.removeprefix("CDATA["))

    @classmethod
    def entries(cls, xml: str) -> list[dict]:
        """All entries."""
        reader = cls()
        reader.feed(xml)
        reader.close()
        found = [{k: v.strip() for k, v in e.items() if v.strip()} for e in reader.found]
        first = lambda e, *keys: next((e[k] for k in keys if k in e), None)
        return [
            {"title": e.get("title"), "summary": first(e, "summary", "description"), "description": e.get("description"), "link": first(e, "link", "href", "other"),
             "published": first(e, "published", "pubdate", "updated")} for e in found
        ]


def _loose_entries(documents: Column) -> Column:
    def read(documents: pd.Series) -> pd.Series:
        return documents.map(_LooseFeed.entries, na_action="ignore")

    return F.pandas_udf(read, f"array<struct<{FIELDS}>>")(documents)


def _first(texts: Column) -> Column:
    """The first text with anything in it."""
    return F.get(F.filter(texts, lambda t: F.trim(t) != ""), F.lit(0))


def _fields(entry: Column) -> Column:
    """An entry of a parsed document. A link's text comes before references, and one to the page itself before other relations."""
    text = {t: _first(entry[t]) for t in _TEXTS}
    links = entry["link"]
    own = F.filter(links, lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    hrefs = lambda c: F.transform(c, lambda x: x["_href"])
    link = F.coalesce(_first(F.transform(links, lambda x: x["_VALUE"])), _first(hrefs(own)), _first(hrefs(links)))
    return F.struct(
        text["title"].alias("title"), F.coalesce(text["summary"], text["description"]).alias("summary"), text["description"].alias("description"), link.alias("link"),
        F.coalesce(text["published"], text["pubDate"], text["updated"]).alias("published"),
    )


def feed_entries(feeds: DataFrame, xml: str = "xml", limit: int | None = None) -> DataFrame:
    """The entries of each document in order, the first `limit` where one is given: all columns of `feeds` but the document, `_item` and FIELDS.

    A document that is not well formed is read as far as its tags tell; null, empty ones and those without entries give
    no row. Of repeated fields the first with anything in it counts; a missing one is null. Columns of `feeds` that are called
    like a field raise.
    """
    names = [f.split()[0] for f in FIELDS.split(", ")]
    kept = [c for c in feeds.columns if c != xml]
    if clash := {c.lower() for c in kept} & {"_item", *names}:
        raise ValueError(f"columns {sorted(clash)} are made here")
    none = F.array().cast(f"array<{_ENTRY}>")
    read = feeds.select(*kept, F.col(xml).alias("_xml"), F.from_xml(F.regexp_replace(xml, _PROLOG, ""), _DOCUMENT, _OPTIONS).alias("_doc"))
    of_channels = F.flatten(F.transform("_doc.channel", lambda c: F.coalesce(c["item"], none)))
    found = read.withColumn("_found", F.concat(*[F.coalesce(c, none) for c in (of_channels, F.col("_doc.item"), F.col("_doc.entry"))]))
    elsewhere = (F.size("_found") == 0) & F.col("_xml").rlike(r"(?i)<([a-z][\w.-]*:)?(item|entry)[\s>]")
    loose = F.col("_doc._bad").isNotNull() | elsewhere
    both = found.select(*kept, "_found", loose.alias("_is_loose"), _loose_entries(F.when(loose, F.col("_xml"))).alias("_loose"))
    entries = F.when(F.col("_is_loose"), F.col("_loose")).otherwise(F.transform("_found", _fields))
    entries = entries if limit is None else F.slice(entries, 1, limit)
    return both.select(*kept, F.posexplode(entries).alias("_item", "_entry")).select(*kept, F.col("_item").cast("bigint").alias("_item"), "_entry.*")
