"""Logos: candidates from a page's html, and the check of what a candidate's host answers.

Finding candidates is pure and distributed; fetching pages and images is an injected client that
runs on the executors, one per partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Link relations of icons.
ICON_RELATIONS = frozenset(("icon", "shortcut icon", "apple-touch-icon", "apple-touch-icon-precomposed"))
MIN_IMAGE_BYTES = 300

#: url → (status, headers with lower-case names, body text), or None when the request failed.
Fetch = Callable[[str], tuple[int, dict[str, str], str] | None]


class _Icons(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.links: list[str] = []
        self.graph: str | None = None
        self.card: str | None = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        given = {k: v or "" for k, v in attrs}  # the last of a repeated attribute counts
        if tag == "link":
            # a relation holds words; only those of one word can name an icon here
            if ICON_RELATIONS & {w.lower() for w in given.get("rel", "").split()}:
                self.links.append(given.get("href") or given.get("content") or "")
        elif tag == "meta":
            if self.graph is None and given.get("property") == "og:image":
                self.graph = given.get("content", "")
            if self.card is None and given.get("name") == "twitter:image":
                self.card = given.get("content", "")


def candidates_of(html: str, page: str) -> list[str]:
    """Absolute urls of a page's icons in order, then its Open Graph image, then its card image; no data urls."""
    parser = _Icons()
    parser.feed(html)
    found = [*parser.links, parser.graph or "", parser.card or ""]
    return [urljoin(page, ref) for ref in found if ref and not ref.startswith("data:")]


def logo_candidates(html: Column, page: Column) -> Column:
    """Candidates of each page, as a column."""

    def found(html: pd.Series, page: pd.Series) -> pd.Series:
        return pd.Series([candidates_of(h or "", p or "") for h, p in zip(html, page)])

    return F.pandas_udf(found, "array<string>")(html, page)


def is_logo(url: str, official: str, answer: tuple[int, dict[str, str], str] | None) -> bool:
    """Whether the answer is an image of some size from the official site or a sub- or parent domain of it."""
    if answer is None or answer[0] != 200 or not answer[1].get("content-type", "").lower().startswith("image/"):
        return False
    size = answer[1].get("content-length") or "0"
    if size.isdigit() and 0 < int(size) <= MIN_IMAGE_BYTES:
        return False
    host, own = urlsplit(url).netloc.lower(), urlsplit(official).netloc.lower()
    return not host or host == own or host.endswith(f".{own}") or own.endswith(f".{host}")


def find_logo(page: str, fetch: Fetch, html: str | None = None) -> str:
    """The first candidate of the page that passes, else ''; any failure of the page gives ''. A page whose html is given is not fetched."""
    if not page:
        return ""
    try:
        if html is None:
            answer = fetch(page)
            if answer is None or answer[0] != 200:
                return ""
            html = answer[2]
        return next((c for c in candidates_of(html, page) if is_logo(c, page, fetch(c))), "")
    except Exception:  # noqa: BLE001 - a page that cannot be read has no logo
        return ""


def find_logos(entities: DataFrame, client: Callable[[], Fetch] | None, pages: DataFrame | None = None) -> DataFrame:
    """Fills logo_url. Without a client it is '', which says that it was looked for and not found.

    Each url is looked at once, however many entities have it. `pages` (url, html) are stored pages, which are read
    where they lie, so that only images are asked for; of several with one url the greatest html counts, and a null
    html is none.
    """
    if client is None:
        return entities.withColumn("logo_url", F.lit(""))
    urls = entities.select("url").filter(F.col("url") != "").distinct()
    if pages is None:
        urls = urls.withColumn("html", F.lit(None).cast("string"))
    else:
        stored = pages.groupBy(F.col("url").alias("_page")).agg(F.max("html").alias("html"))
        urls = urls.join(stored, F.col("url") == F.col("_page"), "left").select("url", "html")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetch = client()
        for batch in batches:
            found = [find_logo(u, fetch, h if isinstance(h, str) else None) for u, h in zip(batch["url"], batch["html"])]
            yield pd.DataFrame({"_page": batch["url"], "_logo": found})

    found = urls.mapInPandas(run, "_page string, _logo string")
    # entities without a url may be most of them: they are dealt by their ids
    spread = F.when(F.col("url") == "", F.xxhash64("id")).otherwise(F.lit(0))
    met = entities.withColumn("_spread", spread).join(found.withColumn("_none", F.lit(0).cast("long")), (F.col("url") == F.col("_page")) & (F.col("_spread") == F.col("_none")), "left")
    return met.withColumn("logo_url", F.coalesce("_logo", F.lit(""))).select(entities.columns)
