"""Connectors: payloads of remote searches and feeds, and curated seed files, as DataFrames.

Searches and feeds are data sources with a partition per query or feed, so a connector with many queries is
as parallel as the cluster. Everything remote goes through an injectable opener, so that it runs offline.
"""

from __future__ import annotations

import json
import logging
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityforge.sources import payloads
from entityforge.sources.datasource import PUSHDOWN, Ask, read_queries, source_of
from entityforge.sources.feeds import decoded, feed_entries
from entityforge.sources.http import Opener, get_with_retry, open_url

log = logging.getLogger(__name__)

#: Where the searches are, and the feeds that are read by default.
REPOSITORY_API = "https://api.github.com/search/repositories"
MODEL_API = "https://huggingface.co/api/models"
VIDEO_API = "https://www.googleapis.com/youtube/v3/search"
FEEDS = {
    "TechCrunch AI": "https://techcrunch.com/category/artificial-intelligence/feed/",
    "VentureBeat AI": "https://venturebeat.com/category/ai/feed/",
    "MIT Technology Review": "https://www.technologyreview.com/feed/",
    "The Verge AI": "https://www.theverge.com/ai-artificial-intelligence/rss/index.xml",
    "Hugging Face Blog": "https://huggingface.co/blog/feed.xml",
    "OpenAI News": "https://openai.com/news/rss.xml",
}
PAGE = 50


def load_env(path: str = ".env") -> None:
    """Sets variables of a `.env` file that the environment lacks."""
    if os.path.exists(path):
        with open(path, encoding="utf-8") as lines:
            for line in lines:
                key, mark, value = line.strip().partition("=")
                if mark and not key.startswith("#"):
                    os.environ.setdefault(key.strip(), value.strip().strip("'\""))


#: Formats that `register` makes known to `spark.read`.
REPOSITORIES, MODELS, VIDEOS, ENTRIES = "catalog_repositories", "catalog_models", "catalog_videos", "catalog_feeds"


def ask_repositories(opener: Opener = open_url, token: str | None = None) -> Ask:
    """Most starred repositories of a query, `limit` at most; a query that fails gives none."""
    token = token or os.environ.get("GITHUB_TOKEN")
    headers = {"Accept": "application/vnd.github+json"} | ({"Authorization": f"Bearer {token}"} if token else {})

    def ask(query: str, options: dict[str, str]) -> list[dict]:
        limit = int(options.get("limit", 30))
        answer = get_with_retry(REPOSITORY_API, {"q": query, "sort": "stars", "order": "desc", "per_page": min(limit, PAGE)}, headers, opener=opener)
        return answer.json().get("items", [])[:limit] if answer else []

    return ask


def ask_models(opener: Opener = open_url) -> Ask:
    """Most downloaded models of a query, which may be empty; option `pipeline_tag`."""

    def ask(query: str, options: dict[str, str]) -> list[dict]:
        tag = options.get("pipeline_tag")
        asked = {"sort": "downloads", "direction": -1, "limit": int(options.get("limit", 30))} | ({"search": query} if query else {}) | ({"pipeline_tag": tag} if tag else {})
        answer = get_with_retry(MODEL_API, asked, opener=opener)
        return answer.json() if answer else []

    return ask


def ask_videos(opener: Opener = open_url, key: str | None = None) -> Ask:
    """Most relevant videos of a query; none without a key."""
    key = key or os.environ.get("YOUTUBE_API_KEY")

    def ask(query: str, options: dict[str, str]) -> list[dict]:
        limit = int(options.get("limit", 25))
        asked = {"part": "snippet", "q": query, "type": "video", "maxResults": min(limit, PAGE), "order": "relevance", "key": key}
        answer = get_with_retry(VIDEO_API, asked, opener=opener) if key else None
        return answer.json().get("items", [])[:limit] if answer else []

    return ask


def ask_feeds(opener: Opener = open_url, feeds: dict[str, str] | None = None) -> Ask:
    """The document of a feed, by its name, as one item; one that fails gives none."""
    feeds = feeds or FEEDS

    def ask(name: str, options: dict[str, str]) -> list[dict]:
        try:
            answer = opener(feeds[name], {}, 15)
        except OSError:
            return []
        return [{"source_name": name, "feed_url": feeds[name], "xml": decoded(answer.body)}]

    return ask


def register(spark: SparkSession, opener: Opener = open_url) -> None:
    """Makes the four formats known to `spark.read`, with the environment's keys: option `queries` is a JSON list, of names for feeds."""
    spark.conf.set(PUSHDOWN, "true")
    for name, ask in ((REPOSITORIES, ask_repositories(opener)), (MODELS, ask_models(opener)), (VIDEOS, ask_videos(opener)), (ENTRIES, ask_feeds(opener))):
        spark.dataSource.register(source_of(name, ask))


def _payloads(found: DataFrame, schema: str) -> DataFrame:
    """Items read by their schema, with `_query` (place of the query) and `_item` (place in its answer)."""
    return found.select("_query", "_item", F.from_json("raw", schema).alias("x")).select("_query", "_item", "x.*")


def scan_repositories(spark: SparkSession, queries: list[str], limit: int = 30, opener: Opener = open_url, token: str | None = None) -> DataFrame:
    """Most starred repositories of each query, `limit` at most; a query that fails gives none."""
    return _payloads(read_queries(spark, REPOSITORIES, ask_repositories(opener, token), queries, limit=limit), payloads.REPOSITORY)


def scan_models(spark: SparkSession, query: str = "", pipeline_tag: str | None = None, limit: int = 30, opener: Opener = open_url) -> DataFrame:
    """Most downloaded models."""
    return _payloads(read_queries(spark, MODELS, ask_models(opener), [query], limit=limit, pipeline_tag=pipeline_tag or ""), payloads.MODEL)


def scan_videos(spark: SparkSession, query: str, limit: int = 25, opener: Opener = open_url, key: str | None = None) -> DataFrame:
    """Most relevant videos; none without a key."""
    if not (key or os.environ.get("YOUTUBE_API_KEY")):
        log.warning("no key for the video search; it gives nothing")
    return _payloads(read_queries(spark, VIDEOS, ask_videos(opener, key), [query], limit=limit), payloads.VIDEO)


def scan_feeds(spark: SparkSession, feeds: dict[str, str] | None = None, limit: int = 20, opener: Opener = open_url) -> DataFrame:
    """The first `limit` entries of each feed, in feed order; a feed that fails gives none."""
    feeds = feeds or FEEDS
    documents = _payloads(read_queries(spark, ENTRIES, ask_feeds(opener, feeds), list(feeds)), "source_name string, feed_url string, xml string")
    return feed_entries(documents.drop("_item"), limit=limit)


def check_feeds(spark: SparkSession, feeds: dict[str, str] | None = None, opener: Opener = open_url) -> DataFrame:
    """Each feed with its number of entries and whether there are any."""
    feeds = feeds or FEEDS
    names = spark.createDataFrame([(n,) for n in feeds], "source_name string")
    return payloads.feed_health(names, scan_feeds(spark, feeds, 1 << 30, opener))


def seed_rows(text: str) -> list[dict]:
    """Rows of a seed file: a YAML list of flat mappings (or, with PyYAML, any YAML)."""
    try:
        import yaml

        return [dict(r) for r in yaml.safe_load(text) or []]
    except ImportError:
        return _flat_yaml(text)


def _flat_yaml(text: str) -> list[dict]:
    """The part of YAML that seed files use: `- key: value` rows of plain or quoted scalars."""
    rows: list[dict] = []
    for line in text.splitlines():
        bare = line.strip()
        if not bare or bare.startswith("#"):
            continue
        if bare.startswith("- "):
            rows.append({})
            bare = bare[2:]
        key, mark, value = bare.partition(":")
        if mark and rows:
            value = value.strip()
            quoted = len(value) > 1 and value[0] == value[-1] and value[0] in "'\""
            value = value[1:-1] if quoted else value.split(" #")[0].strip()
            rows[-1][key.strip()] = int(value) if value.isdigit() and not quoted else value or ("" if quoted else None)
    return rows


def scan_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a seed file through Spark's reader; a missing or empty file gives none. Keys other than name, url and description are metadata."""
    try:
        text = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(error):
            raise
        text = ""
    own = ("name", "url", "description")
    rows = [
        (i, *(None if r.get(k) is None else str(r[k]) for k in own), json.dumps({k: v for k, v in r.items() if k not in own})) for i, r in enumerate(seed_rows(text))
    ]
    base = spark.createDataFrame(rows, "_item bigint, name string, url string, description string, meta string")
    meta = F.from_json("meta", "map<string,variant>")
    return base.select(F.lit(0).cast("bigint").alias("_query"), "_item", "name", "url", "description", meta.alias("metadata"))


@dataclass(frozen=True)
class Preset:
    """A named module: which connector, what it makes, and its parameters."""

    source: str
    entity_type: str
    extra: tuple[str, ...] = ()
    queries: tuple[str, ...] = ()
    query: str = ""
    pipeline_tag: str | None = None
    file: str = ""


#: The modules.
PRESETS = {
    "repos": Preset("github", "repository", queries=("topic:large-language-models", "topic:generative-ai", "topic:ai-agents")),
    "mcp": Preset("github", "mcp", ("MCP",), ("topic:mcp-server", "topic:model-context-protocol")),
    "collections": Preset("github", "collection", ("Collections",), ("topic:awesome-list topic:artificial-intelligence", "awesome machine-learning in:name")),
    "models": Preset("huggingface", "model"),
    "creative": Preset("huggingface", "model", ("Creative",), pipeline_tag="text-to-image"),
    "videos": Preset("youtube", "video", query="AI tools tutorial 2026"),
    "news": Preset("rss", "news"),
    "companies": Preset("seed", "company", ("Companies",), file="companies.yaml"),
    "tools": Preset("seed", "tool", ("Tools",), file="tools.yaml"),
    "robots": Preset("seed", "robot", ("Robots",), file="robots.yaml"),
    "devices": Preset("seed", "device", ("Devices",), file="devices.yaml"),
    "personal": Preset("seed", "personal", ("Personal",), file="personal.yaml"),
}


def chosen_modules(text: str) -> list[str]:
    """`all`, or a comma-separated list of modules; raises ValueError for an unknown one."""
    if text == "all":
        return list(PRESETS)
    modules = [m.strip() for m in text.split(",") if m.strip()]
    if unknown := [m for m in modules if m not in PRESETS]:
        raise ValueError(f"unknown modules {unknown}; there are {list(PRESETS)} and all")
    return modules


def fetch_module(spark: SparkSession, name: str, limit: int = 30, seed_dir: str = "seeds", opener: Opener = open_url, place: int = 0) -> DataFrame:
    """Entities of a module; `pos` packs the module's place, the query's and the item's. Seeds know no limit."""
    p = PRESETS[name]
    pos = F.lit(place).cast("bigint") * (1 << 50) + F.col("_query") * (1 << 30) + F.col("_item")
    if p.source == "github":
        return payloads.parse_repositories(scan_repositories(spark, list(p.queries), limit, opener), p.entity_type, p.extra, pos)
    if p.source == "huggingface":
        return payloads.parse_models(scan_models(spark, p.query, p.pipeline_tag, limit, opener), p.entity_type, p.extra, pos)
    if p.source == "youtube":
        return payloads.parse_videos(scan_videos(spark, p.query, limit, opener), p.entity_type, p.extra, pos)
    if p.source == "rss":
        return payloads.parse_entries(scan_feeds(spark, None, limit, opener), p.entity_type, p.extra, pos)
    return payloads.parse_seeds(scan_seeds(spark, f"{seed_dir}/{p.file}"), p.entity_type, p.extra, pos)
