"""Schemas of raw payloads, and their projections onto entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityforge.functions.text import first_filled, strip
from entityforge.schema import make_entities, metadata_of

REPOSITORY = (
    "full_name string, name string, description string, html_url string, homepage string, stargazers_count bigint, language string, pushed_at string, "
    "topics array<string>, owner struct<login:string,avatar_url:string>, license struct<name:string>"
)
MODEL = "id string, modelId string, pipeline_tag string, tags array<string>, downloads bigint, likes bigint, lastModified string"
VIDEO = (
    "id struct<videoId:string>, snippet struct<title:string,description:string,channelTitle:string,publishedAt:string,"
    "thumbnails:struct<high:struct<url:string>>>"
)
ENTRY = "title string, summary string, description string, link string, published string, source_name string, feed_url string"
MAX_TAGS = 15
MODEL_HOST = "https://huggingface.co/"
WATCH_URL = "https://www.youtube.com/watch?v="


def _labels(*more: str) -> Column:
    return F.array(*map(F.lit, more)) if more else F.array().cast("array<string>")


def license_of(tags: Column) -> Column:
    """What follows the colon of the first `license:` tag, else "unknown"."""
    first = F.get(F.filter(F.coalesce(tags, F.array().cast("array<string>")), lambda t: t.startswith("license:")), F.lit(0))
    return F.coalesce(F.substring(first, 9, 1 << 30), F.lit("unknown"))


def provider_of(model_id: Column) -> Column:
    """What stands before the first slash, or all."""
    return F.substring_index(model_id, "/", 1)


def parse_repositories(raw: DataFrame, entity_type: str = "repository", extra: tuple[str, ...] = (), pos: Column | None = None) -> DataFrame:
    """Repository payloads as entities."""
    none = F.array().cast("array<string>")
    meta = metadata_of(
        stars=F.coalesce("stargazers_count", F.lit(0)), language=F.col("language"), pushed_at=F.col("pushed_at"), topics=F.coalesce("topics", none),
        owner=F.col("owner.login"), owner_avatar=F.col("owner.avatar_url"), license=F.col("license.name"),
    )
    return make_entities(
        raw, F.lit(entity_type), first_filled("full_name", "name"), F.col("description"), first_filled("homepage", "html_url"), _labels("Repositories", *extra),
        F.lit("GitHub"), F.col("html_url"), meta, pos,
    )


def parse_models(raw: DataFrame, entity_type: str = "model", extra: tuple[str, ...] = (), pos: Column | None = None) -> DataFrame:
    """Model payloads as entities."""
    model_id = first_filled("id", "modelId")
    tags = F.coalesce("tags", F.array().cast("array<string>"))
    meta = metadata_of(
        provider=provider_of(model_id), pipeline_tag=F.col("pipeline_tag"), license=license_of(tags), downloads=F.coalesce("downloads", F.lit(0)),
        likes=F.coalesce("likes", F.lit(0)), last_modified=F.col("lastModified"), tags=F.slice(tags, 1, MAX_TAGS),
    )
    url = F.concat(F.lit(MODEL_HOST), model_id)
    return make_entities(
        raw, F.lit(entity_type), model_id, F.coalesce("pipeline_tag", F.lit("")), url, _labels("Models", *extra), F.lit("Hugging Face"), url, meta, pos
    )


def parse_videos(raw: DataFrame, entity_type: str = "video", extra: tuple[str, ...] = (), pos: Column | None = None) -> DataFrame:
    """Video search payloads as entities."""
    url = F.concat(F.lit(WATCH_URL), F.coalesce("id.videoId", F.lit("")))
    s = F.col("snippet")
    meta = metadata_of(channel=s["channelTitle"], published_at=s["publishedAt"], thumbnail=s["thumbnails"]["high"]["url"])
    return make_entities(raw, F.lit(entity_type), s["title"], s["description"], url, _labels("Videos", *extra), F.lit("YouTube"), url, meta, pos)


def parse_entries(raw: DataFrame, entity_type: str = "news", extra: tuple[str, ...] = (), pos: Column | None = None) -> DataFrame:
    """Feed entries as entities; the source is the feed."""
    return make_entities(
        raw, F.lit(entity_type), F.col("title"), first_filled("summary", "description"), F.col("link"), _labels("News", *extra), F.col("source_name"), F.col("feed_url"),
        metadata_of(published_at=F.col("published")), pos,
    )


def parse_seeds(raw: DataFrame, entity_type: str, extra: tuple[str, ...] = (), pos: Column | None = None) -> DataFrame:
    """Seed rows (name, url, description, metadata map<string,variant>) as entities; blank names are dropped."""
    named = raw.filter(strip(F.coalesce("name", F.lit(""))) != "")
    return make_entities(
        named, F.lit(entity_type), F.col("name"), F.col("description"), F.col("url"), _labels(*extra), F.lit("Manual/Research"), F.col("url"), F.col("metadata"), pos
    )


def top_per_group(rows: DataFrame, group: str, order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group: what a source's sort and limit parameters ask for."""
    from pyspark.sql import Window

    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("_n") <= k).drop("_n")


def feed_health(feeds: DataFrame, entries: DataFrame) -> DataFrame:
    """(source_name, entries, status) for every feed: OK, or EMPTY/FAILED where nothing came."""
    counted = entries.groupBy("source_name").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return feeds.select("source_name").join(counted, "source_name", "left").select("source_name", n.alias("entries"), F.when(n > 0, "OK").otherwise("EMPTY/FAILED").alias("status"))
