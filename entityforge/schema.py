"""The entity and relationship schemas, and the fixed vocabularies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityforge.functions.ids import entity_id
from entityforge.functions.text import first_filled, strip, strip_text

#: Columns of an entity. `pos` is the ingest order, which decides who wins; it is not exported.
ENTITY_COLUMNS = ("pos", "id", "entity_type", "name", "description", "url", "logo_url", "categories", "source", "metadata")
ENTITY_DDL = (
    "pos bigint, id string, entity_type string, name string, description string, url string, logo_url string, "
    "categories array<string>, source struct<name:string,url:string>, metadata map<string,variant>"
)

#: Legal entity types, and those that need a url.
ENTITY_TYPES = ("company", "tool", "robot", "device", "personal", "model", "repository", "mcp", "collection", "news", "video", "task", "creative")
URL_TYPES = tuple(t for t in ENTITY_TYPES if t not in ("task", "creative"))

#: Legal relations.
RELATIONS = ("develops", "solves", "integrates_with", "runs")

#: Metadata field with the date of last activity, by type.
DATE_FIELDS = {
    "repository": "pushed_at", "mcp": "pushed_at", "collection": "pushed_at", "model": "last_modified", "video": "published_at", "news": "published_at",
}

#: Tasks and the words that point to them.
TASKS = {
    "code-generation": ("code", "coding", "programming", "developer"),
    "image-generation": ("image", "text-to-image", "diffusion", "photo"),
    "video-generation": ("video generation", "text-to-video"),
    "audio-generation": ("speech", "voice", "text-to-speech", "music generation"),
    "chat-assistant": ("chat", "assistant", "conversational"),
    "summarization": ("summariz", "summary"),
    "translation": ("translat",),
    "data-analysis": ("data analysis", "analytics", "spreadsheet"),
    "search-research": ("search", "research", "retrieval"),
    "agent-automation": ("agent", "automation", "workflow"),
}


def no_metadata() -> Column:
    """An empty metadata map."""
    return F.expr("cast(map() as map<string,variant>)")


def metadata_of(**fields: Column) -> Column:
    """A metadata map; a null value is a key with null, unlike a missing key."""
    pairs = [x for k, v in fields.items() for x in (F.lit(k), v.cast("variant"))]
    return F.create_map(*pairs) if pairs else no_metadata()


def make_entities(
    df: DataFrame, entity_type: Column, name: Column, description: Column, url: Column, categories: Column, source_name: Column, source_url: Column,
    metadata: Column | None = None, pos: Column | None = None,
) -> DataFrame:
    """Projects any rows onto the entity schema. The id comes from the raw url, or the source's where there is none."""
    own_url = F.coalesce(url, F.lit(""))
    stripped = strip(F.coalesce(name, F.lit("")))
    return df.select(
        (pos if pos is not None else F.lit(0)).cast("bigint").alias("pos"),
        entity_id(entity_type, stripped, first_filled(url, source_url)).alias("id"),
        entity_type.alias("entity_type"),
        stripped.alias("name"),
        strip_text(F.coalesce(description, F.lit(""))).alias("description"),
        own_url.alias("url"),
        F.lit(None).cast("string").alias("logo_url"),
        F.coalesce(categories, F.array().cast("array<string>")).alias("categories"),
        F.struct(source_name.alias("name"), F.coalesce(source_url, F.lit("")).alias("url")).alias("source"),
        (metadata if metadata is not None else no_metadata()).alias("metadata"),
    )
