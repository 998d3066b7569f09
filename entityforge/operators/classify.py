"""Recency and task tags, and the task dimension."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entityforge.functions.times import is_recent
from entityforge.schema import DATE_FIELDS, TASKS, make_entities, metadata_of


def text_of(metadata: Column, key: str) -> Column:
    """A metadata value as text, null where it is missing."""
    return F.try_element_at(metadata, F.lit(key)).cast("string")


def tag_recency(entities: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """Adds "New" to the categories, then sorted and distinct, of entities active in the last `days` days.

    The date field depends on the type; a value that is no zoned timestamp tags nothing.
    """
    field = F.create_map(*[F.lit(x) for pair in DATE_FIELDS.items() for x in pair])
    raw = F.try_element_at(F.col("metadata"), F.try_element_at(field, F.col("entity_type"))).cast("string")
    tagged = F.array_sort(F.array_distinct(F.array_append("categories", F.lit("New"))))
    return entities.withColumn("categories", F.when(is_recent(raw, now, days), tagged).otherwise(F.col("categories")))


def haystack(entities: DataFrame) -> Column:
    """What task keywords are looked for in: name, description, categories, tags and pipeline tag, in lower case."""
    meta = F.col("metadata")
    tags = F.try_variant_get(F.try_element_at(meta, F.lit("tags")), "$", "array<string>")
    pipeline = F.when(F.map_contains_key(meta, "pipeline_tag"), F.coalesce(text_of(meta, "pipeline_tag"), F.lit("None"))).otherwise("")
    join = lambda c: F.array_join(F.coalesce(c, F.array().cast("array<string>")), " ")
    return F.lower(F.concat_ws(" ", F.coalesce("name", F.lit("")), F.coalesce("description", F.lit("")), join(F.col("categories")), join(tags), pipeline))


def matching_tasks(text: Column, tasks: dict[str, tuple[str, ...]] = TASKS) -> Column:
    """Slugs, in taxonomy order, of tasks one of whose keywords occurs anywhere in `text`."""
    found = [F.when(reduce(or_, (F.contains(text, F.lit(k)) for k in words), F.lit(False)), F.lit(slug)) for slug, words in tasks.items()]
    return F.array_compact(F.array(*found))


def tag_tasks(entities: DataFrame, tasks: dict[str, tuple[str, ...]] = TASKS) -> DataFrame:
    """Sets `related_tasks` in the metadata of entities that match a task; others keep what they had."""
    found = matching_tasks(F.col("_text"), tasks)
    looked = entities.withColumn("_text", haystack(entities)).withColumn("_tasks", found)
    added = F.map_concat("metadata", F.create_map(F.lit("related_tasks"), F.col("_tasks").cast("variant")))
    return looked.withColumn("metadata", F.when(F.size("_tasks") > 0, added).otherwise(F.col("metadata"))).drop("_text", "_tasks")


def task_entities(spark: SparkSession, tasks: dict[str, tuple[str, ...]] = TASKS, first_pos: int = 1 << 60) -> DataFrame:
    """The taxonomy as entities, after all others in order."""
    slugs = spark.createDataFrame([(first_pos + i, slug) for i, slug in enumerate(tasks)], "pos bigint, slug string")
    words = F.replace("slug", F.lit("-"), F.lit(" "))
    about = F.concat(F.lit("Things you can do with AI related to "), words, F.lit("."))
    return make_entities(
        slugs, F.lit("task"), F.initcap(words), about, F.lit(""), F.array(F.lit("Tasks")), F.lit("Manual/Taxonomy"), F.lit(""),
        metadata_of(slug=F.col("slug")), F.col("pos"),
    )
