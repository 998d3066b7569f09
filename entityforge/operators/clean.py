"""Cleaning and URL normalization of entities."""

from __future__ import annotations

from pyspark.sql import DataFrame

from entityforge.functions.text import clean_text
from entityforge.functions.urls import normalize_url


def clean_entities(entities: DataFrame) -> DataFrame:
    """Cleans name and description; ids, made from the raw values, stay."""
    return entities.withColumns({c: clean_text(entities[c]) for c in ("name", "description")})


def normalize_urls(entities: DataFrame) -> DataFrame:
    """Canonical urls; the source's url stays as it is."""
    return entities.withColumn("url", normalize_url(entities["url"]))
