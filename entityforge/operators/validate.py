"""Rule-based validation; the order of issues is part of the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityforge.functions.text import strip, strip_text
from entityforge.functions.urls import valid_url
from entityforge.schema import ENTITY_TYPES, URL_TYPES

#: What urls of directories and listings hold.
THIRD_PARTY = ("crunchbase.com", "producthunt.com", "wikipedia.org", "ai-directory", "linkedin.com/company", "angel.co", "directory", "listings")
#: Fixed value: names that stand for a missing one. `.` excludes the line feed only; a letter, digit or underscore of any
#: script goes on with the word, which `\b` says differently from one Java version to another.
PLACEHOLDER = r"(?iud)^(placeholder|todo|dummy|example|test)(?![\p{L}\p{N}_]).*\z"
MIN_DESCRIPTION = 8


def issues_of() -> Column:
    """All issues of an entity, in the order of the rules."""
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    name, kind = strip(F.coalesce("name", F.lit(""))), F.lower(strip(F.coalesce("entity_type", F.lit(""))))
    source_url = F.coalesce(F.col("source.url"), F.lit(""))
    rules = (
        ("missing id", blank("id")),
        ("missing entity_type", blank("entity_type")),
        ("missing name", blank("name")),
        ("missing categories", F.coalesce(F.size("categories"), F.lit(0)) <= 0),
        ("missing source", F.col("source").isNull()),
        ("invalid entity_type", ~kind.isin(*ENTITY_TYPES)),
        ("missing name", name == ""),
        ("placeholder name", name.rlike(PLACEHOLDER)),
        ("missing source.name", F.coalesce(F.col("source.name"), F.lit("")) == ""),
        ("invalid source.url", (source_url != "") & ~valid_url(source_url)),
        ("missing url", F.coalesce(F.col("entity_type").isin(*URL_TYPES), F.lit(False)) & blank("url")),
        ("invalid url", ~blank("url") & ~valid_url(F.col("url"))),
        ("third-party url", F.coalesce(F.exists(F.array(*map(F.lit, THIRD_PARTY)), lambda p: F.contains(F.lower("url"), p)), F.lit(False))),
        ("missing description", blank("description")),
        ("description too short", ~blank("description") & (F.length(strip_text(F.col("description"))) < MIN_DESCRIPTION)),
    )
    return F.array_compact(F.array(*[F.when(broken, F.lit(text)) for text, broken in rules]))


def with_issues(entities: DataFrame) -> DataFrame:
    """`entities` with an `issues` column."""
    return entities.withColumn("issues", issues_of())


def validate_all(entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid entities, report): the report is one row with counts of valid and invalid ones."""
    checked = with_issues(entities)
    good = F.size("issues") == 0
    report = checked.agg(F.count_if(good).alias("valid"), F.count_if(~good).alias("invalid"))
    return checked.filter(good).drop("issues"), report


def invalid_rows(entities: DataFrame) -> DataFrame:
    """(pos, name, issues) of entities with issues."""
    return with_issues(entities).filter(F.size("issues") > 0).select("pos", "name", "issues")
