"""Edges between entities, by equality and by containment of names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityforge.functions.text import first_filled
from entityforge.operators.classify import text_of
from entityforge.operators.containment import containment_join, distinct_names, first_name_in, first_text_around
from entityforge.schema import RELATIONS
from entityforge.session import cut_lineage


def _edges(df: DataFrame, source: Column, relation: str, target: Column, pos_a: Column, pos_b: Column) -> DataFrame:
    kind = F.lit(RELATIONS.index(relation))
    return df.select(
        source.alias("from"), F.lit(relation).alias("relation"), target.alias("to"), kind.alias("kind"), pos_a.alias("pos_a"), pos_b.alias("pos_b")
    )


def _at_first(rows: DataFrame, pos: str) -> DataFrame:
    """Rows that differ in their place alone as one, at the first of the places."""
    return rows.groupBy(*[c for c in rows.columns if c != pos]).agg(F.min(pos).alias(pos))


def first_containing(owners: DataFrame, owner: str, companies: DataFrame) -> DataFrame:
    """(owner, company_id): for each distinct owner, the first company in order whose name holds it or is held by it.

    Either direction answers with one company per owner, not with all that match: owners that hold names by the
    least place of those, and names that hold owners by the least of each task. Beyond the size of an automaton,
    pairs are made and reduced.
    """
    low = companies.select("id", F.lower("name").alias("_name"), "pos").filter("_name is not null")
    firsts = cut_lineage(low.groupBy("_name").agg(F.min(F.struct("pos", "id")).alias("_first")))
    texts = cut_lineage(owners.select(F.col(owner), F.lower(owner).alias("_owner")).filter("_owner is not null").distinct())
    spark = texts.sparkSession
    least = F.min("_first").alias("_first")

    if distinct_names(firsts, "_name") is None:
        inside = containment_join(texts, "_owner", firsts, "_name").groupBy(owner).agg(least)
    else:
        known = sorted((*r["_first"], r["_name"]) for r in firsts.collect())
        places = spark.createDataFrame([(n, (pos, i)) for n, (pos, i, _) in enumerate(known)], "_place bigint, _first struct<pos:bigint,id:string>")
        found = texts.withColumn("_place", first_name_in([name for *_, name in known])(F.col("_owner")))
        inside = found.filter("_place is not null").join(F.broadcast(places), "_place").select(owner, "_first")
    held = distinct_names(texts, "_owner")
    if held is None:
        around = containment_join(firsts, "_name", texts, "_owner").groupBy(owner).agg(least)
    else:
        places = spark.createDataFrame(list(enumerate(held)), "place bigint, _owner string")
        found = first_text_around(firsts.select("_first.pos", "_first.id", "_name"), "_name", held)
        found = found.groupBy("place").agg(F.min(F.struct("pos", "id")).alias("_first")).join(F.broadcast(places), "place")
        around = texts.join(found, "_owner").select(owner, "_first")
    both = inside.select(owner, "_first").unionByName(around.select(owner, "_first"))
    return both.groupBy(owner).agg(least).select(owner, F.col("_first.id").alias("company_id"))


def develops(entities: DataFrame) -> DataFrame:
    """Company → anything it owns, provides or makes: at most one company for each entity.

    Distinct owners are matched first, and entities then join on equality. `entities` is read more than
    once: hand in a table that is computed already, as a run does.
    """
    meta = F.col("metadata")
    owner = first_filled(*[text_of(meta, k) for k in ("owner", "provider", "maker")])
    owned = entities.filter(~F.col("entity_type").isin("company", "task")).select("id", "pos", owner.alias("owner")).filter("owner <> ''")
    matched = first_containing(owned, "owner", entities.filter("entity_type = 'company'"))
    return _edges(owned.join(matched, "owner"), F.col("company_id"), "develops", F.col("id"), F.col("pos"), F.lit(0))


def solves(entities: DataFrame) -> DataFrame:
    """Entity → each task that its metadata names; of tasks with one slug, the last."""
    tasks = entities.filter("entity_type = 'task'").select(text_of(F.col("metadata"), "slug").alias("slug"), "id", "pos")
    last = tasks.groupBy("slug").agg(F.max_by("id", "pos").alias("task_id"))
    named = F.try_variant_get(F.try_element_at(F.col("metadata"), F.lit("related_tasks")), "$", "array<string>")
    wanted = entities.select("id", "pos", F.posexplode(named).alias("n", "slug"))
    return _edges(wanted.join(last, "slug"), F.col("id"), "solves", F.col("task_id"), F.col("pos"), F.col("n").cast("bigint"))


def integrates_with(entities: DataFrame, repeats: bool = True) -> DataFrame:
    """MCP server → every tool and model whose name its own name or description holds; tools first.

    Rows of one id and text meet as often as both sides repeat them; without `repeats` they meet once, at their first places.
    """
    servers = entities.filter("entity_type = 'mcp'").select(
        F.col("id").alias("mcp_id"), F.col("pos").alias("mcp_pos"), F.lower(F.concat_ws(" ", "name", F.coalesce("description", F.lit("")))).alias("text")
    )
    named = entities.filter("entity_type in ('tool', 'model')").select(
        F.col("id").alias("tool_id"), F.lower("name").alias("tool_name"), (F.col("pos") + F.when(F.col("entity_type") == "model", 1 << 61).otherwise(0)).alias("tool_pos")
    )
    if not repeats:
        servers, named = _at_first(servers, "mcp_pos"), _at_first(named, "tool_pos")
    met = containment_join(servers, "text", named, "tool_name")
    return _edges(met, F.col("mcp_id"), "integrates_with", F.col("tool_id"), F.col("mcp_pos"), F.col("tool_pos"))


def runs(entities: DataFrame, repeats: bool = True) -> DataFrame:
    """Device → every model of the name that its metadata says it runs; `repeats` as in `integrates_with`."""
    wanted = F.lower(text_of(F.col("metadata"), "runs_model"))
    devices = entities.filter("entity_type = 'device'").select("id", "pos", wanted.alias("wanted")).filter("wanted <> ''")
    models = entities.filter("entity_type = 'model'").select(F.col("id").alias("model_id"), F.col("pos").alias("model_pos"), F.lower("name").alias("wanted"))
    if not repeats:
        devices, models = _at_first(devices, "pos"), _at_first(models, "model_pos")
    return _edges(devices.join(models, "wanted"), F.col("id"), "runs", F.col("model_id"), F.col("pos"), F.col("model_pos"))


def distinct_edges(edges: DataFrame) -> DataFrame:
    """Legal edges, each once, without self-edges, in the order of first occurrence."""
    legal = edges.filter(F.col("relation").isin(*RELATIONS) & (F.col("from") != F.col("to")))
    first = legal.groupBy("from", "relation", "to").agg(F.min(F.struct("kind", "pos_a", "pos_b")).alias("at"))
    return first.orderBy("at").select("from", "relation", "to")


def build_relationships(entities: DataFrame) -> DataFrame:
    """All edges between the given entities. Endpoints are entities of the table by construction.

    Edges are distinct, so rows that repeat an entity are put together before they meet others: pairs grow with the
    edges, not with the product of the repeats.
    """
    parts = [develops(entities), solves(entities), integrates_with(entities, repeats=False), runs(entities, repeats=False)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return distinct_edges(whole)
