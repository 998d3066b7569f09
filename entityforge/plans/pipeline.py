"""The whole catalog run: fetch, clean, resolve, classify, enrich, validate, relate, export, report."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from entityforge.operators import classify, clean, dedupe, describe, logos, relationships, report, sinks, validate
from entityforge.session import cut_lineage, pin
from entityforge.sources import connectors

log = logging.getLogger(__name__)

#: Most rows that the driver streams into one file.
ARRAY_ROWS = 100_000


@dataclass
class PipelineConfig:
    """What a run does. Clients are None by default: then nothing is fetched or rewritten."""

    modules: list[str] = field(default_factory=list)
    limit: int = 30
    seed_dir: str = "seeds"
    out_dir: str = "out"
    opener: Callable = connectors.open_url
    logo_client: Callable | None = None
    describe_client: Callable | None = None
    #: Where answers are kept from run to run, and how many calls a minute are made at most.
    describe_ledger: str | None = None
    describe_per_minute: float | None = None
    now: Column | None = None
    recent_days: int = 30
    domain_key: bool = True
    exempt_hosts: tuple[str, ...] = ()
    #: JSON arrays of the tables and the report, in one file each up to ARRAY_ROWS rows; else folders of JSON lines.
    json_arrays: bool = False


@dataclass
class Result:
    """Tables of a run, and how many records each step left."""

    entities: DataFrame
    edges: DataFrame
    report: DataFrame
    issues: DataFrame
    counts: dict[str, int] = field(default_factory=dict)


class Counted(NamedTuple):
    """A table whose lineage is cut, and numbers of its rows."""

    table: DataFrame
    n: dict[str, int]


def counted(df: DataFrame, **numbers: Column) -> Counted:
    """`df` computed once, and how many of its rows hold each condition, observed as they are written: no job of its own."""
    seen = Observation()
    table = cut_lineage(df.observe(seen, *[F.count_if(c).alias(name) for name, c in numbers.items()]))
    # a plan found to be empty while it ran observes nothing
    return Counted(table, dict.fromkeys(numbers, 0) | seen.get)


def union_modules(spark: SparkSession, config: PipelineConfig) -> DataFrame:
    """Entities of all modules; `pos` says in which order they came."""
    parts = [connectors.fetch_module(spark, m, config.limit, config.seed_dir, config.opener, i) for i, m in enumerate(config.modules)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def process(raw: DataFrame, config: PipelineConfig) -> Result:
    """All steps after fetching. The ids stay those of the raw values."""
    spark = pin(raw.sparkSession)
    now = config.now if config.now is not None else F.current_timestamp()
    raw = counted(raw, discovered=F.lit(True))  # remote answers are asked for once
    resolved = counted(dedupe.dedupe(clean.normalize_urls(clean.clean_entities(raw.table)), config.domain_key, config.exempt_hosts), kept=F.lit(True))
    tagged = classify.tag_tasks(classify.tag_recency(resolved.table, now, config.recent_days))
    whole = logos.find_logos(tagged, config.logo_client).unionByName(classify.task_entities(spark))
    written = describe.describe_all(whole, config.describe_client, ledger=config.describe_ledger, per_minute=config.describe_per_minute)
    good = F.size("issues") == 0
    checked = counted(validate.with_issues(written), valid=good, invalid=~good)
    valid = checked.table.filter(good).drop("issues")
    issues = checked.table.filter(~good).select("pos", "name", "issues")
    edges = counted(relationships.build_relationships(valid), edges=F.lit(True))
    counts = {"discovered": raw.n["discovered"], "after dedupe": resolved.n["kept"], **checked.n, "relationships": edges.n["edges"]}
    log.info("%s", counts)
    measured = report.quality_report(valid, counts["relationships"], counts["discovered"], counts["after dedupe"], counts["invalid"], now)
    return Result(valid, edges.table, measured, issues, counts)


def export(result: Result, out_dir: str, json_arrays: bool = False) -> None:
    """Writes entities, edges, CSV and report under `out_dir`, over what was there.

    An array of more than ARRAY_ROWS rows is a folder `*.json.parts`, whose files by name are the document.
    """
    if json_arrays:
        for rows, name, n, order in ((result.entities, "entities", "valid", ["pos"]), (result.edges, "relationships", "relationships", ["from", "relation", "to"])):
            if result.counts.get(n, ARRAY_ROWS + 1) > ARRAY_ROWS:
                sinks.write_json_parts(rows, f"{out_dir}/{name}.json.parts", order)
            else:
                sinks.write_json_array(rows, f"{out_dir}/{name}.json")
        sinks.write_report_file(result.report, f"{out_dir}/quality_report.json")
    else:
        sinks.write_json(result.entities, result.edges, f"{out_dir}/entities", f"{out_dir}/relationships")
        sinks.write_report(result.report, f"{out_dir}/quality_report")
    sinks.write_csv(result.entities, f"{out_dir}/dataset_csv")


def run(spark: SparkSession, config: PipelineConfig) -> Result:
    """Fetches, processes and exports."""
    result = process(union_modules(pin(spark), config), config)
    export(result, config.out_dir, config.json_arrays)
    return result
