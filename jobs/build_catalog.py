"""A snapshot of the entity catalog from crawled pages, documents and parts.

Pages become news, documents repositories, parts tools. All are cleaned, their URLs made canonical, resolved
to entities in ingest order, tagged with tasks and validated. The output is one table, partitioned by status
(valid, rejected) and entity_type. A run replaces the snapshot, so a rerun over the same tables gives the same.

    python -m jobs.build_catalog --pages DIR --documents DIR --parts DIR --out DIR
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from entityforge.functions.text import first_line
from entityforge.operators import classify, clean, dedupe, validate
from entityforge.schema import TASKS, make_entities, metadata_of
from entityforge.session import cut_lineage, pinned
from jobs.common import load_config, main

log = logging.getLogger(__name__)

NAME = "build_catalog"
COLUMNS = "id string, name string, description string, url string, categories string, source string, tasks string, issues string, status string, entity_type string"


def _labels(*labels: object):
    return F.array(*[F.lit(x) if isinstance(x, str) else x for x in labels])


def page_rows(pages: DataFrame, config: dict) -> DataFrame:
    """Pages as news: the title as name, the whole page as description."""
    title = F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)
    return make_entities(pages, F.lit("news"), title, F.col("html"), F.col("url"), _labels("News"), F.lit(config["page_source"]), F.lit(""), None, F.col("page_id"))


def document_rows(documents: DataFrame, config: dict) -> DataFrame:
    """Documents as repositories of their source: the first line as name, the whole text as description."""
    url = F.concat(F.lit(f"https://{config['document_host']}/"), F.col("doc_id"))
    source = F.coalesce("source", F.lit(""))
    return make_entities(
        documents, F.lit("repository"), first_line("text"), F.col("text"), url, _labels("Repositories", source), source, F.lit(""), metadata_of(language=F.col("lang")), F.col("doc_id")
    )


def part_rows(parts: DataFrame, config: dict) -> DataFrame:
    """Parts as tools of their brand."""
    url = F.concat(F.lit(f"https://{config['part_host']}/"), F.col("p_partkey"))
    return make_entities(parts, F.lit("tool"), F.col("p_name"), F.col("p_type"), url, _labels("Parts", F.col("p_brand")), F.lit(config["part_source"]), F.lit(""), None, F.col("p_partkey"))


def build_catalog(spark: SparkSession, pages: str, documents: str, parts: str, out: str, config: dict | None = None) -> dict[str, int]:
    """Reads the three tables, writes the snapshot to `out` and returns what was read and written.

    Rows of different types never resolve to one another, so each table's ids may count from 0; ids must
    be unique in their table. The hosts of documents and parts name no entity: those resolve by name alone.
    """
    config = load_config(NAME) if config is None else config
    tasks = {slug: tuple(words) for slug, words in (config["tasks"] or TASKS).items()}
    with pinned(spark):
        read, rows = {}, None
        for i, (name, path, project) in enumerate((("pages", pages, page_rows), ("documents", documents, document_rows), ("parts", parts, part_rows))):
            read[name] = Observation(name)
            table = spark.read.parquet(path).observe(read[name], F.count(F.lit(1)).alias("n"))
            if name == "parts":
                # narrow rows, of which a small file holds very many: their urls and ids are made by all tasks
                table = table.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
            found = project(table, config).withColumn("pos", F.col("pos") + (i << 56))
            rows = found if rows is None else rows.unionByName(found)
        rows = cut_lineage(clean.normalize_urls(clean.clean_entities(rows)))
        resolved = dedupe.dedupe(rows, exempt=(config["document_host"], config["part_host"]))
        checked = validate.with_issues(classify.tag_tasks(resolved, tasks))
        issues = F.col("issues")
        slugs = F.try_variant_get(F.try_element_at("metadata", F.lit("related_tasks")), "$", "array<string>")
        status = F.when(F.size(issues) == 0, "valid").otherwise("rejected")
        made = checked.select(
            "id", "name", "description", "url", F.array_join("categories", "; ").alias("categories"), F.col("source.name").alias("source"),
            F.coalesce(F.array_join(slugs, "; "), F.lit("")).alias("tasks"), F.array_join(issues, "; ").alias("issues"), status.alias("status"), "entity_type",
        )
        wrote = Observation("written")
        made = made.observe(wrote, F.count(F.lit(1)).alias("written"), F.count_if(F.col("status") == "rejected").alias("rejected"))
        # files by partition, large ones split and small ones put together
        made.hint("rebalance", "status", "entity_type").write.mode("overwrite").partitionBy("status", "entity_type").parquet(out)
        counts = {name: seen.get.get("n", 0) for name, seen in read.items()} | {"written": 0, "rejected": 0} | wrote.get
    log.info("read %s pages from %s, %s documents from %s, %s parts from %s", counts["pages"], pages, counts["documents"], documents, counts["parts"], parts)
    log.info("wrote %s entities, of which %s are rejected, to %s", counts["written"], counts["rejected"], out)
    return counts


def read_catalog(spark: SparkSession, out: str) -> DataFrame:
    """The snapshot."""
    return spark.read.schema(COLUMNS).parquet(out)


if __name__ == "__main__":
    main(NAME, __doc__.partition("\n")[0], {"pages": "table of pages", "documents": "table of documents", "parts": "table of parts", "out": "folder of the snapshot"}, build_catalog)
