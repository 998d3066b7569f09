"""An archive of feed entries that grows with its feeds: every run takes only files that are new.

Documents are entries of the feed that their source names. Entries are cleaned, given a canonical link and an id,
tagged with tasks and validated. The same text is archived once, however many feeds carry it and in whatever
run it comes: the first batch that has it keeps it, and within a batch the smallest doc_id.

The output is partitioned by batch, status (archived, rejected) and source. A stream's checkpoint knows which files
were taken. A batch that is run again, since a run ended between its writing and its mark, replaces its own
partition and looks only at earlier ones, so it writes what it wrote before.

    python -m jobs.archive_feeds --documents DIR --out DIR --checkpoint DIR
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityforge.functions.text import first_line
from entityforge.operators import classify, clean, validate
from entityforge.schema import TASKS, make_entities, metadata_of
from entityforge.session import pinned
from jobs.common import load_config, main

log = logging.getLogger(__name__)

NAME = "archive_feeds"
ENTRY = "doc_id bigint, text string, lang string, source string"
COLUMNS = "doc_id bigint, id string, name string, description string, url string, lang string, tasks string, issues string, digest string, batch bigint, status string, source string"


def entries(documents: DataFrame, config: dict) -> DataFrame:
    """Documents as news entries with a digest of their cleaned text."""
    tasks = {slug: tuple(words) for slug, words in (config["tasks"] or TASKS).items()}
    feed = F.coalesce(F.nullif("source", F.lit("")), F.lit("unknown"))
    link = F.concat(F.lit(f"http://www.{config['feed_host']}/"), feed, F.lit("/"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("?utm_source=rss#entry"))
    made = make_entities(documents, F.lit("news"), first_line("text"), F.col("text"), link, F.array(F.lit("News")), feed, F.lit(""), metadata_of(lang=F.col("lang")), F.col("doc_id"))
    checked = validate.with_issues(classify.tag_tasks(clean.normalize_urls(clean.clean_entities(made)), tasks))
    slugs = F.try_variant_get(F.try_element_at("metadata", F.lit("related_tasks")), "$", "array<string>")
    return checked.select(
        F.sha2(F.lower("description"), 256).alias("digest"),
        F.col("pos").alias("doc_id"), F.col("source.name").alias("source"), "id", "name", "description", "url", classify.text_of(F.col("metadata"), "lang").alias("lang"),
        F.coalesce(F.array_join(slugs, "; "), F.lit("")).alias("tasks"), F.array_join("issues", "; ").alias("issues"),
        F.when(F.size("issues") == 0, "archived").otherwise("rejected").alias("status"),
    )


def _watched(spark: SparkSession, path: str) -> str:
    """`path` as a stream takes it: a folder as it is, a single file as a pattern that it alone matches."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    single = place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isFile()
    return f"{path[:-1]}[{path[-1]}]" if single else path


def read_archive(spark: SparkSession, out: str) -> DataFrame:
    """All batches; before the first one, no rows."""
    path = spark._jvm.org.apache.hadoop.fs.Path(out)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], COLUMNS)
    return spark.read.schema(COLUMNS).parquet(out)


def archive_batch(batch: DataFrame, number: int, out: str, config: dict) -> dict[str, int]:
    """Writes what is new in a batch as partition `number`."""
    spark = batch.sparkSession
    found = entries(batch, config)
    rest = [c for c in found.columns if c != "digest"]
    # least doc_id of each text, before texts are shuffled as well as after
    first = found.groupBy("digest").agg(F.min(F.struct(*rest)).alias("e")).select("digest", "e.*")
    known = read_archive(spark, out).filter(F.col("batch") < number).select("digest")
    fresh = first.join(known, "digest", "left_anti")
    # files by partition, large ones split and small ones put together
    fresh.hint("rebalance", "status", "source").write.mode("overwrite").partitionBy("status", "source").parquet(f"{out}/batch={number}")
    # counts of rows of files and folders, which read no text
    made = read_archive(spark, out).filter(F.col("batch") == number).agg(F.count(F.lit(1)).alias("written"), F.count_if(F.col("status") == "rejected").alias("rejected"))
    return {"read": batch.count(), **made.first().asDict()}


def archive_feeds(spark: SparkSession, documents: str, out: str, checkpoint: str, config: dict | None = None) -> dict[str, int]:
    """Archives the files of `documents` that no earlier run with this checkpoint took; waits for the end and returns what was read and written."""
    config = load_config(NAME) if config is None else config
    total = {"batches": 0, "read": 0, "written": 0, "rejected": 0}

    def each(batch: DataFrame, number: int) -> None:
        counts = archive_batch(batch, number, out, config)
        log.info("batch %s: read %s entries from %s, wrote %s, of which %s are rejected, to %s", number, counts["read"], documents, counts["written"], counts["rejected"], out)
        for key, n in {"batches": 1, **counts}.items():
            total[key] += n

    with pinned(spark):
        stream = spark.readStream.schema(ENTRY).option("maxFilesPerTrigger", config["files_per_batch"]).parquet(_watched(spark, documents))
        query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    log.info("took %s batches, read %s entries, wrote %s to %s", total["batches"], total["read"], total["written"], out)
    return total


if __name__ == "__main__":
    main(NAME, __doc__.partition("\n")[0], {"documents": "folder of files of entries", "out": "folder of the archive", "checkpoint": "folder of the stream's checkpoint"}, archive_feeds)
