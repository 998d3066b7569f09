"""The quality report of one run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quality_report(valid: DataFrame, edges: DataFrame | int, discovered: int, deduped: int, failures: int, now: Column) -> DataFrame:
    """One row with 17 fields. `deduped`: entities after resolution; `edges`, or their number. The three counts that no step measures are 0.

    `valid` is read once: grouping sets count it by type, by source and as a whole, and a few rows are folded. Null
    keys are in no map.
    """
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    slim = valid.select(F.col("entity_type").alias("t"), F.col("source.name").alias("s"), *[blank(c).alias(c) for c in ("description", "url", "logo_url")])
    sets = slim.groupingSets([[F.col("t")], [F.col("s")], []], "t", "s").agg(
        F.grouping_id().alias("g"), F.count("*").alias("n"), F.count_if("description").alias("d"), F.count_if("url").alias("u"), F.count_if("logo_url").alias("l")
    )
    by_type, by_source, all_ = F.col("g") == 1, F.col("g") == 2, F.col("g") == 3
    total = lambda c: F.coalesce(F.max(F.when(all_, F.col(c))), F.lit(0).cast("bigint"))
    map_of = lambda of, key: F.map_from_entries(F.array_sort(F.collect_list(F.when(of & F.col(key).isNotNull(), F.struct(F.col(key).alias("k"), F.col("n"))))))
    row = sets.agg(
        total("n").alias("final_record_count"), *[total(c).alias(c) for c in "dul"], map_of(by_type, "t").alias("by_type"), map_of(by_source, "s").alias("by_source")
    )
    # each side is one row
    row = row.withColumn("edges", F.lit(edges).cast("bigint")) if isinstance(edges, int) else row.crossJoin(edges.agg(F.count("*").alias("edges")))
    big = lambda n: F.lit(n).cast("bigint")
    return row.select(
        big(discovered).alias("total_records_discovered"), big(discovered).alias("total_records_extracted"), big(deduped).alias("records_cleaned"),
        big(discovered - deduped).alias("records_deduplicated"), "final_record_count", F.col("by_type").alias("records_by_entity_type"),
        F.col("d").alias("records_with_missing_descriptions"), F.col("u").alias("records_with_missing_official_urls"), F.col("l").alias("records_with_missing_logos"),
        big(0).alias("invalid_urls"), big(discovered - deduped).alias("duplicate_count"), big(0).alias("duplicate_relationships"),
        big(failures).alias("validation_failures"), big(0).alias("validation_warnings"), F.col("by_source").alias("source_counts"),
        F.struct(F.col("edges").alias("total")).alias("relationship_counts"), F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("timestamp"),
    )
