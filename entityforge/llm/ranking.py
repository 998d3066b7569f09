"""Global order by two-level prefix sums, with built-in functions only.

A table is range-partitioned, sorted and written once. File number and row index then name
each row's place for good, so that per-partition totals and in-partition running sums, though
computed by separate jobs, speak of the same rows. No task sees more than one partition; the
prefix over partitions reads one row per file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityforge.llm.scratch import Scratch


def ordered_table(scratch: Scratch, df: DataFrame, order: list[str], name: str) -> DataFrame:
    """`df` written in the order of `order`, with `part` and `row` (place of each row).

    A random salt is the last range key: rows that agree in all of `order` spread over partitions.
    Such ties have no defined order among themselves. Range bounds are sampled by a job of their own,
    so `df` is written before, lest it be computed twice.
    """
    raw = scratch.write(df, f"{name}_raw")
    n = scratch.partitions(f"{name}_raw")
    salted = raw.withColumn("_salt", F.rand(7))
    keys = [F.col(c).asc_nulls_first() for c in order]
    laid = salted.repartitionByRange(n, *keys, F.col("_salt")).sortWithinPartitions(*keys, F.col("_salt"))
    table = scratch.write(laid, name)
    scratch.drop(f"{name}_raw")
    file_no = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    return table.select(*df.columns, file_no.alias("part"), F.col("_metadata.row_index").alias("row"))


def with_prefix(table: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Adds, for each of `sums`, the total over all rows before this one, and the grand total as `<name>_all`.

    `table` comes from `ordered_table`. Null values count as 0.
    """
    values = {k: F.coalesce(v, F.lit(0)).cast("long") for k, v in sums.items()}
    per_part = table.groupBy("part").agg(*[F.sum(v).alias(k) for k, v in values.items()])
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = per_part.select(
        F.col("part"),
        *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"_off_{k}") for k in values],
        *[F.sum(k).over(everywhere).alias(f"{k}_all") for k in values],
    )
    within = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    local = table.select("*", *[F.coalesce(F.sum(v).over(within), F.lit(0)).alias(f"_loc_{k}") for k, v in values.items()])
    # one row per written file: bounded by the partition count, not by the data
    joined = local.join(F.broadcast(offsets), "part")
    kept = [c for c in table.columns if c not in ("part", "row")]
    return joined.select(
        *kept,
        *[(F.col(f"_loc_{k}") + F.col(f"_off_{k}")).alias(k) for k in values],
        *[F.col(f"{k}_all") for k in values],
    )
