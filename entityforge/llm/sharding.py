"""Contiguous balanced shards from global byte-size prefix sums. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityforge.llm.ranking import ordered_table, with_prefix
from entityforge.llm.scratch import Scratch


def assign_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Puts every row into one of `shards` contiguous runs of near equal bytes.

    Rows are ordered by id (null first), then size and checksum; the run of a row is the one of
    `shards` equal cuts of the total in which its middle byte falls, so that no run is off the
    equal target by more than the largest row. Sizes are UTF-8 bytes plus 1; a null text has size 1
    and the checksum of an empty one. Repeated rows are kept, each in its own slot; an empty table
    gives no rows. Only the listed columns are read, whatever others there are.

    Returns id_col, size long, text_crc32 long, shard int, slot long (gapless from 0 in each shard).
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    sized = docs.select(
        F.col(id_col).alias("_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"),
    )
    table = ordered_table(Scratch(docs.sparkSession, "shards"), sized, ["_id", "size", "text_crc32"], "sized")
    placed = with_prefix(table, {"_start": F.col("size"), "_rank": F.lit(1)})
    placed = placed.withColumn("shard", F.expr(f"cast(({shards} * (_start * 2 + size)) div (2 * _start_all) as int)"))
    # at most `shards` rows
    first = placed.groupBy("shard").agg(F.min("_rank").alias("_first"))
    return placed.join(F.broadcast(first), "shard").select(
        F.col("_id").alias(id_col), "size", "text_crc32", "shard", (F.col("_rank") - F.col("_first")).alias("slot")
    )
