"""Streams of entities: an upsert by id into a Parquet table, micro-batch by micro-batch.

An extension: a batch run needs none of it. Ids are deterministic, so a replayed batch writes what
it wrote before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def upsert_batch(spark: SparkSession, batch: DataFrame, epoch: int, path: str) -> None:
    """Writes a batch as version `epoch` of its rows; `latest` picks the newest of each id."""
    newest = Window.partitionBy("id").orderBy(F.col("pos").desc())
    rows = batch.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")
    rows.write.mode("overwrite").parquet(f"{path}/epoch={epoch:012d}")


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of every id."""
    rows = spark.read.parquet(path)
    newest = Window.partitionBy("id").orderBy(F.col("epoch").desc())
    return rows.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n", "epoch")


def start(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Starts the upsert of a stream of entities; it takes what is there and ends."""
    spark = stream.sparkSession
    sink = stream.writeStream.foreachBatch(lambda batch, epoch: upsert_batch(spark, batch, epoch, path))
    return sink.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
