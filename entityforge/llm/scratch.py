"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The cluster's `spark.checkpoint.dir`; where it is unset and all runs in one process (tests), a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='entityforge-')}"
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


class Scratch:
    """Written intermediate tables of one operator call.

    A written table cuts the lineage: a lost executor costs only the tasks that reread it.
    Tables that no returned DataFrame reads are removed with `drop`; all others live as long
    as the shared folder's owner keeps them (`spark.checkpoint.dir` is transient by contract).
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        self.written: list[str] = []
        #: Partitions of the call's large shuffles; an operator that knows its volume asks for more.
        self.parts = partitions_for(spark)

    def path(self, name: str) -> str:
        """Where the table or folder `name` of this call is."""
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Writes `df` as Parquet, one file a task, and returns the reread table."""
        df.write.option("compression", "zstd").option("maxRecordsPerFile", 0).parquet(self.path(name))
        self.written.append(name)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def size(self, name: str) -> int:
        """Bytes of a written table."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()

    def partitions(self, *written: str) -> int:
        """Shuffle partitions for these tables: what the session has, or more if they are large."""
        return max(partitions_for(self.spark), -(-sum(map(self.size, written)) // PARTITION_BYTES))

    def keep_only(self, *names: str) -> None:
        """Deletes all other tables; no returned DataFrame may read them."""
        self.drop(*(n for n in self.written if n not in names))

    def drop(self, *names: str) -> None:
        """Deletes tables through the file system that holds them."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
            self.written = [n for n in self.written if n != name]


#: Rows of a few numbers each up to which a table is broadcast, some 8 MB.
SMALL_ROWS = 100_000


def is_small(df: DataFrame) -> bool:
    """Whether a written table has few rows, by count."""
    return df.count() <= SMALL_ROWS


def small_or_shuffled(df: DataFrame) -> DataFrame:
    """`df`, a written table, with a broadcast hint if its counted rows are few; else it is joined by
    shuffle, where skewed keys are split at run time."""
    return F.broadcast(df) if is_small(df) else df


#: Written, compressed bytes that one partition of a shuffle takes about.
PARTITION_BYTES = 32 << 20


def partitions_for(spark: SparkSession) -> int:
    """Shuffle partitions of the session, at least the cores it has."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
