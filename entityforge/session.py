"""Session settings that the engine's results depend on."""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings that change results, not speed, and the one without which connectors cannot be read; every plan of the engine assumes them.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.python.filterPushdown.enabled": "true",
}


def build_session(name: str = "entityforge", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's settings; `master` and `conf` only where no cluster sets them."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = SEMANTICS | {"spark.sql.adaptive.enabled": "true", "spark.ui.enabled": "false"} | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin(spark: SparkSession) -> SparkSession:
    """Sets the settings that results depend on, for a session that someone else made."""
    for key, value in SEMANTICS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def pinned(spark: SparkSession) -> Iterator[SparkSession]:
    """The settings that results depend on, put back at the end."""
    before = {key: spark.conf.get(key, None) for key in SEMANTICS}
    try:
        yield pin(spark)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's `spark.checkpoint.dir`; a temporary folder where that is unset and all runs in one process, as in tests."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = f"file://{tempfile.mkdtemp(prefix='entityforge-')}"
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared)
    return shared.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """`df` computed once and kept in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def local_session(cores: int | None = None) -> SparkSession:
    """The session of tests and bench.py."""
    n = cores or int(os.environ.get("BENCH_CPUS", "8"))
    return build_session(
        master=f"local[{n}]", **{"spark.sql.shuffle.partitions": str(n), "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    )
