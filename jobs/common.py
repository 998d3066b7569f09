"""What the jobs' command lines share."""

from __future__ import annotations

import argparse
import json
import logging
import os
from collections.abc import Callable

from pyspark.sql import SparkSession

from entityforge.session import build_session


def load_config(name: str, path: str | None = None) -> dict:
    """The job's config: that of `path` over the file `<name>.json` beside the job."""
    files = [os.path.join(os.path.dirname(os.path.abspath(__file__)), f"{name}.json"), *([path] if path else [])]
    config: dict = {}
    for file in files:
        with open(file, encoding="utf-8") as text:
            config |= json.load(text)
    return config


def main(name: str, about: str, paths: dict[str, str], job: Callable[..., object], argv: list[str] | None = None) -> None:
    """Parses plain path arguments, makes a session, runs `job(spark, config=..., **paths)` and stops the session."""
    parser = argparse.ArgumentParser(prog=f"jobs.{name}", description=about)
    for key, text in paths.items():
        parser.add_argument(f"--{key}", required=True, help=text)
    parser.add_argument("--config", help=f"a JSON file with settings that replace those of {name}.json")
    given = vars(parser.parse_args(argv))
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    config = load_config(name, given.pop("config"))
    spark: SparkSession = build_session(f"entityforge {name}", **{"spark.ui.showConsoleProgress": "false"})
    try:
        job(spark, config=config, **given)
    finally:
        spark.stop()
