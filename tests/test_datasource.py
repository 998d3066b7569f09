"""Connectors as data sources, offline."""

from __future__ import annotations

import io
import json
import sys
from contextlib import redirect_stdout
from urllib.parse import parse_qs, urlsplit

from pyspark import cloudpickle
from pyspark.sql import functions as F

from entityforge.sources import connectors
from entityforge.sources.datasource import SearchReader
from entityforge.sources.http import Answer

# workers do not import test modules
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def opener_of(folder):
    """Answers repository searches with two items of the query's name, and leaves a file for each request; one query fails."""

    def opener(url, headers, timeout):
        import os
        import uuid

        query = parse_qs(urlsplit(url).query).get("q", [url])[0]
        with open(os.path.join(folder, uuid.uuid4().hex), "w", encoding="utf-8") as f:
            f.write(query)
        if query == "none":
            return Answer(404)
        return Answer(200, json.dumps({"items": [{"full_name": f"{query}/{k}", "stargazers_count": 9 - k} for k in range(3)]}).encode())

    return opener


def asked(folder):
    return sorted(p.read_text() for p in folder.iterdir())


def test_a_task_per_query(spark, tmp_path):
    queries = [f"q{k}" for k in range(9)] + ["none"]
    found = connectors.scan_repositories(spark, queries, 2, opener_of(str(tmp_path)))
    assert found.rdd.getNumPartitions() == len(queries)
    rows = found.withColumn("task", F.spark_partition_id()).collect()
    assert {(r["_query"], r["_item"], r["full_name"]) for r in rows} == {(k, i, f"q{k}/{i}") for k in range(9) for i in range(2)}
    assert all(len({r["task"] for r in rows if r["_query"] == k}) == 1 for k in range(9)) and len({r["task"] for r in rows}) == 9
    assert asked(tmp_path) == sorted(queries)


def test_filters_leave_queries_unasked(spark, tmp_path):
    connectors.register(spark, opener_of(str(tmp_path)))
    rows = spark.read.format(connectors.REPOSITORIES).option("queries", json.dumps(["a", "b", "c"])).option("limit", 1).load()
    picked = rows.filter((F.col("query") == "b") & (F.col("_item") >= 0))
    said = io.StringIO()
    with redirect_stdout(said):
        picked.explain("formatted")
    assert "EqualTo(query,b)" in said.getvalue()
    assert [(r["_query"], r["query"], json.loads(r["raw"])["full_name"]) for r in picked.collect()] == [(1, "b", "b/0")]
    assert set(asked(tmp_path)) == {"b"}
    assert {r["query"] for r in rows.filter(F.col("query").isin("a", "c")).collect()} == {"a", "c"}
    assert set(asked(tmp_path)) == {"a", "b", "c"}
    assert rows.filter("query = 'x'").count() == 0 and spark.read.format(connectors.REPOSITORIES).load().count() == 0


def test_reader_gives_back_what_it_cannot_filter():
    from pyspark.sql.datasource import EqualTo, GreaterThan, In

    reader = SearchReader(["a", "b", "c"], {}, lambda q, o: [])
    other = [GreaterThan(("query",), "a"), EqualTo(("_item",), 1)]
    assert list(reader.pushFilters([*other, In(("query",), ("a", "b"))])) == other
    assert [p.query for p in reader.partitions()] == ["a", "b"]
