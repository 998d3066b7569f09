"""JSON arrays as folders of parts, and pages that repeat an attribute."""

from __future__ import annotations

import glob
import json

import pytest

from entityforge.operators import logos, sinks
from entityforge.plans import pipeline
from entityforge.schema import make_entities


def joined(folder) -> str:
    return "".join(open(f, encoding="utf-8", newline="").read() for f in sorted(glob.glob(f"{folder}/part-*")))


@pytest.mark.parametrize("n, files", [(0, 3), (1, 1), (2, 5), (997, 7)])
def test_parts_are_the_array(spark, tmp_path, n, files):
    rows = spark.createDataFrame([((i * 7919) % 1009, f"é {i}\n", [i, i + 1], {"k": None}) for i in range(n)], "pos long, name string, list array<int>, m map<string,string>").repartition(files)
    sinks.write_json_array(rows, str(tmp_path / "one.json"))
    sinks.write_json_parts(rows, str(tmp_path / "parts"))
    sinks.write_json_parts(rows, str(tmp_path / "parts"))  # again, over what was there
    assert joined(tmp_path / "parts") == (tmp_path / "one.json").read_text(encoding="utf-8") + "\n"


def test_parts_of_ties_and_nulls(spark, tmp_path):
    """A third of all rows in one place, repeated rows, and places that are null: still one array of all rows, in order."""
    given = [(None, "x")] * 40 + [(5, f"v{i % 3}") for i in range(400)] + [(9, "z")] * 30 + [(i, "w") for i in range(10, 700)] + [(700, None)] * 20
    rows = spark.createDataFrame(given, "k long, name string").repartition(6)
    sinks.write_json_parts(rows, str(tmp_path / "ties"), ["k", "name"])
    got = [(r["k"], r["name"]) for r in json.loads(joined(tmp_path / "ties"))]
    order = lambda r: tuple((v is not None, v or 0 if i == 0 else v or "") for i, v in enumerate(r))
    assert got == sorted(given, key=order)


def test_large_arrays_are_written_by_the_tasks(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    base = spark.range(50).withColumn("name", F.concat(F.lit("n"), "id"))
    none = F.lit("")
    entities = make_entities(base, F.lit("tool"), F.col("name"), none, none, F.array(F.lit("T")), F.lit("s"), none, None, F.col("id"))
    edges = base.select(F.col("name").alias("from"), F.lit("solves").alias("relation"), F.concat("name", F.lit("x")).alias("to"))
    result = pipeline.Result(entities.withColumn("logo_url", none), edges, base.limit(1), base.limit(0), {"valid": 50, "relationships": 50})
    pipeline.export(result, str(tmp_path / "small"), True)
    monkeypatch.setattr(pipeline, "ARRAY_ROWS", 49)
    monkeypatch.setattr(sinks, "write_json_array", None)
    pipeline.export(result, str(tmp_path / "large"), True)
    small = json.loads((tmp_path / "small" / "entities.json").read_text())
    assert len(small) == 50 and json.loads(joined(tmp_path / "large" / "entities.json.parts")) == small
    edges_of = lambda text: sorted(map(str, json.loads(text)))
    assert edges_of(joined(tmp_path / "large" / "relationships.json.parts")) == edges_of((tmp_path / "small" / "relationships.json").read_text())


def test_the_last_of_repeated_attributes_counts():
    page = '<link rel="x" rel="icon" href="/a.png" href="/b.png"><link rel="icon" rel="x" href="/c.png"><meta property="og:image" content="/d.png" content="/e.png">'
    assert logos.candidates_of(page, "https://ex.org/") == ["https://ex.org/b.png", "https://ex.org/e.png"]
