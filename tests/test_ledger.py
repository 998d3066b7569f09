"""Enrichment that is resumed: answers are kept, failures are told and asked again, calls keep to a rate."""

from __future__ import annotations

import os
import sys
import uuid

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from entityforge.operators import describe
from entityforge.schema import make_entities

# workers do not import test modules
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def entities(spark, n, about="short text"):
    rows = spark.range(n).withColumn("name", F.concat(F.lit("n"), "id"))
    return make_entities(rows, F.lit("tool"), F.col("name"), F.lit(about), F.lit(""), F.array(F.lit("T")), F.lit("s"), F.lit(""), None, F.col("id"))


def client_of(folder, dies_at=None, refuses=""):
    """Counts calls as files of a folder; ends its task at a call, and refuses names that start with `refuses`."""

    def client():
        def ask(prompt):
            if dies_at is not None and len(os.listdir(folder)) >= dies_at:
                raise SystemExit("killed")
            with open(os.path.join(folder, uuid.uuid4().hex), "w", encoding="utf-8") as f:
                f.write(prompt)
            name = prompt.partition("Name: ")[2].partition("\n")[0]
            if refuses and name.startswith(refuses):
                raise OSError("refused")
            return f"about {name}"

        return ask

    return client


def test_a_run_that_was_killed_is_resumed(spark, tmp_path):
    calls, ledger = tmp_path / "calls", str(tmp_path / "ledger")
    calls.mkdir()
    rows = entities(spark, 100)
    with pytest.raises(Exception):  # noqa: B017, PT011
        describe.describe_all(rows, client_of(str(calls), 50), ledger=ledger, batch_rows=10)
    assert len(list(calls.iterdir())) == 50 and describe.read_ledger(spark, ledger).count() == 50
    done = describe.describe_all(rows, client_of(str(calls)), ledger=ledger, batch_rows=10)
    assert {r["name"]: r["description"] for r in done.collect()} == {f"n{k}": f"about n{k}" for k in range(100)}
    assert len(list(calls.iterdir())) == 100
    again = describe.describe_all(rows, client_of(str(calls)), ledger=ledger)
    assert again.filter("description like 'about %'").count() == 100 and len(list(calls.iterdir())) == 100


def test_a_lost_batch_repeats_its_own_calls_alone(spark, tmp_path):
    calls, ledger = tmp_path / "calls", str(tmp_path / "ledger")
    calls.mkdir()
    rows = entities(spark, 40)
    with pytest.raises(Exception):  # noqa: B017, PT011
        describe.describe_all(rows, client_of(str(calls), 25), ledger=ledger, batch_rows=10)
    assert describe.read_ledger(spark, ledger).count() == 20
    describe.describe_all(rows, client_of(str(calls)), ledger=ledger, batch_rows=10)
    assert len(list(calls.iterdir())) == 45


def test_failures_have_reasons_and_are_asked_again(spark, tmp_path):
    calls, ledger = tmp_path / "calls", str(tmp_path / "ledger")
    calls.mkdir()
    rows = entities(spark, 12)
    first = describe.describe_all(rows, client_of(str(calls), refuses="n1"), 2, ledger, 5)
    failed = {"n1", "n10", "n11"}
    assert {r["name"] for r in first.filter("description = 'short text'").collect()} == failed
    assert [r["reason"] for r in describe.read_ledger(spark, ledger).filter("answer is null").collect()] == ["OSError: refused"] * 3
    assert len(list(calls.iterdir())) == 12
    second = describe.describe_all(rows, client_of(str(calls)), 2, ledger, 5)
    assert second.filter("description = 'short text'").count() == 0 and len(list(calls.iterdir())) == 15
    # another prompt is another question
    describe.describe_all(entities(spark, 2, "other text"), client_of(str(calls)), 2, ledger, 5)
    assert len(list(calls.iterdir())) == 17


def test_rows_that_repeat_are_asked_once(spark, tmp_path):
    rows = entities(spark, 3)
    calls = tmp_path / "calls"
    calls.mkdir()
    made = describe.describe_all(rows.unionByName(rows).unionByName(entities(spark, 1, "")), client_of(str(calls)))
    assert sorted(r["description"] for r in made.collect()) == ["", "about n0", "about n0", "about n1", "about n1", "about n2", "about n2"]
    assert len(list(calls.iterdir())) == 3


def test_token_bucket_keeps_to_its_rate():
    now = [0.0]
    bucket = describe.TokenBucket(2.0, 3, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
    at = []
    for _ in range(9):
        bucket.take()
        at.append(now[0])
    assert at == [0, 0, 0, 0.5, 1.0, 1.5, 2.0, 2.5, 3.0]
    describe.TokenBucket(None).take()
