"""Entity resolution where rows wait for one another in long chains."""

from __future__ import annotations

import random

import pytest

from entityforge.operators import dedupe

DDL = "pos bigint, name_key string, domain_key string"


def sequential(keys):
    """Greedy leaders, one row at a time."""
    names, domains, out = {}, {}, {}
    for pos, name, domain in sorted(keys):
        lead = names.get(name)
        if lead is None and domain is not None:
            lead = domains.get(domain)
        if lead is None:
            lead = names[name] = pos
            if domain is not None:
                domains[domain] = pos
        out[pos] = lead
    return out


def resolved(spark, keys):
    return {r["pos"]: r["leader"] for r in dedupe.assign_leaders(spark.createDataFrame(keys, DDL)).collect()}


@pytest.fixture
def tables(monkeypatch):
    """Counts the tables that lineage is cut at."""
    made, real = [], dedupe.cut_lineage
    monkeypatch.setattr(dedupe, "cut_lineage", lambda df: made.append(1) or real(df))
    return made


def chain(n):
    """Rows that share the name or the domain of the row before, in turn."""
    return [(i, f"n{(i + 1) // 2}", f"d{i // 2}") for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 7, 100_000])
def test_chain_takes_few_tables(spark, tables, n):
    rows = chain(n)
    assert resolved(spark, rows) == sequential(rows)
    assert len(tables) <= 40


def test_chain_of_groups_takes_few_tables(spark, tables):
    """Of three rows under every key, two wait for one another."""
    rows = []
    for g in range(3000):
        # the last row of a group has the first key of the next one
        at, key, other = 10 * g, f"k{g}", f"k{g + 1}"
        own = [(key, None), (key, f"x{g}"), (key, other)] if g % 2 == 0 else [(f"y{g}", key), (f"z{g}", key), (other, key)]
        rows += [(at + k, *pair) for k, pair in enumerate(own)]
    assert resolved(spark, rows) == sequential(rows)
    assert len(tables) <= 60


@pytest.mark.parametrize("plain", [0, 3])
@pytest.mark.parametrize("seed", range(4))
def test_random_tables(spark, monkeypatch, plain, seed):
    monkeypatch.setattr(dedupe, "PLAIN_ROUNDS", plain)
    rng = random.Random(seed)
    kinds = rng.choice([5, 40, 150])
    rows = [(i * 3 - 90, f"n{rng.randrange(kinds)}", rng.choice([None, f"d{rng.randrange(kinds)}"])) for i in range(200)]
    assert resolved(spark, rows) == sequential(rows)
