"""Names in texts: first matches, both plans, and texts of very many characters."""

from __future__ import annotations

import random
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from entityforge.operators import containment, relationships

# workers do not import test modules
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def first_match(owners, companies):
    """The first company, by pos and id, of either direction."""
    out = {}
    for owner in owners:
        for pos, id_, name in sorted(companies):
            if name.lower() in owner.lower() or owner.lower() in name.lower():
                out[owner] = id_
                break
    return out


@pytest.mark.parametrize("limit", [50_000, 20, 0])
@pytest.mark.parametrize("seed", range(3))
def test_first_containing_like_brute_force(spark, monkeypatch, limit, seed):
    """Few letters, so that names hold one another; ties of pos, repeated names, an empty name and one of one letter."""
    monkeypatch.setattr(containment, "NAMES", limit)
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abAB漢") for _ in range(n))
    companies = [(rng.randrange(30), f"c{k:02}", word(rng.choice([1, 2, 3, 5, 8]))) for k in range(40)] + ([(29, "c98", "")] if seed == 2 else [])
    owners = [word(rng.choice([1, 2, 4, 7])) for _ in range(60)] + ["zzz", "zabz"]
    rows = spark.createDataFrame([(i, o) for i, o in enumerate(owners)] + [(99, None)], "k int, owner string")
    table = spark.createDataFrame(companies + [(0, "c99", None)], "pos bigint, id string, name string")
    got = relationships.first_containing(rows, "owner", table)
    assert {r["owner"]: r["company_id"] for r in got.collect()} == first_match(owners, companies)


def test_match_step_answers_once_per_owner(spark):
    """A name of one letter that all owners hold, and an owner that all names hold, make no more rows."""
    names = [f"name {k} a" for k in range(500)] + ["a"]
    texts = spark.createDataFrame([(f"{'a' * 50} owner {k}",) for k in range(300)], "t string").repartition(3)
    assert texts.select(containment.first_name_in(names)(F.col("t")).alias("p")).groupBy("p").count().collect()[0].asDict() == {"p": 500, "count": 300}
    companies = spark.createDataFrame([(k, f"c{k}", n) for k, n in enumerate(names)], "pos bigint, id string, name string").repartition(3)
    around = containment.first_text_around(companies, "name", ["a", "e 7 a", "none"]).collect()
    assert len(around) <= 3 * 2 and min((r["pos"], r["id"]) for r in around if r["place"] == 0) == (0, "c0")
    assert {(r["pos"], r["id"]) for r in around if r["place"] == 1} == {(7, "c7")}
    assert containment.first_text_around(companies, "name", ["none"]).collect() == [] == containment.first_text_around(companies.limit(0), "name", []).collect()


def test_random_texts_by_grams(spark):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abc 漢😀") for _ in range(n))
    texts, names = [word(rng.randrange(40)) for _ in range(200)], sorted({word(rng.randrange(1, 6)) for _ in range(150)} | {""})
    left, right = spark.createDataFrame(list(enumerate(texts)), "k int, t string"), spark.createDataFrame([(n,) for n in names], "n string")
    got = sorted((r["k"], r["n"]) for r in containment._by_rarest_gram(left, "t", right, "n").collect())
    assert got == sorted((k, n) for k, t in enumerate(texts) for n in names if n in t)


def test_time_per_character_is_flat(spark):
    """A text of ten million characters is turned into grams in seconds, at the rate of a short one, and matched."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(5000)]
    rates = []
    for n in (100_000, 10_000_000):
        text = " ".join(rng.choice(words) for _ in range(n // 8))
        began = time.process_time()
        containment._grams(text)
        rates.append((time.process_time() - began) / n)
    assert rates[1] < 4 * rates[0] + 1e-7
    left = spark.createDataFrame([(1, text), (2, words[0])], "k int, t string")
    right = spark.createDataFrame([(w,) for w in words[:2000]] + [("not there",)], "n string")
    began = time.time()
    got = containment._by_rarest_gram(left, "t", right, "n").groupBy("k").count().collect()
    assert {r["k"]: r["count"] for r in got} == {1: sum(w in text for w in words[:2000]), 2: 1}
    assert time.time() - began < 120
