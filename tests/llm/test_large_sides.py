"""Tables beyond the checked size of a broadcast take the shuffled plans, with the same results."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from entityforge.llm import components, jaccard, mixing, scratch, warc
from entityforge.llm.scratch import Scratch


@pytest.fixture(autouse=True)
def nothing_is_small(spark, monkeypatch):
    monkeypatch.setattr(scratch, "SMALL_ROWS", -1)
    monkeypatch.setattr(components, "ONE_TASK_EDGES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def texts(n, seed):
    rng = random.Random(seed)
    for g in range(n):
        base = [f"g{g}w{i}" for i in range(40)]
        for _ in range(6):
            own = list(base)
            for _ in range(rng.randint(0, 2)):
                own[rng.randrange(40)] = f"x{rng.randrange(99)}"
            yield " ".join(own)


def components_of(rows):
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in rows)}
    root = {i: i for i in sets}
    for _ in range(len(sets)):
        moved = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both) and root[a] < root[b]:
                    root[b], moved = root[a], True
        if not moved:
            return root


@pytest.mark.parametrize("busy", [1 << 17, 2])
def test_jaccard(spark, monkeypatch, busy):
    """With few pairs of a set already too many for one task, and without."""
    monkeypatch.setattr(jaccard, "BUSY_PAIRS", busy)
    monkeypatch.setattr(jaccard, "TASK_PAIRS", 2 if busy == 2 else 2048)
    rows = list(enumerate(texts(8, 1)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = components_of(rows)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.similar_components(docs).collect()}
    assert got == want
    kept = {r["doc_id"] for r in corpus_pipeline.near_copies_stage(spark, docs, "").collect()}
    assert kept == set(want.values())


def test_pairs_of_one_set_are_dealt_to_many_tasks(spark, monkeypatch):
    """One set is in 9 of 10 pairs: all overlaps are right, and no task of a shuffle by set counts more than its bound."""
    monkeypatch.setattr(jaccard, "BUSY_PAIRS", 20)
    monkeypatch.setattr(jaccard, "TASK_PAIRS", 16)
    base = [f"w{i}" for i in range(30)]
    docs = [(k, " ".join(base[: 10 + k % 20] + [f"own{k}"] * (k > 0))) for k in range(200)] + [(200 + k, f"a{k} b c d e f{k}") for k in range(20)]
    place = Scratch(spark, "busy")
    all_rows, rows, _, clashing = jaccard._scanned(place, spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text")
    sets = place.write(rows.groupBy("set", "n", "least").agg(F.min("key").alias("key")), "sets")
    of = {r["doc"]: r["set"] for r in rows.collect()}
    pairs = [(of[0], of[k]) for k in range(1, 100)] + [(of[k], of[0]) for k in range(100, 200)] + [(of[200 + k], of[201 + k]) for k in range(19)]
    got = jaccard._Sets(place, all_rows, sets, clashing).overlaps(spark.createDataFrame(pairs, "x long, y long"), "t").collect()
    tokens = {of[k]: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for k, t in docs}
    want = [(x, y, len(tokens[x]), len(tokens[y]), len(tokens[x] & tokens[y])) for x, y in pairs]
    assert Counter(map(tuple, got)) == Counter(want)


def test_mixing(spark):
    rows = [(i % 50, f"{'w ' * (1 + i % 9)}", f"s{i % 5}" if i % 7 else None) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix_sources(docs)
    repeated = Counter(map(tuple, mixing.repeat_rows(docs, mixed).collect()))
    assert sum(repeated.values()) == sum(r["copies"] for r in mixed.collect()) and set(repeated) <= set(rows)


def test_warc(spark):
    pages = [(i % 25, f"u{i % 25}", f"p{i % 4}") for i in range(40)]
    place = Scratch(spark, "large_warc")
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string"), place.path("a"))
    captures = warc.assemble(warc.read_archives(spark, place.path("a"))).select(F.col("metadata.page_id").alias("page"), "main.type", "main.payload_digest").collect()
    assert Counter(c["page"] for c in captures) == Counter(i for i, _, _ in pages)
    responses = [(c["payload_digest"], c["page"]) for c in captures if c["type"] == "response"]
    assert len(responses) == len({d for d, _ in responses}) == 4
