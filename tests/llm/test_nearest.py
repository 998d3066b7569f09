"""The hash-prefix forest on few, extreme and structured vectors."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from entityforge.llm import nearest


def found_by(spark, rows, k=5, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = defaultdict(list)
    for r in sorted(nearest.search(df, F.col("vec_id") % 50 == 0, k, **options).collect(), key=lambda r: (r["query_id"], r["rank"])):
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def test_as_many_as_there_are(spark):
    """One near row does not stand for five: the ascent counts distinct rows."""
    rows = [(0, [1.0, 0.01, 0.0]), (1, [1.0, 0.0, 0.0])] + [(i, [-1.0, 0.1 * i, -0.3]) for i in range(2, 9)]
    found = found_by(spark, rows)
    assert len(found[0]) == 5 and found[0][0][0] == 1
    assert [i for i, _ in found_by(spark, rows[:4])[0]] == [1, 3, 2] and found_by(spark, rows[:1]) == {}


def test_large_and_small_components(spark):
    rows = [(0, [1e200, 2e200]), (1, [2e200, 4e200]), (2, [1e-200, 2e-200]), (3, [5e-324, 1e-323]), (4, [-1e300, 1e300]), (5, [1.7e308, 1.7e308])]
    got = found_by(spark, rows)[0]
    assert {i for i, _ in got[:3]} == {1, 2, 3} and [i for i, _ in got[3:]] == [5, 4]
    assert [s for _, s in got] == pytest.approx([1, 1, 1, 3 / math.sqrt(10), 1 / math.sqrt(10)], abs=1e-12)


def clusters(n, seed):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((n // 40, 32))
    return centre[np.arange(n) % len(centre)] + 0.2 * rng.standard_normal((n, 32))


@pytest.mark.parametrize("block_rows", [100, 100_000])
def test_recall_over_many_blocks(spark, monkeypatch, block_rows):
    monkeypatch.setattr(nearest, "LEAST_BLOCK", 50)
    x = np.concatenate([clusters(1200, 1), np.random.default_rng(2).standard_normal((300, 32))])
    found = found_by(spark, [(i, v.tolist()) for i, v in enumerate(x)], block_rows=block_rows)
    unit = x / np.sqrt((x * x).sum(axis=1))[:, None]
    hits = 0
    for q, got in found.items():
        score = unit @ unit[q]
        score[q] = -2
        hits += len({i for i, _ in got} & set(np.argsort(-score)[:5].tolist()))
        assert [s for _, s in got] == pytest.approx([score[i] for i, _ in got], abs=1e-12)
    assert len(found) == 30 and all(len(v) == 5 for v in found.values()) and hits >= 0.93 * 150


def test_structure_spares_comparisons():
    """On clusters a query meets a small part of the block, and a smaller one of a larger block."""
    share = []
    for n in (2000, 16000):
        x = clusters(n, 3)
        forest = nearest.Forest(x)
        unit = x / np.sqrt((x * x).sum(axis=1))[:, None]
        hits = 0
        for q, (rows, _) in zip(range(60), forest.nearest(x[:60], 6)):
            hits += len(set(rows.tolist()) & set(np.argsort(-(unit @ unit[q]))[:6].tolist()))
        assert hits >= 0.95 * 360
        share.append(forest.compared / 60 / n)
    assert share[1] < share[0] / 2 and share[1] < 0.05


def test_prefixes_cut_what_is_too_large():
    x = clusters(3000, 4)
    codes, n = np.unique(nearest.Prefixes({}, 32, 1).codes(x), return_counts=True)
    tree = nearest.Prefixes(dict(zip(codes.tolist(), n.tolist())), 32, 200)
    size = defaultdict(int)
    for code, k in zip(codes.tolist(), n.tolist()):
        size[tree.leaf(code)] += k
    assert sum(size.values()) == 3000 and set(size) == set(tree.blocks)
    assert all(len(tree.blocks[leaf]) == -(-k // 200) for leaf, k in size.items())
    assert len({length for length, _ in tree.blocks}) > 1
    margins = tree.margins(x[:1])[0]
    assert sorted(tree.blocks_for(margins, nearest.NO_BOUND, 0.9, [])) == list(range(tree.n))
    assert set(tree.blocks_for(margins, 0.99, 0.5, [])) <= set(tree.blocks_for(margins, 0.9, 0.95, []))
