"""Decontamination against brute force over all windows, and odd input."""

from __future__ import annotations

import random
import re

import pytest

from entityforge.llm import decontaminate, scratch

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def brute(docs, items):
    """(id, words, hit words, sorted items) of each row, by comparing every window."""
    known = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), 10)
        for k in range(len(w) - n + 1 if n else 0):
            known.setdefault(tuple(w[k : k + n]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, held = words(text), set(), set()
        for n in {len(k) for k in known}:
            for k in range(len(w) - n + 1):
                if (found := known.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    held |= found
        out.append((doc, len(w), len(hit), sorted(held)))
    return out


def answers(spark, docs, items):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontaminate.contamination(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    return sorted(map(repr, map(tuple, found)))


@pytest.mark.parametrize("small", [100_000, 0])
@pytest.mark.parametrize("stretch", [1 << 16, 7])
def test_hits_like_brute_force(spark, monkeypatch, small, stretch):
    """Few words, so that windows overlap, repeat and are shared between items; broadcast and shuffled."""
    monkeypatch.setattr(scratch, "SMALL_ROWS", small)
    monkeypatch.setattr(decontaminate, "STRETCH", stretch)
    rng = random.Random(small + stretch)
    vocabulary = ["the", "Of", "é", "42", "ß", "漢字", "ab"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(k, text(rng.choice([1, 2, 5, 9, 10, 11, 30]) if k > 20 else 10 + k)) for k in range(28)]
    docs = [(k, text(rng.randrange(60))) for k in range(60)]
    docs += [(100 + k, f"{text(20)} {items[k % 28][1].upper()} {text(5)}{items[(k + 9) % 28][1]}") for k in range(60)]
    assert answers(spark, docs, items) == sorted(map(repr, brute(docs, items)))


def test_odd_rows(spark):
    item = "one two three four five six seven eight nine ten eleven"
    items = [(7, item), (7, item), (None, item.upper()), (8, None), (9, "..."), (10, "Short item"), (11, item.replace("six", "6"))]
    docs = [(1, None), (2, ""), (3, " -- "), (None, f"x {item}"), (4, "short, ITEM"), (4, "short, ITEM"), (5, "one two three four five six seven eight nine"), (6, "ſhort item K"), (7, "w " * 300_000 + item)]
    assert answers(spark, docs, items) == sorted(map(repr, brute(docs, items)))
    assert answers(spark, docs, []) == sorted(repr((d, len(words(t)), 0, [])) for d, t in docs)
    assert answers(spark, [], items) == []


def test_columns_named_like_helpers(spark):
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, f"a {item}", "x", 2), (2, "clean", "y", 3)], "doc_id long, text string, k1 string, `a.b` int")
    items = spark.createDataFrame([(1, item, 5)], "item_id long, text string, hash int")
    assert [tuple(r) for r in decontaminate.clean_rows(docs, items).collect()] == [(2, "clean", "y", 3)]
    assert sorted(tuple(r) for r in decontaminate.contamination(docs, items).collect()) == [(1, 11, 10, ["1"]), (2, 1, 0, [])]


def test_copies_of_one_text_are_one_group_of_hits(spark):
    """9 of 10 rows are one contaminated text: each is answered."""
    item = " ".join(f"w{k}" for k in range(30))
    docs = [(k, f"start {item} end" if k % 10 else "clean") for k in range(2000)]
    got = answers(spark, docs, [(1, item)])
    assert got == sorted(repr((d, 32 if d % 10 else 1, 30 if d % 10 else 0, ["1"] if d % 10 else [])) for d, _ in docs)
