"""Rearrangement against a plain regular expression, the automaton against a reading byte by byte, and odd input."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from entityforge.llm import infill

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def brute(doc, text):
    text = text or ""
    h = [int(hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)]
    tokens = TOKEN.findall(text)
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(t) for t in (tokens[:a], tokens[a:b], tokens[b:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return doc, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return doc, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts():
    rng = random.Random(5)
    alphabet = ["a", "Zz", "P", "<", "<S", ">", "<M", " ", "\n", "é", "漢", "😀", "\x00", " ", "word", "\r\n"]
    found = ["", None, "<P>", "a<S>b", "<", "<P", "P>", "<<M>>", "x" * 40, "é" * 9, "<P" * 30 + ">"]
    return found + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(300)]


@pytest.mark.parametrize("piece", [1 << 20, 16, 5])
def test_like_regular_expressions(spark, monkeypatch, piece):
    """With short pieces, tokens, marks and characters are cut by their borders and scanned by different tasks."""
    monkeypatch.setattr(infill, "PIECE", piece)
    rows = [(None if k % 50 == 3 else k // 2, t) for k, t in enumerate(texts())]
    made = infill.rearrange(spark.createDataFrame(rows, "doc_id long, text string"))
    got = made.select("*", infill.restored(made["form"], made["output"]).alias("back")).collect()
    assert sorted(repr(tuple(r)[:6]) for r in got) == sorted(repr(brute(*r)) for r in rows)
    assert sorted(r["back"] for r in got) == sorted(t or "" for _, t in rows)


def test_tree_like_reading_byte_by_byte(monkeypatch):
    monkeypatch.setattr(infill, "BLOCK", 8)
    raw = [(t or "").encode() for t in texts()]
    tree = infill.Tree(raw)
    for k, text in enumerate(raw):
        state, tokens, marks, chars = tree.whole(k)
        for s in range(infill.STATES):
            now, starts, met, places = s, 0, 0, []
            for at, b in enumerate(text):
                if infill.TOKEN[b, now]:
                    places.append(len(text[:at].decode()))
                starts, met, now = starts + int(infill.TOKEN[b, now]), met + int(infill.MARK[b, now]), int(infill.STEP[b, now])
            assert (state[s], tokens[s], marks[s], chars) == (now, starts, met, len(text.decode()))
            wanted = range(len(places) + 1)
            assert tree.starts([(k, s, n) for n in wanted]) == [*places, chars]


def test_giant_and_repeated_rows(spark):
    """Texts of several pieces, one without any border, repeated rows, and columns named like helpers."""
    rows = [(1, "ab, é<" * 400_000, "x"), (2, "q" * 3_000_000, "y"), (1, "ab, é<" * 400_000, "x"), (3, " " * 1_500_000 + "<P>", "z"), (4, "short one", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k1 string")
    got = [tuple(r) for r in infill.rearrange(docs).collect()]
    assert sorted(got, key=str) == sorted((brute(d, t) for d, t, _ in rows), key=str)
    assert infill.rearrange(docs.limit(0)).count() == 0
