"""Counts beyond 32 bits, and keys that most rows share."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from entityforge.llm import language_model, mixing, nearest, quality_rules, warc


def test_numbers_beyond_32_bits():
    for numbers in ([], [0], [1, 255], [2**32 - 1], [2**32 + 5, 7], [2**50, 0, 3]):
        assert language_model._large(language_model._small(np.array(numbers, np.uint64))).tolist() == numbers
    assert len(language_model._small(np.arange(1000, dtype=np.uint64))) == len(language_model._small(np.arange(1000, dtype=np.uint32)))


@pytest.mark.parametrize("levels", [language_model.Levels(1, 1), language_model.Levels(1, 1, 2, 2)])
def test_answers_of_chunks_that_claim_very_much(spark, levels):
    """Three chunks with up to 2^32 - 1 occurrences of a hash each: answers are sums of integers, on one level and on two."""
    claims = {0: {5: 3_000_000_000, 9: 1}, 1: {5: 3_000_000_000, 7: 2**32 - 1}, 2: {5: 2**32 - 1, 7: 2**32 - 1}}
    rows = [(1, chunk, bytearray(language_model._packed(np.array(sorted(own), np.uint64))), bytearray(language_model._small(np.array([own[k] for k in sorted(own)], np.uint32)))) for chunk, own in claims.items()]
    asked = spark.createDataFrame(rows, language_model.ASKED)
    if levels.groups == 1:
        answers = language_model._answers(asked, 2)
    else:
        answers = language_model._handed_out(asked, language_model._answers(language_model._put_together(asked, levels, 2), 4), levels, 2)
    total = Counter()
    for own in claims.values():
        total.update(own)
    got = {r["chunk"]: language_model._large(bytes(r["counts"])).tolist() for r in answers.collect() if r["chunk"] >= 0}
    assert got == {chunk: [total[k] for k in sorted(own)] for chunk, own in claims.items()}


def brute_nearest(rows, k):
    vectors = [np.array(v, float) for _, v in rows]
    out = set()
    for q in {i for i, _ in rows if i % 50 == 0}:
        at = vectors[[i for i, _ in rows].index(q)]
        best = sorted((-float(at @ v / np.sqrt((at @ at) * (v @ v))), i) for (i, _), v in zip(rows, vectors) if i != q)[:k]
        out |= {(q, rank, i, round(-s, 9)) for rank, (s, i) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("repeats", [1, 7, 100])
def test_repeated_ids_displace_no_answers(spark, repeats):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(150)]
    shared = rows[50][1]
    rows = [(i, shared if i in (51, 52, 60) else v) for i, v in rows] + [(50, shared)] * (repeats - 1) + [(51, shared)] * (repeats // 20)
    got = nearest.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), nearest.F.col("vec_id") % 50 == 0, 5)
    assert {(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in got.collect()} == brute_nearest(rows, 5)


def test_fit_is_bounded_where_ids_repeat(spark, monkeypatch):
    """6000 texts of one labelled id are one row of the fit, and the verdicts on other texts are those without them."""
    taken = []
    real = quality_rules.fit_calibrated
    monkeypatch.setattr(quality_rules, "fit_calibrated", lambda features, *rest: taken.append(len(features)) or real(features, *rest))
    good, bad = "a clean and quite readable sentence about the weather of number {0} ", "buy $$$ now ### {0} %%% "
    docs = [(i, (good if i % 2 else bad).format(i) * 12) for i in range(80)]
    labels = [(i, i % 2) for i in range(80)] * 3
    many = [(81, bad.format(81) * 12 + f" z{i}") for i in range(6000)]
    verdicts = []
    for extra, label in (([many[0]], [(81, 0)]), (many, [(81, 0), (81, 0)])):
        table = spark.createDataFrame(docs + extra, "doc_id long, text string")
        model = quality_rules.fit_rules(table, spark.createDataFrame(labels + label, "doc_id long, quality int"), 40)
        verdicts.append([r["rules"]["kept"] for r in quality_rules.judge_texts(spark.createDataFrame(docs, "doc_id long, text string"), model).orderBy("doc_id").collect()])
    assert taken == [80, 80] and verdicts[0] == verdicts[1]


def test_archive_of_rows_that_are_nearly_all_alike(spark, tmp_path):
    """9 of 10 pages are one row: all but one of them revisit it, each with an id of its own."""
    rows = [(7, "http://a.example/", "<p>same</p>")] * 900 + [(i, f"http://b.example/{i}", f"<p>{i}</p>") for i in range(100, 200)] + [(None, None, "")] * 5
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(pages, f"file://{tmp_path}/w", 0)
    made = [(r["metadata"]["page_id"], r["main"]["type"], r["main"]["record_id"]) for r in warc.assemble(warc.read_archives(spark, f"file://{tmp_path}/w", with_payload=False)).collect()]
    assert Counter((p, t) for p, t, _ in made if p is None or p == 7) == {(7, "response"): 1, (7, "revisit"): 899, (None, "response"): 1, (None, "revisit"): 4}
    assert len({i for _, _, i in made}) == len(made) == 1005


def test_copies_of_rows_that_are_nearly_all_alike(spark):
    """9 of 10 rows share id, source and text; their copies differ by one, and reruns agree."""
    rows = [(1, "a b c d e f g h", "big", i % 3) for i in range(900)] + [(i, "w " * (i % 9 + 1), f"s{i % 2}", 0) for i in range(100, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, row int")
    mixed = mixing.mix_sources(docs)
    copies = [r["copies"] for r in mixed.filter("doc_id = 1").collect()]
    outs = [Counter(map(tuple, mixing.repeat_rows(docs, mixed).collect())) for _ in range(2)]
    assert outs[0] == outs[1] and sum(outs[0].values()) == sum(r["copies"] for r in mixed.collect())
    assert max(copies) - min(copies) <= 1 and sum(n for r, n in outs[0].items() if r[0] == 1) == sum(copies)
