"""The two quality operators row by row against dictionary versions."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from entityforge.llm import hashed, quality_rules, textstats, weak_quality
from entityforge.llm.columns import slices, text_udf

ALL = 1 << 32


def brute_slots(text):
    """Family → slot → count, with Python integers."""
    words = textstats.words_of(text)
    h = [zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words]
    points = [ord(c) for c in text]
    out = {}
    for n, seq in ((1, h), (2, h), (3, points), (4, points)):
        out[n - 1] = Counter()
        for i in range(len(seq) - n + 1):
            code = (seq[i] + n) % ALL
            for x in seq[i + 1 : i + n]:
                code = (code * 0x9E3779B1 + x) % ALL
            out[n - 1][(((code ^ code >> 15) * 2654435761) % ALL) >> 18] += 1
    return out


def brute_probability(model, text):
    margin = model.bias
    for family, slots in brute_slots(text).items():
        n = sum(slots.values())
        margin += sum(float(model.weights[family * hashed.SLOTS + s]) * c for s, c in slots.items()) / (n + hashed.PULL)
    return 1 / (1 + math.exp(-(model.a * margin + model.b)))


def test_rules_verdict_by_dictionaries(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_rules.fit_rules(docs, labels)
    some = quality_rules.judge_texts(docs, model).select("text", "rules.*").collect()
    assert len(some) == docs.count()
    for r in some:
        p = brute_probability(model, r["text"] or "")
        assert r["probability"] == pytest.approx(p, abs=1e-6)
        if abs(p - quality_rules.MIN_PROBABILITY) > 1e-5:
            assert r["kept"] == (not r["base_failed"] and p >= quality_rules.MIN_PROBABILITY)


def test_classifier_verdict_by_dictionaries(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model, _ = weak_quality.fit_weak(docs)
    assert model.agreement >= 0.9
    for r in weak_quality.classify_texts(docs, model).select("text", "quality.*").collect():
        p = brute_probability(model, r["text"] or "")
        assert r["probability"] == pytest.approx(p, abs=1e-6)
        if abs(p - weak_quality.MIN_PROBABILITY) > 1e-5:
            assert r["kept"] == (p >= weak_quality.MIN_PROBABILITY)


def test_stages_keep_what_the_models_say(spark, sf_dir):
    """Row by row, from models fitted on the same input; the classifier, alone, rejects most junk and little else."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    whole = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    rules, weak = quality_rules.fit_rules(docs, labels), weak_quality.fit_weak(docs)[0]
    failed = {r["doc_id"] for r in quality_rules.judge_texts(docs, rules).filter("rules.base_failed").select("doc_id").collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.rules_stage(spark, docs, sf_dir).select("doc_id").collect()}
    assert kept == {i for i, t in whole.items() if i not in failed and brute_probability(rules, t) >= quality_rules.MIN_PROBABILITY}
    kept = {r["doc_id"] for r in corpus_pipeline.quality_stage(spark, docs, sf_dir).select("doc_id").collect()}
    assert kept == {i for i, t in whole.items() if brute_probability(weak, t) >= weak_quality.MIN_PROBABILITY}
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    bad, good = [i for i in whole if known.get(i) == 0], [i for i in whole if known.get(i) == 1]
    assert sum(i not in kept for i in bad) >= 0.8 * len(bad) and sum(i in kept for i in good) >= 0.97 * len(good)


def brute_em(patterns, rounds=100):
    """The same two-class model over dictionaries."""
    size = len(next(iter(patterns)))
    post = {}
    for p in patterns:
        good, bad = p.count("g"), p.count("b")
        post[p] = 0.5 if good + bad == 0 else 0.98 if bad == 0 else max(0.5**bad, 0.02)
    total = sum(patterns.values())
    for _ in range(rounds):
        prior = min(max((sum(n * post[p] for p, n in patterns.items()) + 1) / (total + 2), 1e-3), 1 - 1e-3)
        table = []
        for j in range(size):
            sides = []
            for good in (True, False):
                seen = dict.fromkeys("gb-", 0.5)
                for p, n in patterns.items():
                    seen[p[j]] += n * (post[p] if good else 1 - post[p])
                whole = sum(seen.values())
                sides.append({v: x / whole for v, x in seen.items()})
            table.append(sides)
        new = {}
        for p in patterns:
            odds = math.log(prior / (1 - prior)) + sum(math.log(table[j][0][v]) - math.log(table[j][1][v]) for j, v in enumerate(p))
            new[p] = 1 / (1 + math.exp(-min(max(odds, -40), 40)))
        moved = max(abs(new[p] - post[p]) for p in patterns)
        post = new
        if moved < 1e-9:
            break
    return post


def test_posteriors_by_dictionaries(spark, sf_dir):
    texts = [r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    patterns = Counter()
    for text in texts:
        words = textstats.words_of(text)
        patterns[weak_quality.votes_of(text, words, textstats.WordNumbers().of(words))] += 1
    posterior, _ = weak_quality.estimate(dict(patterns))
    _, fitted = weak_quality.fit_weak(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert posterior == pytest.approx(brute_em(patterns), abs=1e-6) and fitted == pytest.approx(posterior, abs=1e-9)


@pytest.mark.parametrize("text", ["春 眠 不觉晓 处处 闻啼鸟 夜来 风雨 声 花落 知 多少 " * 3, "Мой дядя самых честных правил когда не в шутку занемог " * 2])
def test_other_scripts_are_not_voted_bad(text):
    words = textstats.words_of(text)
    votes = weak_quality.votes_of(text, words, textstats.WordNumbers().of(words))
    assert votes[8:11] == "---"


def test_features_of_long_texts_do_not_depend_on_parts(monkeypatch):
    text = "Ünï 漢字 abc " * 50
    whole = hashed.feature_vector(text, textstats.WordNumbers().hashes(np.zeros(0, np.int64)))
    monkeypatch.setattr(hashed, "PART", 7)
    parts = hashed.feature_vector(text, textstats.WordNumbers().hashes(np.zeros(0, np.int64)))
    assert (whole[0] == parts[0]).all() and np.allclose(whole[1], parts[1])


def test_windows_of_very_many_words():
    """More distinct words than bits of a code: distinct windows stay distinct."""
    n = 1 << 21
    numbers = np.array([0, 1, 2, n, 1, 2, 0, 1 + n, 2, 0, 1, 2 + n, 7, 8, 9, 7, 8, 9])
    codes = textstats.window_codes(numbers, 3)
    windows = [tuple(numbers[i : i + 3]) for i in range(len(numbers) - 2)]
    assert all((codes[i] == codes[j]) == (windows[i] == windows[j]) for i in range(len(windows)) for j in range(len(windows)))
    assert textstats.repeated_words(numbers) == 6


def test_word_table_is_bounded_by_characters(monkeypatch):
    monkeypatch.setattr(textstats.WordNumbers, "LIMIT_CHARS", 10)
    numbers = textstats.WordNumbers()
    first = numbers.hashes(numbers.of(["a" * 20, "b"])).tolist()
    assert len(numbers) == 2
    assert numbers.hashes(numbers.of(["c", "a" * 20])).tolist()[1] == first[0] and len(numbers) == 2


def test_slices_are_bounded_by_bytes(monkeypatch):
    import pyarrow as pa

    from entityforge.llm import columns

    monkeypatch.setattr(columns, "SLICE_BYTES", 10)
    parts = list(slices(pa.array(["a" * 4, None, "b" * 4, "c" * 30, "", "d"])))
    assert [p.to_pylist() for p in parts] == [["aaaa", None, "bbbb"], ["c" * 30], ["", "d"]]
    monkeypatch.setattr(columns, "SLICE", 2)
    assert [len(p) for p in slices(pa.array(["a"] * 5))] == [2, 2, 1]


def test_text_udf_keeps_other_columns(spark):
    rows = [(1, "a b", "x"), (None, None, None)]
    df = spark.createDataFrame(rows, "`n.1` long, text string, row string")
    out = df.withColumn("v", text_udf(lambda: lambda texts: [(len(t or ""), t) for t in texts], "n long, t string")(F.col("text")))
    assert sorted(map(str, out.collect())) == sorted(["Row(n.1=1, text='a b', row='x', v=Row(n=3, t='a b'))", "Row(n.1=None, text=None, row=None, v=Row(n=0, t=None))"])
