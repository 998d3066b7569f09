"""Columns of the user's that are named like helpers, null and shared ids, and empty tables in every stage."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from entityforge.llm import chat, mixing

HELPERS = ["_", "_n", "_id", "_copies", "_gone", "_again", "_doc", "_key", "_print", "_source", "_l_id", "_l_source", "_verdict", "_VERDICT_", "row", "copy", "turn", "k_id", "least", "more", "key", "id", "a.b", "c`d"]


def test_mixing_keeps_columns_named_like_helpers(spark):
    rows = [(i // 2, f"{'w ' * (1 + i % 5)}", f"s{i % 3}", *(f"{h}{i}" for h in HELPERS)) for i in range(30)]
    names = ["doc_id long", "text string", "source string", *("`{}` string".format(h.replace("`", "``")) for h in HELPERS)]
    docs = spark.createDataFrame(rows, ", ".join(names))
    mixed = mixing.mix_sources(docs)
    out = mixing.repeat_rows(docs, mixed)
    got = Counter(map(tuple, out.collect()))
    assert out.columns == docs.columns and set(got) <= set(rows)
    assert sum(got.values()) == sum(r["copies"] for r in mixed.collect())


def test_mixing_of_rows_that_agree(spark):
    """Rows that agree in id, source and text share their copies in a defined order."""
    rows = [(None if i % 2 else 1, "a b c", None, f"tag{i % 7}") for i in range(40)] + [(2, None, "s", "x"), (3, "one two", "s", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, tag string")
    mixed = mixing.mix_sources(docs)
    first = Counter(map(tuple, mixing.repeat_rows(docs, mixed).collect()))
    again = docs.repartition(7)
    assert first == Counter(map(tuple, mixing.repeat_rows(again, mixing.mix_sources(again)).collect()))
    assert sum(first.values()) == sum(r["copies"] for r in mixed.collect())


@pytest.mark.parametrize("empty", [True, False])
def test_stages_keep_columns_named_like_helpers(spark, sf_dir, empty):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(120)
    for h in HELPERS:
        docs = docs.withColumn(h, docs["lang"])
    docs = docs.limit(0) if empty else docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert all(r["_n"] == r["lang"] == r["a.b"] == r["c`d"] for r in rows) and (empty or rows)
    assert (corpus_pipeline.packing_stage(spark, docs, sf_dir).count() > 0) != empty


def test_near_copies_with_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(None, text, "a"), (None, text + " x", "b"), (None, "quite another text of more than five words", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key string")
    kept = {r["_key"] for r in corpus_pipeline.near_copies_stage(spark, docs, "").collect()}
    assert "c" in kept and len(kept) == 2


@pytest.mark.parametrize("raw", ['{"prompt.text": "hello", "response.text": "world"}', '{"messages[]": {"role": "user", "content": "x"}}', '{"messages[].role": 1, "messages[].content": 2}', '{"": {"role": "a"}, "text": "b"}'])
def test_field_names_with_marks_of_paths(spark, raw):
    """Such a record is of no layout and is kept as it is, not read as empty turns."""
    got = chat.canonical_turns(spark.createDataFrame([(1, 0, raw)], "conv_id long, turn long, record string")).collect()
    assert [(r["layout"], r["role"], r["text"]) for r in got] == [(None, None, raw)]
