"""Chat formatting of empty tables, very long texts, clashing columns, and of all layouts of the query."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import functions as F

from entityforge.llm import chat, registry


def test_empty_long_and_clashing(spark):
    long_ = "word ### </turn> \\ " * 100_000
    rows = [(1, 0, json.dumps({"role": "assistant", "text": long_}), "x", "y"), (1, 1, json.dumps({"messages": [{"role": "user", "content": None}]}), None, None)]
    records = spark.createDataFrame(rows, "conv_id long, turn long, record string, segment string, step string")
    got = chat.read_back(chat.format_turns(chat.canonical_turns(records))).collect()
    want = f"assistant\n{long_}\nuser\n\n"
    assert [(r["n_turns"], r["turns_sha256"], r["loss_chars"]) for r in got] == [(2, hashlib.sha256(want.encode()).hexdigest(), len(long_))]
    assert chat.read_back(chat.format_turns(chat.canonical_turns(records.limit(0)))).count() == 0


def test_query_uses_several_layouts(spark, sf_dir, monkeypatch):
    seen = []
    turns = chat.canonical_turns
    monkeypatch.setattr(chat, "canonical_turns", lambda records: seen.append(turns(records)) or seen[-1])
    registry.op4_chat(spark, sf_dir)
    found = {r["layout"]: r["n"] for r in seen[0].groupBy("layout").agg(F.count("*").alias("n")).collect()}
    assert {"turn", "messages", "conversations"} <= set(found) and None not in found
