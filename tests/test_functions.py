"""Column functions against the fixed examples and Python's own library."""

from __future__ import annotations

import html
import random
import time
import uuid
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from entityforge.functions import ids, names, text, times, urls


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("example.com", "https://example.com"),
        ("https://example.com/?utm_source=a&keep=1", "https://example.com?keep=1"),
        ("https://example.com/", "https://example.com"),
        ("", ""),
        (None, ""),
        ("https://www.youtube.com/watch?v=OAUF574I7Gk", "https://youtube.com/watch?v=OAUF574I7Gk"),
        ("  http://WWW.Ex.com:443/a//?b&c=1%20x&REF=z#top ", "https://ex.com/a?b=&c=1+x"),
        ("http://ex.com:8080/p", "https://ex.com80/p"),
        ("http://ex.com/a;x=1?q=~*", "https://ex.com/a;x=1?q=~%2A"),
        ("   ", "https://"),
        ("http://[::1/x", "http://[::1/x"),
    ],
)
def test_normalize_url(spark, given, expected):
    assert one(spark, given, urls.normalize_url) == expected


def test_canonical_name_ignores_spacing_and_suffixes(spark):
    assert one(spark, "OpenAI Inc", names.canonical_name) == one(spark, "Open AI", names.canonical_name) == "openai"
    assert one(spark, "The X-Labs Company, Ltd. PLC", names.canonical_name) == "x"
    assert one(spark, "日本", names.canonical_name) == ""
    assert one(spark, None, names.canonical_name) == ""


def test_canonical_domain(spark):
    assert one(spark, "https://www.Example.com:80/a?b", urls.canonical_domain) == "example.com"
    assert one(spark, "example.com/a", urls.canonical_domain) == "example.com"
    assert one(spark, None, urls.canonical_domain) == ""


@pytest.mark.parametrize(("given", "expected"), [("https://a.b", True), ("HTTP://a", True), ("ftp://a", False), ("https://", False), ("", False), (None, False), ("https://[a", False)])
def test_valid_url(spark, given, expected):
    assert one(spark, given, urls.valid_url) is expected


@pytest.mark.parametrize("ref", ["a.png", "/a.png", "//c.org/a", "https://d.org/x", "?q=1", "../up.png", "./here.png", "../../far.png", "#f", ""])
def test_join_url_like_the_standard_library(spark, ref):
    base = "https://ex.com/dir/sub/page.html?x=1"
    assert one(spark, ref, lambda c: urls.join_url(F.lit(base), c)) == urljoin(base, ref)


@pytest.mark.parametrize(
    "given",
    ["<p>Hello   world</p>", "Tom &amp; Jerry", "&lt;b&gt;x", "&amp;lt;", "a < b > c", "&eacute;t&eacute &#128; &#0;", "  x y\x1c", "", "&notit; &hellip;", None],
)
def test_clean_text(spark, given):
    import re

    expected = re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", html.unescape(given or ""))).strip()
    assert one(spark, given, text.clean_text) == expected


def test_unescaping_like_the_standard_library(spark):
    """Every name, ended and not, numbers of all kinds, and references in texts of random pieces."""
    import random
    from html.entities import html5

    rng = random.Random(5)
    numbers = [*range(0x3000), *range(0xD7F0, 0xE010), *range(0xFD00, 0x10100), 0x1FFFE, 0x1F600, 0x10FFFD, 0x10FFFF, 0x110000, 9999999, 10**30]
    texts = [f"&{name}" for name in html5] + [f"a&{name}b&{name.rstrip(';')}=&{name}" for name in html5]
    texts += [f"&#{n};" for n in numbers] + [f"x&#X{n:x}&#x000{n:X};&#0{n}z" for n in numbers]
    names = [name.rstrip(";") for name in html5]
    pieces = ["&", ";", "&#", "&#x", "#", " ", "a", "7", "<b>", "\n", "é", "😀", "&amp;", "&amp;lt;", "&notit;", "&" + "q" * 40 + ";"]
    texts += ["".join(rng.choice((rng.choice(pieces), "&" + rng.choice(names), rng.choice(names)[:3])) for _ in range(rng.randrange(9))) for _ in range(4000)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, "", "no reference", None])], "i int, t string")
    got = {r["i"]: r["u"] for r in rows.select("i", text.html_unescape(F.col("t")).alias("u")).collect()}
    assert [(t, got[i]) for i, t in enumerate(texts) if got[i] != html.unescape(t)] == []
    assert [got[len(texts) + k] for k in range(3)] == ["", "no reference", None]
    assert one(spark, "&#" + "9" * 5000 + ";", text.html_unescape) == "\ufffd"
    plan = rows.select(text.html_unescape(F.col("t")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_ids_are_the_published_ones(spark):
    def made(kind, name, url):
        return spark.range(1).select(ids.entity_id(F.lit(kind), F.lit(name), F.lit(url))).first()[0]

    assert made("task", "Code Generation", "") == "326e04b0-e73c-51d5-984e-66149046bf44"
    title = "The Only AI Tools You Need In 2026 (15-Minute Guide)"
    assert made("video", title, "https://www.youtube.com/watch?v=OAUF574I7Gk") == "3c6eda5c-bf3e-59b5-9d02-885232a0533b"
    assert made(" Tool ", "É x", None) == str(uuid.uuid5(uuid.UUID(ids.NAMESPACE), "tool|é x|"))
    assert made("tool", "a", "u") != made("tool", "b", "u") != made("tool", "b", "v")


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("2024-01-31T00:00:00Z", True), ("2024-01-01T00:00:00+00:00", True), ("2023-12-31T00:00:00Z", False), ("2030-01-01T00:00:00Z", True), ("2024-01-31", False),
        ("2024-01-31T00:00:00", False), ("Mon, 01 Jan 2024 00:00:00 GMT", False), ("20240131T000000Z", True), ("2024-01-31T05:00:00.123+0500", True), (None, False), ("x", False),
    ],
)
def test_is_recent(spark, given, expected):
    assert one(spark, given, lambda c: times.is_recent(c, F.lit("2024-01-31 12:00:00").cast("timestamp"), 30)) is expected


def test_contains_either_way(spark):
    rows = spark.createDataFrame([("Acme", "acme labs"), ("ACME Labs", "acme"), ("a", "b")], "a string, b string")
    assert [r[0] for r in rows.select(text.contains_either_way(F.col("a"), F.col("b"))).collect()] == [True, True, False]


def test_white_space_is_walked_once(spark):
    """A run inside a text costs its length, not its square; and all kinds of white space, as Python has them."""
    rng = random.Random(7)
    texts = ["a" + " " * 150_000 + "b\n", "\u2003" * 1000 + "é\x1c\x1c"] + ["".join(rng.choice(" \t\n\x0b\r\x1c\x1f\x85\xa0\u2009\u3000\u200bab") for _ in range(rng.randrange(9))) for _ in range(500)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    began = time.time()
    got = rows.select("t", text.strip(F.col("t")), text.strip_text(F.col("t")), text.squeeze(F.col("t"))).collect()
    assert time.time() - began < 10
    assert [tuple(r) for r in got] == [(t, t.strip(), t.strip(), " ".join(t.split())) for t in texts]


def test_parts_of_a_url_are_computed_once(spark):
    """A step that the next one names twice is no step twice: the plan grows with the steps, not as a power of them."""
    plan = spark.range(1).select(urls.normalize_url(F.col("id").cast("string")))._jdf.queryExecution().analyzed().toString()
    assert plan.lower().count("regexp") + plan.lower().count("rlike") < 40
