"""Entries of feeds: by Spark's parser where a document is well formed, by tags where it is not."""

from __future__ import annotations

import random
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pytest

from entityforge.sources import feeds

LOOSE = """<rss><channel><title>feed</title><item><title>A & B</title><link>https://e.org/a?x=1&y=2</link><description><![CDATA[<b>hi</b>]]></description><pubDate>now</pubDate></item>
<entry><title>C</title><link rel="self" href="me"/><link href="https://e.org/c"/><summary>s</summary><dc:updated>then</dc:updated></entry><item><title>cut"""
RSS = """ <?xml version="1.0" encoding="ISO-8859-1"?>
<rss xmlns:dc="d" xmlns:atom="a"><channel><title>t</title><item><title/><dc:title>A &amp; B</dc:title><atom:link href="u"/><link>http://z</link><description><![CDATA[<b>hi</b>]]></description>
<pubDate>now</pubDate></item><item/></channel><channel><item><title>second channel</title></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>f</title><entry><title type="xhtml">a <b>bold</b> x</title><link rel="self" href="h1"/><link rel="alternate" href="h2"/>
<updated>2024</updated><published> </published><summary>s</summary></entry></feed>"""
RDF = '<rdf:RDF xmlns:rdf="r" xmlns="q"><channel><title>c</title></channel><item><title>only</title><link>l</link></item></rdf:RDF>'
DEEP = "<all><group><item><title>deep</title></item></group></all>"


def read(spark, documents, limit=None):
    rows = feeds.feed_entries(spark.createDataFrame([(i, d) for i, d in enumerate(documents)], "k int, xml string"), limit=limit)
    out = {}
    for r in sorted(rows.collect(), key=lambda r: (r["k"], r["_item"])):
        assert r["_item"] == len(out.setdefault(r["k"], []))
        out[r["k"]].append((r["title"], r["summary"], r["description"], r["link"], r["published"]))
    return out


def test_kinds_of_feeds(spark):
    got = read(spark, [LOOSE, RSS, ATOM, RDF, DEEP, "no feed", "", None, "<a/>"])
    assert got[0] == [("A & B", "<b>hi</b>", "<b>hi</b>", "https://e.org/a?x=1&y=2", "now"), ("C", "s", None, "https://e.org/c", "then"), ("cut", None, None, None, None)]
    assert got[1] == [("A & B", "<b>hi</b>", "<b>hi</b>", "http://z", "now"), (None,) * 5, ("second channel", None, None, None, None)]
    assert got[2] == [("a <b>bold</b> x", "s", None, "h2", "2024")]
    assert got[3] == [("only", None, None, "l", None)]
    assert got[4] == [("deep", None, None, None, None)]
    assert set(got) == {0, 1, 2, 3, 4}
    assert {k: len(v) for k, v in read(spark, [LOOSE, RSS, ATOM], limit=1).items()} == {0: 1, 1: 1, 2: 1}
    assert read(spark, []) == {}


def test_entities_outside_are_not_fetched(spark, tmp_path):
    (tmp_path / "secret").write_text("secret")
    bad = f'<!DOCTYPE x [<!ENTITY e SYSTEM "file://{tmp_path}/secret">]><rss><channel><item><title>&e;</title></item></channel></rss>'
    assert "secret" not in str(read(spark, [bad])[0][0])


def test_well_formed_feeds_like_an_xml_tree(spark):
    """Random feeds of all fields, some empty or repeated, against a reading of the whole tree in plain Python."""
    rng = random.Random(3)
    texts = ["", "x", "a & b", "<i>t</i>", "é 😀", "]]>", "two\nlines"]

    def made():
        def entry(tag):
            fields = rng.choices(("title", "summary", "description", "link", "published", "pubDate", "updated", "other"), k=rng.randrange(9))
            return f"<{tag}>" + "".join(f"<{f}>{escape(rng.choice(texts))}</{f}>" for f in fields) + f"</{tag}>"

        n = rng.randrange(5)
        return rng.choice((f"<rss><channel>{''.join(entry('item') for _ in range(n))}</channel></rss>", f"<feed>{''.join(entry('entry') for _ in range(n))}</feed>"))

    def expected(document):
        out = []
        for node in ElementTree.fromstring(document).iter():
            if node.tag in ("item", "entry"):
                first = lambda *tags: next((c.text for t in tags for c in node if c.tag == t and c.text), None)  # noqa: E731, B023
                out.append((first("title"), first("summary", "description"), first("description"), first("link"), first("published", "pubDate", "updated")))
        return out

    documents = [made() for _ in range(300)]
    got = read(spark, documents)
    assert [d for i, d in enumerate(documents) if got.get(i, []) != expected(d)] == []


def test_encodings():
    assert feeds.decoded('<?xml version="1.0" encoding="ISO-8859-1"?><a>é</a>'.encode("latin-1")).endswith("<a>é</a>")
    assert feeds.decoded("<a>é</a>".encode("utf-16")) == "<a>é</a>" and feeds.decoded("<a>é</a>".encode()) == "<a>é</a>"
    assert feeds.decoded(b'<?xml encoding="none-such"?>\xff') == '<?xml encoding="none-such"?>�'


def test_clashing_columns_raise_and_plan_reads_in_the_jvm(spark, capsys):
    rows = spark.createDataFrame([(1, RSS)], "title int, xml string")
    with pytest.raises(ValueError, match="title"):
        feeds.feed_entries(rows)
    plan = feeds.feed_entries(rows.withColumnRenamed("title", "k"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_xml") == 1  # parsed once
