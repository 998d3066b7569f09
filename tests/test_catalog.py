"""Operators of the catalog, and the registered queries against DuckDB."""

from __future__ import annotations

import json
import random
import re
import sys

import duckdb
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from entityforge.operators import classify, containment, dedupe, describe, logos, relationships, report, sinks, validate
from entityforge.plans import catalog, pipeline
from entityforge.plans.pipeline import PipelineConfig, export, process
from entityforge.schema import make_entities
from entityforge.sources import connectors, http, payloads
from entityforge.sources.http import Answer

# workers do not import test modules
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def entities(spark, *rows):
    """Rows of (type, name, description, url, metadata dict of text)."""
    flat = [(i, *r[:4], r[4] if len(r) > 4 else {}) for i, r in enumerate(rows)]
    raw = spark.createDataFrame(flat, "n bigint, t string, name string, d string, u string, m map<string,string>")
    meta = F.transform_values("m", lambda k, v: v.cast("variant"))
    return make_entities(raw, F.col("t"), F.col("name"), F.col("d"), F.col("u"), F.array(F.lit("C")), F.lit("s"), F.lit(""), meta, F.col("n"))


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_duckdb(spark, sf_dir, name):
    df = catalog.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    mine = sorted(tuple(map(str, r)) for r in df.select(columns).collect())
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = con.execute(catalog.oracle_sql()[name])
    order = [[d[0] for d in got.description].index(c) for c in columns]
    assert mine == sorted(tuple(str(r[i]) for i in order) for r in got.fetchall())


def sequential(keys):
    """Greedy leaders, one row at a time."""
    names, domains, out = {}, {}, {}
    for pos, name, domain in keys:
        lead = names.get(name)
        if lead is None and domain is not None:
            lead = domains.get(domain)
        if lead is None:
            lead = names[name] = pos
            if domain is not None:
                domains[domain] = pos
        out[pos] = lead
    return out


@pytest.mark.parametrize("seed", range(3))
def test_leaders_like_one_row_at_a_time(spark, seed):
    rng = random.Random(seed)
    keys = [(i, f"n{rng.randrange(25)}", rng.choice([None, *(f"d{k}" for k in range(25))])) for i in range(120)]
    df = spark.createDataFrame(keys, "pos bigint, name_key string, domain_key string")
    assert {r["pos"]: r["leader"] for r in dedupe.assign_leaders(df).collect()} == sequential(keys)


def test_dedupe_merges(spark):
    rows = entities(
        spark, ("tool", "One", "short", "https://a.com", {"k": "1", "x": "y"}), ("tool", "Two", "a longer text", "https://www.a.com/b", {"k": None}), ("tool", "Three", "", ""), ("tool", "Four", "", "")
    )
    out = {r["name"]: r for r in dedupe.dedupe(rows).withColumn("m", F.to_json("metadata")).collect()}
    assert set(out) == {"One", "Three", "Four"}
    assert out["One"]["description"] == "a longer text" and out["One"]["m"] in ('{"k":null,"x":"y"}', '{"x":"y","k":null}')
    assert dedupe.dedupe(rows.limit(0)).count() == 0
    assert dedupe.dedupe(rows, use_domain=False).count() == 4


def issues(spark, *row):
    return validate.with_issues(entities(spark, row)).first()["issues"]


def test_validation(spark):
    assert "missing url" in issues(spark, "model", "m", "a description", "")
    assert issues(spark, "task", "m", "a description", "") == []
    assert issues(spark, "task", "", "", "") == ["missing name", "missing name", "missing description"]
    assert issues(spark, "tool", "Test Model", "short", "https://crunchbase.com/x") == ["placeholder name", "third-party url", "description too short"]
    assert issues(spark, "odd", "testing", "a description", "x") == ["invalid entity_type", "invalid url"]
    valid, counts = validate.validate_all(entities(spark, ("task", "a", "a description", ""), ("task", "b", "", "")))
    assert valid.count() == 1 and tuple(counts.first()) == (1, 1)


def test_placeholder_ends_where_its_word_ends(spark):
    """Words as the reference has them: letters, digits and underscores of any script, but no marks."""
    names = ["Test", "test 1", "TODO: x", "Teſt x", "test\u0301 x", "example-a", "Testß a", "testö", "test漢", "test٣", "test_1", "test1", "testing", "a test", "test a\nb", "test a\rb"]
    found = [n for n in names if "placeholder name" in issues(spark, "task", n, "a description", "")]
    assert found == [n for n in names if re.fullmatch(r"(placeholder|todo|dummy|example|test)\b.*", n, re.I)]


def test_recency_and_tasks(spark):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    rows = entities(spark, ("repository", "a", "", "", {"pushed_at": "2024-01-31T00:00:00Z"}), ("repository", "b", "", "", {"pushed_at": "2015-01-01T00:00:00Z"}))
    tagged = {r["name"]: r["categories"] for r in classify.tag_recency(rows, now).collect()}
    assert tagged == {"a": ["C", "New"], "b": ["C"]}
    found = classify.tag_tasks(entities(spark, ("tool", "x", "code generation and programming", ""), ("tool", "y", "nothing", "")))
    tasks = {r["name"]: r["t"] for r in found.select("name", F.expr("try_variant_get(metadata['related_tasks'], '$', 'array<string>')").alias("t")).collect()}
    assert tasks == {"x": ["code-generation"], "y": None}
    assert {r["entity_type"] for r in classify.task_entities(spark).collect()} == {"task"}


def test_relationships(spark):
    rows = entities(
        spark, ("company", "Anthropic", "c", "https://x.com"), ("repository", "r", "d", "https://r.com", {"owner": "anthropics"}), ("tool", "t", "d", "https://t.com", {"maker": "Anthropic"}),
        ("model", "Big", "d", "https://m.com"), ("device", "dev", "d", "https://d.com", {"runs_model": "bIG"}), ("mcp", "server", "works with BIG and t", "https://s.com"),
    )
    whole = classify.tag_tasks(rows).unionByName(classify.task_entities(spark))
    names = {r["id"]: r["name"] for r in whole.select("id", "name").collect()}
    edges = [(names[r["from"]], r["relation"], names[r["to"]]) for r in relationships.build_relationships(whole).collect()]
    assert len(edges) == len(set(edges)) and all(a != b for a, _, b in edges)
    assert {("Anthropic", "develops", "r"), ("Anthropic", "develops", "t"), ("dev", "runs", "Big"), ("server", "integrates_with", "Big"), ("server", "integrates_with", "t")} <= set(edges)


def test_repeated_entities_meet_once(spark, monkeypatch):
    """Rows that repeat an id and a name make no pair of their own, and the order is that of all pairs."""
    mcp = [("mcp", f"server {k % 3}", f"works with t{k % 2}", "") for k in range(120)]
    rest = [(kind, f"t{k % 2}", "d", "", {"runs_model": f"T{k % 2}"}) for kind in ("tool", "model", "device") for k in range(100)]
    rows = entities(spark, *mcp, *rest)
    made, final = [], relationships.distinct_edges
    monkeypatch.setattr(relationships, "distinct_edges", lambda edges: made.append(edges) or final(edges))
    got = [tuple(r) for r in relationships.build_relationships(rows).collect()]
    whole = final(relationships.integrates_with(rows).unionByName(relationships.runs(rows))).collect()
    assert got == [tuple(r) for r in whole] and len(got) == 3 * 2 * 2 + 2
    assert made[0].count() == len(got)


def test_containment_join_beyond_the_broadcast_size(spark, monkeypatch):
    left = spark.createDataFrame([("abcd x",), ("xyz",), ("",)], "t string")
    right = spark.createDataFrame([("abc",), ("x",), ("yz",), ("nope",), ("",)], "n string")
    expected = {(t, n) for t in ("abcd x", "xyz", "") for n in ("abc", "x", "yz", "nope", "") if n in t}
    assert {tuple(r) for r in relationships.containment_join(left, "t", right, "n").collect()} == expected
    for limit in ("NAMES", "NAME_CHARS"):
        with monkeypatch.context() as m:
            m.setattr(containment, limit, 0)
            got = [tuple(r) for r in relationships.containment_join(left, "t", right, "n").collect()]
            assert set(got) == expected and len(got) == len(expected)


def test_containment_by_grams_of_odd_rows(spark):
    """Repeated, null and wide texts, and columns named alike on both sides of other joins."""
    left = spark.createDataFrame([("日本語のテキスト", 1), ("日本語のテキスト", 2), (None, 3), ("aaa", 4), ("", 5)], "_name string, k int")
    right = spark.createDataFrame([("本語の", 1), ("a", 2), ("a", 3), (None, 4), ("aaaa", 5), ("語", 6)], "n string, j int")
    want = sorted((t, k, n, j) for t, k in [("日本語のテキスト", 1), ("日本語のテキスト", 2), ("aaa", 4), ("", 5)] for n, j in [("本語の", 1), ("a", 2), ("a", 3), ("aaaa", 5), ("語", 6)] if n in t)
    assert sorted(map(tuple, containment._by_rarest_gram(left, "_name", right, "n").collect())) == want
    assert sorted(map(tuple, containment.containment_join(left, "_name", right, "n").collect())) == want
    assert containment.containment_join(left, "_name", right.limit(0), "n").count() == 0


class Quota(Exception):
    code, status = 429, "RESOURCE_EXHAUSTED"
    details = {"error": {"details": [{"@type": "type.googleapis.com/google.rpc.RetryInfo", "retryDelay": "51s"}]}}


def test_describe():
    assert describe.retry_delay("51s") == describe.retry_delay({"seconds": 51}) == 51.0 and describe.retry_delay(-1) == 0.0 and describe.retry_delay("x") is None
    assert describe.delay_in(Quota.details) == 51.0 and describe.is_quota_error(Quota())
    assert describe.describe_one("p", "facts", lambda p: " new text ") == "new text"
    assert describe.describe_one("p", " ", lambda p: "x") == " "
    waited, calls = [], []

    def refuse(_):
        calls.append(1)
        raise Quota

    assert describe.describe_one("p", "facts", refuse, waited.append) == "facts"
    assert waited == [51.0, 51.0] and len(calls) == 3


def test_quota_rule_of_details():
    """Strictly, the word has to be in the details where there are any."""
    error = describe.ServiceError(429, "RESOURCE_EXHAUSTED", {"error": {"message": "slow down"}})
    bare = describe.ServiceError(429, "", None)
    named = describe.ServiceError(429, "", {"error": {"status": "RESOURCE_EXHAUSTED"}})
    assert [describe.is_quota_error(e) for e in (error, bare, named)] == [True, True, True]
    assert [describe.is_quota_error(e, strict=True) for e in (error, bare, named)] == [False, False, True]


def test_shipped_client(monkeypatch):
    monkeypatch.delenv("GEMINI_API_KEY", raising=False)
    assert describe.client_from_env() is None
    monkeypatch.setenv("GEMINI_API_KEY", "k")
    monkeypatch.setenv("DESCRIPTION_MODEL", "some-model")
    asked = []

    def post(url, headers, body, timeout):
        asked.append((url, headers["x-goog-api-key"], json.loads(body)["contents"][0]["parts"][0]["text"]))
        if len(asked) == 1:
            return Answer(429, json.dumps({"error": {"status": "RESOURCE_EXHAUSTED", "details": [{"retryDelay": "2s"}]}}).encode())
        return Answer(200, json.dumps({"candidates": [{"content": {"parts": [{"text": " said "}]}}]}).encode())

    waited = []
    assert describe.describe_one("p", "facts", describe.client_from_env(post)(), waited.append) == "said"
    assert waited == [2.0] and asked[0][0].endswith("/models/some-model:generateContent") and asked[0][1:] == ("k", "p")
    broken = describe.client_from_env(lambda *a: Answer(200, b"{}"))()
    assert describe.describe_one("p", "facts", broken, waited.append) == "facts"


def test_describe_all_asks_for_short_texts_only(spark):
    rows = entities(spark, ("tool", "a", "short text", ""), ("tool", "b", "", ""), ("tool", "c", "x" * 100, ""))
    out = {r["name"]: r["description"] for r in describe.describe_all(rows, lambda: lambda prompt: "written").collect()}
    assert out == {"a": "written", "b": "", "c": "x" * 100}


def test_logos(spark):
    page = '<link rel="Icon" href="/i.png"><link rel="apple-touch-icon" href="data:x"><meta property="og:image" content="o.png">'
    assert logos.candidates_of(page, "https://a.com/p/q") == ["https://a.com/i.png", "https://a.com/p/o.png"]
    answers = {"https://a.com/p/q": (200, {}, page), "https://a.com/i.png": (200, {"content-type": "image/png", "content-length": "100"}, ""), "https://a.com/p/o.png": (200, {"content-type": "image/png"}, "")}
    assert logos.find_logo("https://a.com/p/q", answers.get) == "https://a.com/p/o.png"
    assert logos.find_logo("https://gone.com", answers.get) == ""
    found = logos.find_logos(entities(spark, ("tool", "a", "", "https://a.com/p/q"), ("tool", "b", "", "")), lambda: answers.get)
    assert {r["name"]: r["logo_url"] for r in found.collect()} == {"a": "https://a.com/p/o.png", "b": ""}


def test_logos_of_stored_pages(spark):
    """Stored pages are not asked for, others are; a url is looked at once, and rows without one stay."""
    images = {f"https://{h}.com/i.png": (200, {"content-type": "image/png"}, "") for h in "abc"}
    pages = {"https://b.com": (200, {}, '<link rel="icon" href="/i.png">'), "https://c.com": (200, {}, '<link rel="icon" href="/i.png">')}
    asked = spark.sparkContext.accumulator(0)

    def client():
        def fetch(url):
            asked.add(1)
            return (images | pages).get(url)

        return fetch

    icon = '<link rel="icon" href="/none.png"><link rel="icon" href="/i.png">'
    stored = spark.createDataFrame([("https://a.com", icon), ("https://a.com", ""), ("https://c.com", None), (None, icon), ("https://d.com", "")], "url string, html string")
    rows = entities(spark, ("tool", "a", "", "https://a.com"), *[("tool", "again", "", "https://a.com")] * 5, *[("tool", u, "", f"https://{u}.com") for u in "bcd"], *[("tool", "no", "", "")] * 5)
    found = logos.find_logos(rows, client, stored).collect()
    assert len(found) == 14 and {(r["name"], r["logo_url"]) for r in found} == {*[(n, f"https://{h}.com/i.png") for n, h in (("a", "a"), ("again", "a"), ("b", "b"), ("c", "c"))], ("d", ""), ("no", "")}
    assert asked.value == 2 + 2 + 2
    assert logos.find_logos(rows.limit(0), client, stored.limit(0)).count() == 0


def test_http_retries():
    script, waits = [], []

    def opener(url, headers, timeout):
        step = script.pop(0)
        if step is None:
            raise OSError
        return http.Answer(step)

    def get(*steps):
        script[:], waits[:] = steps, []
        answer = http.get_with_retry("u", opener=opener, sleep=waits.append)
        return answer and answer.status, list(waits)

    assert get(200) == (200, []) and get(404) == (None, []) and get(429, 403, 429) == (None, [3, 6])
    assert get(500, None, 200) == (200, [2, 3.0]) and get(None, None, None) == (None, [1.5, 3.0, 4.5])


FEED = b"<rss><channel><item><title>T</title><description>D</description><link>https://n.com/1</link><pubDate>x</pubDate></item><item><title>U</title></item></channel></rss>"


def offline(url, headers, timeout):
    import json

    if "repositories" in url:
        items = [{"full_name": f"acme/r{i}", "homepage": "" if i else "https://acme.dev", "html_url": f"https://gh.com/{i}", "stargazers_count": 120, "owner": {"login": "acme"}} for i in range(3)]
        return http.Answer(200, json.dumps({"items": items}).encode())
    if "models" in url:
        return http.Answer(200, json.dumps([{"id": "acme/m", "tags": ["license:apache-2.0"] + ["t"] * 30, "pipeline_tag": "text"}]).encode())
    if "youtube" in url:
        return http.Answer(200, json.dumps({"items": [{"id": {"videoId": "v1"}, "snippet": {"title": "V", "channelTitle": "ch"}}]}).encode())
    return http.Answer(200, FEED)


def test_connectors(spark, monkeypatch, tmp_path):
    repos = connectors.fetch_module(spark, "mcp", 2, opener=offline)
    rows = repos.orderBy("pos").select("url", "categories", F.expr("metadata['stars']::int AS stars"), F.expr("metadata['owner']::string AS owner")).collect()
    assert len(rows) == 4 and rows[0]["url"] == "https://acme.dev" and rows[1]["url"] == "https://gh.com/1"
    assert rows[0]["stars"] == 120 and rows[0]["owner"] == "acme" and rows[0]["categories"] == ["Repositories", "MCP"]
    model = connectors.fetch_module(spark, "models", opener=offline).select("url", F.expr("metadata['license']::string AS l"), F.expr("size(try_variant_get(metadata['tags'], '$', 'array<string>')) AS n")).first()
    assert tuple(model) == ("https://huggingface.co/acme/m", "apache-2.0", 15)
    assert connectors.scan_videos(spark, "q", opener=offline, key=None).count() == 0
    monkeypatch.setenv("YOUTUBE_API_KEY", "k")
    assert connectors.fetch_module(spark, "videos", opener=offline).first()["url"] == "https://www.youtube.com/watch?v=v1"
    news = connectors.fetch_module(spark, "news", 1, opener=offline)
    assert news.count() == 6 and news.first()["url"] == "https://n.com/1"
    assert {r["status"] for r in connectors.check_feeds(spark, {"a": "u"}, offline).collect()} == {"OK"}
    (tmp_path / "tools.yaml").write_text("# c\n- name: X\n  url: https://x.com\n  description: \"\"\n  maker: Acme\n- name: ' '\n")
    seeds = connectors.fetch_module(spark, "tools", seed_dir=str(tmp_path))
    assert [r["name"] for r in seeds.collect()] == ["X"] and connectors.fetch_module(spark, "robots", seed_dir=str(tmp_path)).count() == 0
    assert connectors.chosen_modules(" repos, ,news") == ["repos", "news"] and len(connectors.chosen_modules("all")) == 12
    with pytest.raises(ValueError):
        connectors.chosen_modules("nope")


def test_pipeline_and_sinks(spark, tmp_path):
    rows = entities(spark, ("company", "Acme", "maker of things", "https://acme.com"), ("tool", "Coder", 'writes "code" for you, é', "https://www.coder.com/?ref=x", {"maker": "Acme"}), ("tool", "Bad", "", ""))
    result = process(rows, PipelineConfig(now=F.lit("2024-02-01 00:00:00").cast("timestamp")))
    row = result.report.first()
    assert (row["total_records_discovered"], row["records_cleaned"], row["final_record_count"], row["validation_failures"]) == (3, 3, 12, 1)
    assert row["records_by_entity_type"] == {"company": 1, "task": 10, "tool": 1} and row["timestamp"] == "2024-02-01T00:00:00.000000+00:00"
    assert {r["relation"] for r in result.edges.collect()} == {"develops", "solves"}
    export(result, str(tmp_path / "out"))
    export(result, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out/entities")).count() == 12
    sinks.write_csv(result.entities, str(tmp_path / "one"), 1)
    import csv

    text = next((tmp_path / "one").glob("*.csv")).read_bytes().decode()
    lines = list(csv.reader(text.splitlines()))
    assert lines[0] == list(sinks.CSV_COLUMNS) and lines[2][3] == 'writes "code" for you, é' and lines[2][4] == "https://coder.com" and text.endswith("\r\n")
    assert "Coder" in sinks.json_document(result.entities)
    export(result, str(tmp_path / "arrays"), json_arrays=True)
    export(result, str(tmp_path / "arrays"), json_arrays=True)
    found = json.loads((tmp_path / "arrays/entities.json").read_text())
    assert [e["name"] for e in found][:2] == ["Acme", "Coder"] and len(found) == 12 and "pos" not in found[0]
    assert len(json.loads((tmp_path / "arrays/relationships.json").read_text())) == result.counts["relationships"]
    assert json.loads((tmp_path / "arrays/quality_report.json").read_text())["final_record_count"] == 12
    sinks.write_json_array(result.edges.limit(0), str(tmp_path / "none.json"))
    assert json.loads((tmp_path / "none.json").read_text()) == []
    assert result.counts == {"discovered": 3, "after dedupe": 3, "valid": 12, "invalid": 1, "relationships": result.edges.count()}


def test_report_in_one_pass(spark):
    """Null keys are in no map, edges may be a table, nothing gives zeros; the entities are scanned and shuffled once."""
    rows = entities(spark, ("company", "A", "d", "https://a.com"), ("tool", "B", "", ""), ("tool", "C", "d", ""), (None, "D", None, None))
    edges = spark.createDataFrame([("x", "solves", "y")] * 3, "`from` string, relation string, `to` string")
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    made = report.quality_report(rows, edges, 9, 7, 2, now)
    row = made.first()
    assert (row["records_by_entity_type"], row["source_counts"]) == ({"company": 1, "tool": 2}, {"s": 4}) and row["relationship_counts"]["total"] == 3
    assert (row["final_record_count"], row["records_with_missing_descriptions"], row["records_with_missing_official_urls"], row["records_with_missing_logos"]) == (4, 2, 3, 4)
    assert report.quality_report(rows, 3, 9, 7, 2, now).first() == row
    none = report.quality_report(rows.limit(0), 0, 0, 0, 0, now).first()
    assert (none["final_record_count"], none["records_by_entity_type"], none["records_with_missing_logos"]) == (0, {}, 0)
    plan = report.quality_report(rows, 3, 9, 7, 2, now)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Scan") == 1 and "Join" not in plan


def test_counters_are_observed(spark):
    """As many jobs as without them, and the same numbers as counting."""
    rows = spark.range(100).repartition(3)

    def jobs(group, run):
        spark.sparkContext.setJobGroup(group, group)
        out = run()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), out

    plain, _ = jobs("plain", lambda: pipeline.cut_lineage(rows))
    observed, (table, n) = jobs("observed", lambda: pipeline.counted(rows, all=F.lit(True), small=F.col("id") < 10))
    assert observed == plain and n == {"all": 100, "small": 10} and table.count() == 100
    assert pipeline.counted(rows.filter("id < 0").groupBy("id").count(), all=F.lit(True)).n == {"all": 0}


def test_command_line_end_to_end(spark, tmp_path, monkeypatch, capsys):
    """Seeds to files, with descriptions by an offline service, and without them."""
    from entityforge.plans import cli

    monkeypatch.chdir(tmp_path)
    monkeypatch.setattr(cli, "build_session", lambda: spark)
    monkeypatch.setenv("GEMINI_API_KEY", "k")
    (tmp_path / "seeds").mkdir()
    (tmp_path / "seeds/tools.yaml").write_text("- name: Coder\n  url: https://coder.com\n  description: writes code\n")
    said = json.dumps({"candidates": [{"content": {"parts": [{"text": "A tool that writes code for you."}]}}]}).encode()
    post = lambda url, headers, body, timeout: Answer(200, said)
    options = ["--module", "tools", "--seed-dir", str(tmp_path / "seeds"), "--out-dir", str(tmp_path / "out"), "--skip-logos"]
    for more, text in (([], "A tool that writes code for you."), (["--skip-descriptions"], "writes code")):
        assert cli.main([*options, *more], post=post) == 0
        found = {e["name"]: e["description"] for e in json.loads((tmp_path / "out/entities.json").read_text())}
        assert found["Coder"] == text
    assert "after dedupe: 1" in capsys.readouterr().out


def test_streamed_upsert(spark, tmp_path):
    from entityforge.streaming import upsert

    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    flat = entities(spark, ("tool", "a", "one", "")).drop("metadata")
    for text in ("one", "two"):
        flat.withColumn("description", F.lit(text)).write.mode("append").parquet(source)
        query = upsert.start(spark.readStream.schema(flat.schema).parquet(source), out, str(tmp_path / "cp"))
        query.awaitTermination(60)
    assert [r["description"] for r in upsert.latest(spark, out).collect()] == ["two"]


def test_top_per_group(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 1)], "g string, v int")
    assert {tuple(r) for r in payloads.top_per_group(rows, "g", [F.col("v").desc()], 2).collect()} == {("a", 3), ("a", 2), ("b", 1)}
