"""Registered queries of the catalog operators over the driver's tables, with their oracle SQL.

The tables are projected onto entities: pages are news, parts are tools or models, brands are
companies, documents are repositories. Nested columns come out as text, so that both engines say
them alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityforge.functions.ids import NAMESPACE
from entityforge.functions.names import FILLERS, LEGAL_SUFFIXES, canonical_name
from entityforge.functions.text import clean_text
from entityforge.functions.urls import TRACKING, canonical_domain, normalize_url, same_site, valid_url
from entityforge.operators import classify, clean, dedupe, describe, logos, relationships, report, sinks, validate
from entityforge.operators.classify import text_of
from entityforge.schema import TASKS, make_entities, metadata_of
from entityforge.session import cut_lineage, pin
from entityforge.sources import payloads
from entityforge.sources.feeds import feed_entries

#: The moment that recency is measured at.
NOW = "2024-01-31 00:00:00"
#: A taxonomy whose words occur in the parts' names.
PART_TASKS = {"task-red": ("red", "rose"), "task-blue": ("blue", "sky"), "task-metal": ("steel", "metal", "iron"), "task-any": ("a", "e")}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _strings(*values: str):
    return F.array(*map(F.lit, values))


def page_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as news: the title as name, the cleaned page as description."""
    raw = _table(spark, sf_dir, "pages")
    title = F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)
    found = make_entities(
        raw, F.lit("news"), title, F.col("html"), F.col("url"), _strings("News"), F.lit("pages"), F.lit("https://pages.example.org/feed"),
        metadata_of(published_at=F.lit(None).cast("string")), F.col("page_id"),
    )
    return clean.normalize_urls(clean.clean_entities(found))


def part_entities(spark: SparkSession, sf_dir: str, entity_type: str = "tool") -> DataFrame:
    """Parts as tools, made by their brand; no url."""
    raw = _table(spark, sf_dir, "part")
    return make_entities(
        raw, F.lit(entity_type), F.col("p_name"), F.col("p_type"), F.lit(""), F.array(F.lit("Parts"), F.col("p_brand")), F.lit("part"), F.lit(""),
        metadata_of(maker=F.col("p_brand"), size=F.col("p_size"), runs_model=F.upper("p_name")), F.col("p_partkey"),
    )


def brand_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands as companies, in the order of their names."""
    from pyspark.sql import Window

    brands = _table(spark, sf_dir, "part").select("p_brand").distinct()
    # a row per brand
    ranked = brands.withColumn("n", F.row_number().over(Window.orderBy("p_brand")))
    url = F.concat(F.lit("https://brand"), F.col("n"), F.lit(".example.com"))
    return make_entities(ranked, F.lit("company"), F.col("p_brand"), F.lit("a maker of parts"), url, _strings("Companies"), F.lit("brands"), url, None, F.col("n"))


def document_entities(spark: SparkSession, sf_dir: str, entity_type: str = "repository") -> DataFrame:
    """Documents as repositories of their source."""
    raw = _table(spark, sf_dir, "documents")
    name = F.concat(F.lit("doc-"), F.col("doc_id"))
    return make_entities(
        raw, F.lit(entity_type), name, F.col("text"), F.concat(F.lit("https://docs.example.org/"), F.col("doc_id")), _strings("Repositories"), F.col("source"), F.lit(""),
        metadata_of(owner=F.col("source"), language=F.col("lang")), F.col("doc_id"),
    )


# ---- queries


def q_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", clean_text(F.col("html")).alias("cleaned"))


def q_normalize_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", normalize_url(F.col("url")).alias("url"))


def q_canonical_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", canonical_domain(F.col("url")).alias("domain"))


def q_url_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.regexp_extract("url", "^[^:/?#]*://([^/?#]*)", 1)
    return _table(spark, sf_dir, "pages").select("page_id", valid_url(F.col("url")).alias("is_valid"), same_site(host, F.lit("example.com")).alias("is_same_site"))


def q_canonical_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.concat("p_name", F.lit(" Labs, Inc.")).alias("name"))
    people = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.concat(F.lit("The "), "c_name", F.lit(" & Co")).alias("name"))
    return parts.unionByName(people).select("key", "name", canonical_name(F.col("name")).alias("canonical"))


def q_entity_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_entities(spark, sf_dir).select("pos", "id", "name")


def q_dedupe_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = dedupe.assign_leaders(dedupe.resolution_keys(part_entities(spark, sf_dir)))
    return assigned.groupBy("leader").agg(F.count("*").alias("n"))


def q_dedupe_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.assign_leaders(dedupe.resolution_keys(page_entities(spark, sf_dir)))


def q_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = dedupe.dedupe(part_entities(spark, sf_dir))
    meta = F.col("metadata")
    return merged.select(
        "pos", "name", "description", F.array_join("categories", "; ").alias("categories"), text_of(meta, "maker").alias("maker"), text_of(meta, "size").alias("size")
    )


def q_recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _table(spark, sf_dir, "events")
    when = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    found = make_entities(
        raw, F.lit("repository"), F.col("event_type"), F.lit(""), F.lit(""), F.array(F.lit("Zeta"), F.col("event_type")), F.lit("events"), F.lit(""),
        metadata_of(pushed_at=when), F.col("event_id"),
    )
    tagged = classify.tag_recency(found, F.lit(NOW).cast("timestamp"), 10)
    return tagged.select(F.col("pos").alias("event_id"), F.array_join("categories", "; ").alias("categories"))


def q_tag_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = classify.tag_tasks(part_entities(spark, sf_dir), PART_TASKS)
    return tagged.select("pos", F.coalesce(text_of(F.col("metadata"), "related_tasks"), F.lit("[]")).alias("tasks"))


def q_task_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tasks, with the number of documents that each is found in."""
    slugs = F.try_variant_get(F.try_element_at("metadata", F.lit("related_tasks")), "$", "array<string>")
    found = classify.tag_tasks(document_entities(spark, sf_dir)).select(F.explode(slugs).alias("slug")).groupBy("slug").agg(F.count("*").alias("n"))
    tasks = classify.task_entities(spark).select("id", "name", "description", text_of(F.col("metadata"), "slug").alias("slug"))
    return tasks.join(found, "slug", "left").select("id", "name", "description", "slug", F.coalesce("n", F.lit(0)).alias("documents"))


def server_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as MCP servers that work with the part of their own number."""
    parts = _table(spark, sf_dir, "part").select("p_partkey", "p_name")
    raw = _table(spark, sf_dir, "supplier").join(parts, F.col("s_suppkey") == F.col("p_partkey"))
    about = F.concat(F.lit("works with "), F.col("p_name"))
    return make_entities(raw, F.lit("mcp"), F.col("s_name"), about, F.lit(""), _strings("Servers"), F.lit("supplier"), F.lit(""), None, F.col("s_suppkey"))


def model_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parts as models."""
    names = _table(spark, sf_dir, "part").groupBy("p_name").agg(F.min("p_partkey").alias("n"))
    return make_entities(names, F.lit("model"), F.col("p_name"), F.lit(""), F.lit(""), _strings("Models"), F.lit("names"), F.lit(""), None, F.col("n"))


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tools, devices, servers, models, companies and tasks, computed once as a run does before it relates them."""
    tools = classify.tag_tasks(part_entities(spark, sf_dir), PART_TASKS)
    parts = (part_entities(spark, sf_dir, "device"), server_entities(spark, sf_dir), model_entities(spark, sf_dir), brand_entities(spark, sf_dir), classify.task_entities(spark, PART_TASKS))
    for part in parts:
        tools = tools.unionByName(part)
    return cut_lineage(tools)


def q_develops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relationships.develops(_catalog(spark, sf_dir)).select("from", "relation", "to")


def q_solves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relationships.solves(_catalog(spark, sf_dir)).select("from", "relation", "to")


def q_integrates(spark: SparkSession, sf_dir: str) -> DataFrame:
    servers = document_entities(spark, sf_dir, "mcp")
    items = _table(spark, sf_dir, "benchmark")
    models = make_entities(items, F.lit("model"), F.col("text"), F.lit(""), F.lit(""), _strings("Models"), F.lit("benchmark"), F.lit(""), None, F.col("item_id"))
    return relationships.integrates_with(servers.unionByName(models)).select("from", "relation", "to")


def q_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relationships.runs(part_entities(spark, sf_dir, "device").unionByName(model_entities(spark, sf_dir))).select("from", "relation", "to")


def q_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relationships.build_relationships(_catalog(spark, sf_dir))


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_entities(spark, sf_dir).unionByName(document_entities(spark, sf_dir))


def q_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = validate.with_issues(_checked(spark, sf_dir))
    return found.select("entity_type", "pos", "id", "url", F.array_join("issues", "; ").alias("issues"))


def q_validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validate_all(_checked(spark, sf_dir))[1]


def q_validate_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers, each broken in one way by its number, under the rules that whole rows never break."""
    raw = _table(spark, sf_dir, "customer")
    about, n = F.lit("a customer of some country"), F.pmod(F.col("pos"), F.lit(7))
    url = F.concat(F.lit("https://c"), F.col("c_custkey"), F.lit(".example.com"))
    whole = make_entities(raw, F.lit("company"), F.col("c_name"), about, url, _strings("Customers"), F.lit("customer"), url, None, F.col("c_custkey"))
    broken = whole.withColumns({
        "id": F.when(n == 0, F.lit(None).cast("string")).otherwise(F.col("id")),
        "entity_type": F.when(n == 1, "").when(n == 2, "planet").otherwise(F.col("entity_type")),
        "categories": F.when(n == 3, F.array().cast("array<string>")).otherwise(F.col("categories")),
        "source": F.when(n == 4, F.lit(None)).when(n == 5, F.struct(F.lit("customer").alias("name"), F.lit("no url").alias("url"))).otherwise(F.col("source")),
    })
    return validate.with_issues(broken).select("pos", F.array_join("issues", "; ").alias("issues"))


def q_first_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run prints of its issues: the first ten in ingest order."""
    return validate.invalid_rows(document_entities(spark, sf_dir).withColumn("url", F.lit("nowhere"))).orderBy("pos").limit(10).select("pos", "name", F.array_join("issues", "; ").alias("issues"))


def q_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 17 fields for parts with a site per name, their brands, suppliers without a url, and the tasks."""
    parts = part_entities(spark, sf_dir)
    tools = parts.withColumn("url", F.concat(F.lit("https://"), F.replace("name", F.lit(" "), F.lit("-")), F.lit(".example.com")))
    about = F.lit("a supplier without a site")
    suppliers = make_entities(
        _table(spark, sf_dir, "supplier"), F.lit("device"), F.col("s_name"), about, F.lit(""), _strings("Devices"), F.lit("supplier"), F.lit(""), None, F.col("s_suppkey") + (1 << 40)
    )
    found = cut_lineage(tools.unionByName(brand_entities(spark, sf_dir).withColumn("pos", F.col("pos") + (1 << 50))).unionByName(suppliers))
    resolved = cut_lineage(dedupe.dedupe(found))
    valid, counts = validate.validate_all(resolved.unionByName(classify.task_entities(spark, PART_TASKS)))
    edges = relationships.develops(valid).select("from", "relation", "to")
    made = report.quality_report(valid, edges, found.count(), resolved.count(), counts.first()["invalid"], F.lit(NOW).cast("timestamp"))
    maps = {"records_by_entity_type": "by_type", "source_counts": "by_source"}
    plain = [c for c in made.columns if c not in (*maps, "relationship_counts")]
    return made.select(*plain, *[F.to_json(c).alias(name) for c, name in maps.items()], F.col("relationship_counts.total").alias("edges"))


def q_llm_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = document_entities(spark, sf_dir).filter(describe.needs_description(F.col("description")))
    return found.select("pos", "description")


def q_topk_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = payloads.top_per_group(_table(spark, sf_dir, "part"), "p_brand", [F.col("p_retailprice").desc(), F.col("p_partkey")], 3)
    return top.select("p_brand", "p_partkey")


def q_union_modules(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = page_entities(spark, sf_dir).unionByName(part_entities(spark, sf_dir)).unionByName(document_entities(spark, sf_dir))
    return whole.groupBy("entity_type").agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"), F.min("name").alias("first_name"))


def q_feed_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as feeds of their customers; regions are feeds without entries."""
    nations = _table(spark, sf_dir, "nation").select(F.col("n_name").alias("source_name"), "n_nationkey")
    feeds = nations.select("source_name").unionByName(_table(spark, sf_dir, "region").select(F.col("r_name").alias("source_name")))
    entries = _table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return payloads.feed_health(feeds, entries)


def _site(url: str):
    """A made-up answer to any url: an image, but some are too small, and some are none."""
    kind = "text/html" if len(url) % 3 == 1 else "image/png"
    return 200, {"content-type": kind, "content-length": "10" if len(url) % 3 == 2 else "5000"}, ""


def q_find_logo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logos of all pages from their own html, whose links of the navigation stand for icons; images as an offline client answers."""
    pages = _table(spark, sf_dir, "pages")
    site = F.concat(F.lit("https://"), F.regexp_extract("url", "^[^:/?#]*://([^/?#]*)", 1), F.lit("/p"), F.col("page_id").cast("string"))
    rows = make_entities(pages, F.lit("news"), F.lit("page"), F.lit(""), site, _strings("News"), F.lit("pages"), F.lit(""), None, F.col("page_id"))
    stored = pages.select(site.alias("url"), F.replace("html", F.lit('<a href="'), F.lit('<link rel="icon" href="')).alias("html"))
    return logos.find_logos(rows, lambda: _site, stored).select("pos", "url", "logo_url")


def q_skip_logos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logos.find_logos(part_entities(spark, sf_dir), None).select("pos", "logo_url")


def q_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions of all parts and documents, as an offline client writes them; it refuses one type of part."""

    def client():
        def ask(prompt: str) -> str:
            if "Facts: PROMO" in prompt:
                raise OSError("refused")
            return f" written for {prompt.partition('Type: ')[2].partition(chr(10))[0]} "

        return ask

    rows = part_entities(spark, sf_dir).unionByName(document_entities(spark, sf_dir).withColumn("pos", F.col("pos") + (1 << 40)))
    return describe.describe_all(rows, client, 2, batch_rows=10_000).select("entity_type", "pos", "description")


def q_logo_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = F.concat(
        F.lit('<link rel="icon" href="/i'), F.col("page_id"), F.lit('.png"><link rel="stylesheet" href="s.css"><link rel="apple-touch-icon" href="data:x">'),
        F.lit('<meta property="og:image" content="//cdn.example.org/o.png"><meta name="twitter:image" content="https://t.example.org/t.png">'), F.col("html"),
    )
    return _table(spark, sf_dir, "pages").select("page_id", F.array_join(logos.logo_candidates(head, F.col("url")), " ").alias("candidates"))


def q_csv_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts as rows of the CSV export, with marks that JSON escapes."""
    about = metadata_of(maker=F.col("source.name"), note=F.concat(F.lit('say "'), F.col("name"), F.lit('"')), size=F.col("pos"), none=F.lit(None).cast("string"))
    return sinks.flat_rows(part_entities(spark, sf_dir).withColumn("metadata", about))


def q_parse_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All suppliers as rows of a seed file, some without a name."""
    n = F.pmod(F.col("s_suppkey"), F.lit(4))
    raw = _table(spark, sf_dir, "supplier").select(
        F.when(n == 0, " ").when(n == 1, F.lit(None).cast("string")).otherwise(F.col("s_name")).alias("name"), F.concat(F.lit("https://s"), "s_suppkey", F.lit(".example.com")).alias("url"),
        F.when(n == 2, F.lit(None).cast("string")).otherwise(F.lit(" about it ")).alias("description"), metadata_of(nation=F.col("s_nationkey")).alias("metadata"), "s_suppkey",
    )
    found = payloads.parse_seeds(raw, "tool", ("Tools",), F.col("s_suppkey"))
    source = F.concat_ws("|", "source.name", "source.url")
    return found.select("pos", "id", "name", "description", "url", F.array_join("categories", "; ").alias("categories"), source.alias("source"), text_of(F.col("metadata"), "nation").alias("nation"))


def q_parse_repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _table(spark, sf_dir, "part").select(
        F.concat("p_brand", F.lit("/"), "p_name").alias("full_name"), F.col("p_name").alias("name"), F.col("p_type").alias("description"),
        F.concat(F.lit("https://code.example.com/"), F.col("p_partkey")).alias("html_url"), F.when(F.col("p_size") > 25, F.concat(F.lit("https://home.example.com/"), "p_partkey")).otherwise("").alias("homepage"),
        F.col("p_partkey").alias("stargazers_count"), F.lit(None).cast("string").alias("language"), F.lit("2024-01-01T00:00:00Z").alias("pushed_at"), F.array(F.col("p_type")).alias("topics"),
        F.struct(F.col("p_brand").alias("login"), F.lit("a.png").alias("avatar_url")).alias("owner"), F.struct(F.lit("MIT").alias("name")).alias("license"),
    )
    found = payloads.parse_repositories(raw, "repository", ("Extra",), F.col("stargazers_count"))
    meta = F.col("metadata")
    return found.select(
        "pos", "id", "name", "url", F.array_join("categories", "; ").alias("categories"), F.col("source.url").alias("source_url"), text_of(meta, "stars").alias("stars"),
        text_of(meta, "owner").alias("owner"), text_of(meta, "license").alias("license"), F.map_contains_key(meta, F.lit("language")).alias("has_language"),
    )


def q_parse_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.array_compact(F.array(F.col("p_type"), F.when(F.col("p_size") > 25, F.concat(F.lit("license:l"), "p_size")), F.lit("license:late")))
    tags = F.concat(tags, F.transform(F.sequence(F.lit(1), F.col("p_size")), lambda n: F.concat(F.lit("t"), n)))
    raw = _table(spark, sf_dir, "part").select(
        F.concat("p_brand", F.lit("/"), "p_name").alias("id"), F.lit("x").alias("modelId"), F.col("p_type").alias("pipeline_tag"), tags.alias("tags"),
        F.col("p_partkey").alias("downloads"), F.lit(None).cast("bigint").alias("likes"), F.lit("2024-01-01T00:00:00Z").alias("lastModified"),
    )
    found = payloads.parse_models(raw, "model", (), F.col("downloads"))
    meta = F.col("metadata")
    kept = F.array_join(F.variant_get(meta["tags"], "$", "array<string>"), ";").alias("tags")
    return found.select("pos", "name", "url", *[text_of(meta, k).alias(k) for k in ("provider", "license", "likes", "pipeline_tag")], kept)


def q_parse_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    thumb = F.struct(F.struct(F.lit("t.png").alias("url")).alias("high"))
    raw = _table(spark, sf_dir, "supplier").select(
        F.struct(F.col("s_suppkey").cast("string").alias("videoId")).alias("id"),
        F.struct(F.col("s_name").alias("title"), F.lit(" about ").alias("description"), F.lit("ch").alias("channelTitle"), F.lit(None).cast("string").alias("publishedAt"), thumb.alias("thumbnails")).alias("snippet"),
    )
    found = payloads.parse_videos(raw)
    return found.select("id", "name", "description", "url", text_of(F.col("metadata"), "thumbnail").alias("thumbnail"))


def q_parse_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _table(spark, sf_dir, "orders").select(
        F.concat(F.lit(" Order "), "o_orderkey").alias("title"), F.lit("").alias("summary"), F.col("o_orderpriority").alias("description"),
        F.concat(F.lit("https://o.example.com/"), "o_orderkey").alias("link"), F.lit("now").alias("published"), F.col("o_orderstatus").alias("source_name"), F.lit("f").alias("feed_url"),
    )
    return payloads.parse_entries(raw).select("id", "name", "description", "url", F.col("source.name").alias("source_name"))


def q_feed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document is a feed of its lines: RSS, Atom, or an RSS document that is not well formed, by its id."""
    safe = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    kind = F.col("doc_id") % 3
    place = lambda line, i: F.concat(F.lit("https://d.example.com/"), F.col("doc_id").cast("string"), F.lit("/"), i.cast("string"))
    rss = lambda line, i: F.concat(F.lit("<item><title>A "), F.when(kind == 2, "&").otherwise("&amp;"), F.lit(" B "), i.cast("string"), F.lit("</title><link>"), place(line, i), F.lit("</link><description>"), safe(line), F.lit("</description></item>"))
    atom = lambda line, i: F.concat(F.lit("<entry><title>A &amp; B "), i.cast("string"), F.lit('</title><link rel="self" href="x"/><link href="'), place(line, i), F.lit('"/><summary>'), safe(line), F.lit("</summary></entry>"))
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    whole = (
        F.when(kind == 1, F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>f</title>'), F.array_join(F.transform(lines, atom), ""), F.lit("</feed>")))
        .otherwise(F.concat(F.lit('<?xml version="1.0"?><rss><channel><title>f</title>'), F.array_join(F.transform(lines, rss), ""), F.lit("</channel></rss>")))
    )
    entries = feed_entries(_table(spark, sf_dir, "documents").select("doc_id", whole.alias("xml")))
    parsed = payloads.parse_entries(entries.withColumn("source_name", F.col("doc_id").cast("string")).withColumn("feed_url", F.lit("f")), pos=F.col("_item"))
    return parsed.select(F.col("source.name").alias("doc_id"), F.col("pos").alias("line"), "name", clean_text(F.col("description")).alias("description"), "url")


# ---- oracle SQL


def _uuid(key: str) -> str:
    """DuckDB: UUIDv5 of a text expression."""
    h = f"sha1(unhex('{NAMESPACE.replace('-', '')}') || encode({key}))"
    variant = f"substr('89ab', (strpos('0123456789abcdef', substr({h}, 17, 1)) - 1) % 4 + 1, 1)"
    return (
        f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || {variant} || substr({h}, 18, 3) || '-' || substr({h}, 21, 12)"
    )


def _list(values) -> str:
    return "(" + ", ".join("'{}'".format(v.replace("'", "''")) for v in values) + ")"


#: `&amp` may lack its semicolon.
_UNESCAPED = (
    "regexp_replace(replace(replace(replace(replace(replace(html, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g')"
)


def _cleaned(text: str) -> str:
    return f"trim(regexp_replace(regexp_replace({text}, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))"


_NETLOC = "regexp_extract(url, '^https?://([^/?#]*)', 1)"
_HOST = f"replace(replace(regexp_replace(lower({_NETLOC}), '^www\\.', ''), ':443', ''), ':80', '')"
_PATH = "regexp_replace(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/+$', '')"
_QUERY = (
    "array_to_string(list_transform(list_filter(string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'), "
    f"lambda p: p <> '' AND lower(split_part(p, '=', 1)) NOT IN {_list(TRACKING)}), lambda p: CASE WHEN contains(p, '=') THEN p ELSE p || '=' END), '&')"
)
_NORMAL = f"'https://' || {_HOST} || {_PATH} || CASE WHEN {_QUERY} <> '' THEN '?' || {_QUERY} ELSE '' END"
_TITLE = "regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"
_TITLE_UNESCAPED = _UNESCAPED.replace("html", _TITLE)
_CANONICAL = (
    "array_to_string(list_filter(string_split(regexp_replace(' ' || trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g')), '( (" + "|".join(LEGAL_SUFFIXES) + "))+$', ''), ' '), "
    "lambda w: w NOT IN " + _list(FILLERS) + "), '')"
)
_DOMAIN = "split_part(regexp_replace(lower(regexp_extract({0}, '^[^:/?#]*://([^/?#]*)', 1)), '^www\\.', ''), ':', 1)"
_PAGES = (
    f"SELECT page_id AS pos, 'news' AS entity_type, {_cleaned(_TITLE_UNESCAPED)} AS name, {_cleaned(_UNESCAPED)} AS description, {_NORMAL} AS url, "
    f"{_uuid(f'''concat('news|', lower(trim({_TITLE})), '|', lower(trim(url)))''')} AS id, 'pages' AS source FROM pages"
)
_DOCS = (
    "SELECT doc_id AS pos, 'repository' AS entity_type, 'doc-' || doc_id AS name, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS description, "
    f"'https://docs.example.org/' || doc_id AS url, {_uuid('''concat('repository|doc-', doc_id, '|https://docs.example.org/', doc_id)''')} AS id, source FROM documents"
)
_PART_ID = _uuid("concat('tool|', lower(trim(p_name)), '|')")
_BRANDS = (
    "SELECT p_brand AS name, row_number() OVER (ORDER BY p_brand) AS n FROM (SELECT DISTINCT p_brand FROM part)"
)
_BRAND_ID = _uuid("concat('company|', lower(name), '|https://brand', n, '.example.com')")
_TASK_HIT = "CASE WHEN {} THEN '{}' END"


def _hits(tasks: dict[str, tuple[str, ...]], text: str) -> str:
    return ", ".join(_TASK_HIT.format(" OR ".join(f"contains({text}, '{w}')" for w in words), slug) for slug, words in tasks.items())


_PART_TEXT = "lower(concat_ws(' ', trim(p_name), trim(p_type), 'Parts', p_brand, ''))"
_PART_FOUND = f"list_filter([{_hits(PART_TASKS, _PART_TEXT)}], lambda t: t IS NOT NULL)"

_DOC_FOUND = f"list_filter([{_hits(TASKS, 'lower(concat_ws(chr(32), name, description, $$Repositories$$))')}], lambda t: t IS NOT NULL)"


def _task_rows(tasks: dict[str, tuple[str, ...]]) -> str:
    rows = ", ".join(f"({i}, '{slug}', '{' '.join(w.capitalize() for w in slug.split('-'))}')" for i, slug in enumerate(tasks))
    return f"(SELECT n, slug, name, {_uuid('''concat('task|', lower(name), '|')''')} AS id FROM (VALUES {rows}) t(n, slug, name))"


_DEVELOPS = (
    f"SELECT arg_min({_BRAND_ID}, n) AS \"from\", 'develops' AS relation, id AS \"to\" FROM (SELECT p_partkey, {_PART_ID} AS id, p_brand FROM part) p "
    f"JOIN ({_BRANDS}) b ON contains(lower(p.p_brand), lower(b.name)) OR contains(lower(b.name), lower(p.p_brand)) GROUP BY p_partkey, id"
)
_SOLVES = (
    f"SELECT p.id AS \"from\", 'solves' AS relation, t.id AS \"to\" FROM (SELECT {_PART_ID} AS id, unnest({_PART_FOUND}) AS slug FROM part) p JOIN {_task_rows(PART_TASKS)} t USING (slug)"
)
_DEVICE_ID = _uuid("concat('device|', lower(trim(p_name)), '|')")
_MODEL_ID = _uuid("concat('model|', lower(trim(p_name)), '|')")
_DEVELOPS_ALL = f"{_DEVELOPS} UNION ALL " + _DEVELOPS.replace(_PART_ID, _DEVICE_ID)
_RUNS = f"SELECT {_DEVICE_ID} AS \"from\", 'runs' AS relation, {_MODEL_ID} AS \"to\" FROM part"
_INTEGRATES = (
    f"SELECT s.id AS \"from\", 'integrates_with' AS relation, n.id AS \"to\" FROM (SELECT {_uuid("concat('mcp|', lower(trim(s_name)), '|')")} AS id, "
    "lower(trim(s_name) || ' works with ' || trim(p_name)) AS text FROM supplier JOIN part ON s_suppkey = p_partkey) s "
    f"JOIN (SELECT DISTINCT lower(trim(p_name)) AS name, {_PART_ID} AS id FROM part UNION SELECT DISTINCT lower(trim(p_name)), {_MODEL_ID} FROM part) n ON contains(s.text, n.name)"
)
_ISSUES = (
    "array_to_string(list_filter([CASE WHEN coalesce(name, '') = '' THEN 'missing name' END, CASE WHEN coalesce(name, '') = '' THEN 'missing name' END, "
    "CASE WHEN regexp_full_match(name, '(placeholder|todo|dummy|example|test)\\b.*', 'i') THEN 'placeholder name' END, CASE WHEN coalesce(source, '') = '' THEN 'missing source.name' END, "
    "CASE WHEN coalesce(url, '') = '' THEN 'missing url' END, CASE WHEN url <> '' AND NOT regexp_matches(url, '(?i)^https?://[^/?#]+') THEN 'invalid url' END, "
    "CASE WHEN " + " OR ".join(f"contains(lower(url), '{p}')" for p in validate.THIRD_PARTY) + " THEN 'third-party url' END, "
    "CASE WHEN coalesce(description, '') = '' THEN 'missing description' END, "
    "CASE WHEN description <> '' AND length(trim(description)) < 8 THEN 'description too short' END], lambda x: x IS NOT NULL), '; ')"
)
_CHECKED = f"SELECT *, {_ISSUES} AS issues FROM ({_PAGES} UNION ALL {_DOCS})"


def oracle_sql() -> dict[str, str]:
    """Name → DuckDB SQL."""
    by = "'{' || string_agg('\"' || k || '\":' || n, ',' ORDER BY k) || '}'"
    return {
        "q_clean_text": f"SELECT page_id, {_cleaned(_UNESCAPED)} AS cleaned FROM pages",
        "q_normalize_url": f"SELECT page_id, {_NORMAL} AS url FROM pages",
        "q_canonical_domain": f"SELECT page_id, {_DOMAIN.format('url')} AS domain FROM pages",
        "q_url_checks": "SELECT page_id, regexp_matches(url, '(?i)^https?://[^/?#]+') AS is_valid, h = 'example.com' OR h LIKE '%.example.com' OR 'example.com' LIKE '%.' || h AS is_same_site "
        "FROM (SELECT page_id, url, lower(regexp_extract(url, '^[^:/?#]*://([^/?#]*)', 1)) AS h FROM pages)",
        "q_canonical_name": "SELECT key, name, " + _CANONICAL.format("name") + " AS canonical FROM (SELECT p_partkey AS key, p_name || ' Labs, Inc.' AS name FROM part "
        "UNION ALL SELECT c_custkey, 'The ' || c_name || ' & Co' FROM customer)",
        "q_entity_id": f"SELECT p_partkey AS pos, {_PART_ID} AS id, trim(p_name) AS name FROM part",
        "q_dedupe_name": f"SELECT min(p_partkey) AS leader, count(*) AS n FROM (SELECT p_partkey, {_CANONICAL.format('p_name')} AS k FROM part) GROUP BY k",
        "q_dedupe_pages": f"""WITH RECURSIVE k AS (SELECT pos, row_number() OVER (ORDER BY pos) AS i, {_CANONICAL.format('name')} AS nk, {_DOMAIN.format('url')} AS dk FROM ({_PAGES})),
s AS (SELECT 0::BIGINT AS i, NULL::BIGINT AS pos, NULL::BIGINT AS leader, MAP {{}}::MAP(VARCHAR, BIGINT) AS names, MAP {{}}::MAP(VARCHAR, BIGINT) AS domains
UNION ALL SELECT k.i, k.pos, coalesce(s.names[k.nk], s.domains[k.dk], k.pos),
CASE WHEN coalesce(s.names[k.nk], s.domains[k.dk]) IS NULL THEN map_concat(s.names, MAP {{k.nk: k.pos}}) ELSE s.names END,
CASE WHEN coalesce(s.names[k.nk], s.domains[k.dk]) IS NULL AND k.dk <> '' THEN map_concat(s.domains, MAP {{k.dk: k.pos}}) ELSE s.domains END
FROM s JOIN k ON k.i = s.i + 1) SELECT pos, leader FROM s WHERE i > 0""",
        "q_merge": f"""SELECT min(p_partkey) AS pos, trim(arg_min(p_name, p_partkey)) AS name, arg_max(trim(p_type), [length(trim(p_type)), -p_partkey]) AS description,
CASE WHEN count(*) > 1 THEN array_to_string(list_sort(list_distinct(list_concat(['Parts'], list(p_brand)))), '; ') ELSE 'Parts; ' || min(p_brand) END AS categories,
arg_max(p_brand, p_partkey) AS maker, arg_max(p_size, p_partkey)::VARCHAR AS size FROM (SELECT *, {_CANONICAL.format('p_name')} AS k FROM part) GROUP BY k""",
        "q_recency": f"SELECT event_id, CASE WHEN floor((epoch_us(TIMESTAMP '{NOW}') - epoch_us(date_trunc('second', ts))) / 86400000000) <= 10 "
        "THEN array_to_string(list_sort(list_distinct(['Zeta', event_type, 'New'])), '; ') ELSE 'Zeta; ' || event_type END AS categories FROM events",
        "q_tag_tasks": f"SELECT p_partkey AS pos, '[' || array_to_string(list_transform({_PART_FOUND}, lambda t: '\"' || t || '\"'), ',') || ']' AS tasks FROM part",
        "q_task_dim": "SELECT id, name, 'Things you can do with AI related to ' || replace(slug, '-', ' ') || '.' AS description, slug, coalesce(k, 0) AS documents "
        f"FROM {_task_rows(TASKS)} t LEFT JOIN (SELECT slug, count(*) AS k FROM (SELECT unnest({_DOC_FOUND}) AS slug FROM ({_DOCS})) GROUP BY slug) d USING (slug)",
        "q_develops": _DEVELOPS_ALL,
        "q_solves": _SOLVES,
        "q_integrates": f"SELECT d.id AS \"from\", 'integrates_with' AS relation, {_uuid('''concat('model|', lower(trim(b.text)), '|')''')} AS \"to\" "
        f"FROM ({_DOCS.replace('repository|', 'mcp|')}) d JOIN benchmark b ON contains(lower(d.name || ' ' || d.description), lower(trim(b.text)))",
        "q_runs": _RUNS,
        "q_relationships": f"SELECT DISTINCT * FROM ({_DEVELOPS_ALL} UNION ALL {_SOLVES} UNION ALL {_RUNS} UNION ALL {_INTEGRATES})",
        "q_validate": f"SELECT entity_type, pos, id, url, issues FROM ({_CHECKED})",
        "q_validation_report": f"SELECT count(*) FILTER (issues = '') AS valid, count(*) FILTER (issues <> '') AS invalid FROM ({_CHECKED})",
        "q_validate_rules": "SELECT c_custkey AS pos, ['missing id', 'missing entity_type; invalid entity_type', 'invalid entity_type', 'missing categories', 'missing source; missing source.name', "
        "'invalid source.url', ''][c_custkey % 7 + 1] AS issues FROM customer",
        "q_first_issues": f"SELECT pos, name, 'invalid url' || CASE WHEN coalesce(description, '') = '' THEN '; missing description' WHEN length(description) < 8 THEN '; description too short' ELSE '' END AS issues "
        f"FROM ({_DOCS}) ORDER BY pos LIMIT 10",
        "q_quality_report": f"""WITH p AS (SELECT *, {_CANONICAL.format('p_name')} AS k FROM part),
a AS (SELECT k, arg_max(p_brand, p_partkey) AS maker, max(length(trim(p_type))) >= {validate.MIN_DESCRIPTION} AS valid FROM p GROUP BY k), m AS (SELECT * FROM a WHERE valid), v AS (SELECT 'company' AS t, 'brands' AS s FROM (SELECT DISTINCT p_brand FROM part)
UNION ALL SELECT 'tool', 'part' FROM m UNION ALL SELECT 'task', 'Manual/Taxonomy' FROM range({len(PART_TASKS)})),
n AS (SELECT (SELECT count(*) FROM part) + (SELECT count(*) FROM supplier) + (SELECT count(DISTINCT p_brand) FROM part) AS found, (SELECT count(*) FROM a) + (SELECT count(*) FROM supplier) + (SELECT count(DISTINCT p_brand) FROM part) AS kept)
SELECT found AS total_records_discovered, found AS total_records_extracted, kept AS records_cleaned, found - kept AS records_deduplicated, (SELECT count(*) FROM v) AS final_record_count,
0::BIGINT AS records_with_missing_descriptions, {len(PART_TASKS)}::BIGINT AS records_with_missing_official_urls, (SELECT count(*) FROM v) AS records_with_missing_logos, 0::BIGINT AS invalid_urls,
found - kept AS duplicate_count, 0::BIGINT AS duplicate_relationships, (SELECT count(*) FROM supplier) + (SELECT count(*) FROM a WHERE NOT valid) AS validation_failures, 0::BIGINT AS validation_warnings,
(SELECT {by} FROM (SELECT t AS k, count(*) AS n FROM v GROUP BY 1)) AS by_type, (SELECT {by} FROM (SELECT s AS k, count(*) AS n FROM v GROUP BY 1)) AS by_source,
(SELECT count(*) FROM m WHERE EXISTS (SELECT 1 FROM part b WHERE contains(lower(m.maker), lower(b.p_brand)) OR contains(lower(b.p_brand), lower(m.maker)))) AS edges,
'2024-01-31T00:00:00.000000+00:00' AS timestamp FROM n""",
        "q_llm_eligible": f"SELECT pos, description FROM ({_DOCS}) WHERE length(description) BETWEEN 1 AND 79",
        "q_topk_per_group": "SELECT p_brand, p_partkey FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) <= 3",
        "q_union_modules": f"SELECT entity_type, count(*) AS n, count(DISTINCT id) AS ids, min(name) AS first_name FROM (SELECT entity_type, id, name FROM ({_PAGES}) UNION ALL "
        f"SELECT 'tool', {_PART_ID}, trim(p_name) FROM part UNION ALL SELECT entity_type, id, name FROM ({_DOCS})) GROUP BY 1",
        "q_feed_health": "SELECT f.name AS source_name, count(c_custkey) AS entries, CASE WHEN count(c_custkey) > 0 THEN 'OK' ELSE 'EMPTY/FAILED' END AS status "
        "FROM (SELECT n_name AS name, n_nationkey AS key FROM nation UNION ALL SELECT r_name, -1 FROM region) f LEFT JOIN customer ON c_nationkey = f.key GROUP BY 1",
        "q_find_logo": "SELECT page_id AS pos, url, coalesce([root || x FOR x IN regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1) IF length(root || x) % 3 = 0][1], '') AS logo_url "
        "FROM (SELECT page_id, html, root || '/p' || page_id AS url, root FROM (SELECT page_id, html, 'https://' || regexp_extract(url, '^[^:/?#]*://([^/?#]*)', 1) AS root FROM pages))",
        "q_skip_logos": "SELECT p_partkey AS pos, '' AS logo_url FROM part",
        "q_describe": "SELECT t AS entity_type, pos, CASE WHEN length(d) BETWEEN 1 AND 79 AND NOT starts_with(d, 'PROMO') THEN 'written for ' || t ELSE d END AS description FROM "
        f"(SELECT 'tool' AS t, p_partkey AS pos, trim(p_type) AS d FROM part UNION ALL SELECT entity_type, pos + 1099511627776, coalesce(description, '') FROM ({_DOCS}))",
        "q_logo_candidates": "SELECT page_id, regexp_extract(url, '^([^:/?#]*://[^/?#]*)', 1) || '/i' || page_id || '.png ' || regexp_extract(url, '^([^:/?#]*):', 1) || "
        "'://cdn.example.org/o.png https://t.example.org/t.png' AS candidates FROM pages",
        "q_csv_flatten": f"SELECT {_PART_ID} AS id, 'tool' AS entity_type, trim(p_name) AS name, trim(p_type) AS description, '' AS url, '' AS logo_url, 'Parts; ' || p_brand AS categories, "
        "'part' AS source_name, '' AS source_url, '{\"maker\":\"part\",\"note\":\"say \\\"' || trim(p_name) || '\\\"\",\"size\":' || p_partkey || ',\"none\":null}' AS metadata_json FROM part",
        "q_parse_seeds": f"SELECT s_suppkey AS pos, {_uuid("concat('tool|', lower(trim(s_name)), '|https://s', s_suppkey, '.example.com')")} AS id, trim(s_name) AS name, "
        "CASE WHEN s_suppkey % 4 = 2 THEN '' ELSE 'about it' END AS description, 'https://s' || s_suppkey || '.example.com' AS url, 'Tools' AS categories, "
        "'Manual/Research|https://s' || s_suppkey || '.example.com' AS source, s_nationkey::VARCHAR AS nation FROM supplier WHERE s_suppkey % 4 > 1",
        "q_parse_repositories": f"SELECT p_partkey AS pos, {_uuid('''concat('repository|', lower(trim(p_brand || '/' || p_name)), '|', u)''')} AS id, trim(p_brand || '/' || p_name) AS name, u AS url, "
        "'Repositories; Extra' AS categories, 'https://code.example.com/' || p_partkey AS source_url, p_partkey::VARCHAR AS stars, p_brand AS owner, 'MIT' AS license, true AS has_language "
        "FROM (SELECT *, CASE WHEN p_size > 25 THEN 'https://home.example.com/' ELSE 'https://code.example.com/' END || p_partkey AS u FROM part)",
        "q_parse_models": "SELECT p_partkey AS pos, p_brand || '/' || p_name AS name, 'https://huggingface.co/' || p_brand || '/' || p_name AS url, p_brand AS provider, "
        "CASE WHEN p_size > 25 THEN 'l' || p_size ELSE 'late' END AS license, '0' AS likes, p_type AS pipeline_tag, array_to_string((CASE WHEN p_size > 25 THEN [p_type, 'license:l' || p_size, 'license:late'] "
        f"ELSE [p_type, 'license:late'] END || ['t' || n FOR n IN range(1, p_size + 1)])[1:{payloads.MAX_TAGS}], ';') AS tags FROM part",
        "q_parse_videos": f"SELECT {_uuid('''concat('video|', lower(trim(s_name)), '|https://www.youtube.com/watch?v=', s_suppkey)''')} AS id, trim(s_name) AS name, 'about' AS description, "
        "'https://www.youtube.com/watch?v=' || s_suppkey AS url, 't.png' AS thumbnail FROM supplier",
        "q_parse_entries": f"SELECT {_uuid('''concat('news|order ', o_orderkey, '|https://o.example.com/', o_orderkey)''')} AS id, 'Order ' || o_orderkey AS name, trim(o_orderpriority) AS description, "
        "'https://o.example.com/' || o_orderkey AS url, o_orderstatus AS source_name FROM orders",
        "q_feed_entries": f"SELECT doc_id::VARCHAR AS doc_id, i - 1 AS line, 'A & B ' || (i - 1) AS name, {_cleaned('t')} AS description, 'https://d.example.com/' || doc_id || '/' || (i - 1) AS url "
        "FROM (SELECT doc_id, unnest(l) AS t, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))",
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name → (spark, sf_dir) → DataFrame."""
    return {name: f for name, f in globals().items() if name.startswith("q_") and callable(f)}
