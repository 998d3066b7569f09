"""The jobs: against DuckDB, over growing input, run again, and from the command line."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import duckdb
import pytest

from entityforge.session import SEMANTICS
from jobs import archive_feeds as feeds
from jobs import build_catalog as snapshot
from jobs import registry

TABLES = "pages documents part".split()
HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_job_matches_duckdb(spark, sf_dir, name):
    df = registry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = con.execute(registry.oracle_sql()[name])
    order = [[d[0] for d in got.description].index(c) for c in columns]
    assert sorted(tuple(map(str, r)) for r in df.select(columns).collect()) == sorted(tuple(str(r[i]) for i in order) for r in got.fetchall())


def entries(spark, folder, *rows):
    """Adds one file of (doc_id, text, source)."""
    spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], f"{feeds.ENTRY}, n_chars int").coalesce(1).write.mode("append").parquet(folder)


def archived(spark, out):
    return sorted((r["batch"], r["doc_id"], r["status"], r["source"], r["description"]) for r in feeds.read_archive(spark, out).collect())


def test_archive_takes_only_what_is_new(spark, tmp_path):
    docs, out, mark = (str(tmp_path / n) for n in ("docs", "out", "mark"))
    entries(spark, docs, (3, "A first long entry", "f1"), (1, "a  FIRST long entry", "f2"), (2, "short", "f1"))
    first = feeds.archive_feeds(spark, docs, out, mark)
    assert first == {"batches": 1, "read": 3, "written": 2, "rejected": 1}
    one = archived(spark, out)
    assert one == [(0, 1, "archived", "f2", "a FIRST long entry"), (0, 2, "rejected", "f1", "short")]
    assert feeds.archive_feeds(spark, docs, out, mark)["batches"] == 0 and archived(spark, out) == one
    entries(spark, docs, (0, "A first long entry", "f9"), (9, "Another entry, quite new", "f1"), (8, "SHORT", "f3"))
    second = feeds.archive_feeds(spark, docs, out, mark)
    # the smaller id comes too late: what an earlier batch archived stays
    assert second == {"batches": 1, "read": 3, "written": 1, "rejected": 0}
    assert archived(spark, out) == [*one, (1, 9, "archived", "f1", "Another entry, quite new")]
    entries(spark, docs, (10, "Another entry, quite NEW", "f1"))
    assert feeds.archive_feeds(spark, docs, out, mark) == {"batches": 1, "read": 1, "written": 0, "rejected": 0}
    assert len(archived(spark, out)) == 3


def test_archive_of_a_file_per_batch_is_that_of_one_batch(spark, sf_dir, tmp_path):
    """Split by id, the order of files is that of ids, so the same entries are kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    out, mark, folder = (str(tmp_path / n) for n in ("out", "mark", "docs"))
    last = docs.selectExpr("max(doc_id)").first()[0]
    for k in range(3):
        docs.filter(f"doc_id * 3 div {last + 1} = {k}").coalesce(1).write.mode("append").parquet(folder)
        assert feeds.archive_feeds(spark, folder, out, mark)["batches"] == 1
    whole = registry.job2_archive_feeds(spark, sf_dir).drop("batch")
    parts = feeds.read_archive(spark, out)
    assert parts.select("batch").distinct().count() == 3
    assert sorted(map(str, parts.drop("batch").collect())) == sorted(map(str, whole.collect()))


def test_batch_run_again_writes_the_same(spark, tmp_path):
    """As after a run that ended between a batch's writing and its mark, even where a later batch exists by then."""
    out, config = str(tmp_path / "out"), feeds.load_config("archive_feeds")
    batches = [spark.createDataFrame([(k, f"entry number {k // 2} of some length", "en", f"f{k % 2}") for k in range(5 * n, 5 * n + 8)], feeds.ENTRY) for n in range(3)]
    for n, batch in enumerate(batches):
        feeds.archive_batch(batch, n, out, config)
    before = archived(spark, out)
    for n in (1, 0, 2, 1):
        feeds.archive_batch(batches[n], n, out, config)
        assert archived(spark, out) == before


def test_archive_of_odd_rows(spark, tmp_path):
    docs, out, mark = (str(tmp_path / n) for n in ("docs", "out", "mark"))
    entries(spark, docs, (None, "An entry without an id", None), (1, None, ""), (1, "", "x/y"), (2, " \n\t", "f"), (5, "w " * 200_000, "f"), (5, "w " * 200_000, "f"), (7, "&lt;b&gt;bold&lt;/b&gt; and &eacute;", "ünï=code"))
    assert feeds.archive_feeds(spark, docs, out, mark)["written"] == 4
    got = {(r["doc_id"], r["source"], r["status"], len(r["description"]), r["name"][:12]) for r in feeds.read_archive(spark, out).collect()}
    assert got == {(None, "unknown", "archived", 22, "An entry wit"), (1, "unknown", "rejected", 0, ""), (5, "f", "archived", 399_999, "w w w w w w "), (7, "ünï=code", "archived", 10, "bold and é")}


def test_snapshot_run_again(spark, sf_dir, tmp_path):
    """A second run gives the same; one over less leaves nothing of the first. Settings are as before."""
    out = str(tmp_path / "catalog")
    paths = [f"{sf_dir}/{t}.parquet" for t in TABLES]
    before = {k: spark.conf.get(k, None) for k in SEMANTICS}
    counts = snapshot.build_catalog(spark, *paths, out)
    rows = sorted(map(str, snapshot.read_catalog(spark, out).collect()))
    assert counts["written"] == len(rows) and counts["documents"] == spark.read.parquet(paths[1]).count()
    assert snapshot.build_catalog(spark, *paths, out) == counts and sorted(map(str, snapshot.read_catalog(spark, out).collect())) == rows
    assert {k: spark.conf.get(k, None) for k in SEMANTICS} == before
    none = str(tmp_path / "none")
    spark.read.parquet(paths[0]).limit(0).write.parquet(none)
    fewer = snapshot.build_catalog(spark, none, paths[1], paths[2], out)
    assert fewer["pages"] == 0 and fewer["written"] == snapshot.read_catalog(spark, out).filter("entity_type <> 'news'").count() == snapshot.read_catalog(spark, out).count()


def test_parts_of_one_file_are_made_by_many_tasks(spark, sf_dir, tmp_path, monkeypatch):
    seen, made = [], snapshot.part_rows
    monkeypatch.setattr(snapshot, "part_rows", lambda parts, config: seen.append(parts.rdd.getNumPartitions()) or made(parts, config))
    paths = [f"{sf_dir}/{t}.parquet" for t in TABLES]
    snapshot.build_catalog(spark, *paths, str(tmp_path / "catalog"))
    assert spark.read.parquet(paths[2]).rdd.getNumPartitions() == 1 and seen == [4]


def test_command_line(spark, tmp_path):
    docs, out, mark, config = (str(tmp_path / n) for n in ("docs", "out", "mark", "config.json"))
    entries(spark, docs, (1, "An entry about chat", "f1"))
    with open(config, "w", encoding="utf-8") as f:
        json.dump({"feed_host": "news.example.com", "tasks": {"talk": ["chat"]}}, f)
    done = subprocess.run(
        [sys.executable, "-m", "jobs.archive_feeds", "--documents", docs, "--out", out, "--checkpoint", mark, "--config", config],
        cwd=HERE, capture_output=True, text=True, timeout=240, env=os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] pyspark-shell"},
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert f"batch 0: read 1 entries from {docs}, wrote 1, of which 0 are rejected, to {out}" in done.stderr
    row = feeds.read_archive(spark, out).first()
    assert (row["url"], row["tasks"]) == ("https://news.example.com/f1/1", "talk")
