"""The jobs as registered queries, and their oracle SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from entityforge.plans import catalog as sql
from entityforge.schema import TASKS
from entityforge.session import shared_dir
from jobs import archive_feeds as feeds
from jobs import build_catalog as snapshot


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def job1_build_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot of all pages, documents and parts, after a run and a rerun."""
    out = f"{_folder(spark, 'job1')}/catalog"
    for _ in range(2):
        snapshot.build_catalog(spark, *[f"{sf_dir}/{t}.parquet" for t in ("pages", "documents", "part")], out)
    return snapshot.read_catalog(spark, out)


def job2_archive_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive of all documents, after a run and another one that finds nothing new."""
    folder = _folder(spark, "job2")
    for _ in range(2):
        feeds.archive_feeds(spark, f"{sf_dir}/documents.parquet", f"{folder}/archive", f"{folder}/checkpoint")
    return feeds.read_archive(spark, f"{folder}/archive")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name → (spark, sf_dir) → DataFrame."""
    return {"job1_build_catalog": job1_build_catalog, "job2_archive_feeds": job2_archive_feeds}


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31)"
_TEXT = sql._UNESCAPED.replace("html", "coalesce(text, '')")
_LINE = f"regexp_extract(ltrim(coalesce(text, ''), {_BLANKS}), '^([^\\n]*)', 1)"
_LINE_NAME = sql._cleaned(sql._UNESCAPED.replace("html", _LINE))
_FOUND = f"array_to_string(list_filter([{sql._hits(TASKS, '''lower(concat_ws(' ', name, description, replace(categories, '; ', ' ')))''')}], lambda t: t IS NOT NULL), '; ')"
_STATUS = "CASE WHEN issues = '' THEN '{}' ELSE 'rejected' END AS status"

_PAGE_LEADERS = sql.oracle_sql()["q_dedupe_pages"]
_JOB1 = f"""WITH n AS (SELECT 'news' AS entity_type, arg_min(id, p.pos) AS id, arg_min(name, p.pos) AS name, arg_max(description, [length(description), -p.pos]) AS description, arg_min(url, p.pos) AS url,
'News' AS categories, 'pages' AS source FROM ({sql._PAGES}) p JOIN ({_PAGE_LEADERS}) l ON l.pos = p.pos GROUP BY leader),
d AS (SELECT doc_id AS pos, {_LINE_NAME} AS name, {sql._cleaned(_TEXT)} AS description, 'https://docs.example.org/' || doc_id AS url, source,
{sql._uuid(f'''concat('repository|', lower(trim({_LINE}, {_BLANKS})), '|https://docs.example.org/', doc_id)''')} AS id FROM documents),
r AS (SELECT 'repository' AS entity_type, arg_min(id, pos) AS id, arg_min(name, pos) AS name, arg_max(description, [length(description), -pos]) AS description, arg_min(url, pos) AS url,
CASE WHEN count(*) > 1 THEN array_to_string(list_sort(list_distinct(list_concat(['Repositories'], list(source)))), '; ') ELSE 'Repositories; ' || min(source) END AS categories,
arg_min(source, pos) AS source FROM (SELECT *, {sql._CANONICAL.format('name')} AS k FROM d) GROUP BY k),
t AS (SELECT 'tool' AS entity_type, arg_min({sql._uuid("concat('tool|', lower(trim(p_name)), '|https://parts.example.org/', p_partkey)")}, p_partkey) AS id, trim(arg_min(p_name, p_partkey)) AS name,
arg_max(trim(p_type), [length(trim(p_type)), -p_partkey]) AS description, 'https://parts.example.org/' || min(p_partkey) AS url,
CASE WHEN count(*) > 1 THEN array_to_string(list_sort(list_distinct(list_concat(['Parts'], list(p_brand)))), '; ') ELSE 'Parts; ' || min(p_brand) END AS categories, 'part' AS source
FROM (SELECT *, {sql._CANONICAL.format('p_name')} AS k FROM part) GROUP BY k),
e AS (SELECT *, {sql._ISSUES} AS issues, {_FOUND} AS tasks FROM (SELECT * FROM n UNION ALL SELECT * FROM r UNION ALL SELECT * FROM t))
SELECT id, name, description, url, categories, source, tasks, issues, {_STATUS.format('valid')}, entity_type FROM e"""

_JOB2 = f"""WITH d AS (SELECT doc_id, coalesce(nullif(source, ''), 'unknown') AS source, lang, {_LINE_NAME} AS name, {sql._cleaned(_TEXT)} AS description, 'News' AS categories,
'https://feeds.example.org/' || coalesce(nullif(source, ''), 'unknown') || '/' || doc_id AS url,
{sql._uuid(f'''concat('news|', lower(trim({_LINE}, {_BLANKS})), '|http://www.feeds.example.org/', lower(coalesce(nullif(source, ''), 'unknown')), '/', doc_id, '?utm_source=rss#entry')''')} AS id FROM documents),
e AS (SELECT *, sha256(lower(description)) AS digest, {sql._ISSUES} AS issues, {_FOUND} AS tasks FROM d)
SELECT doc_id, id, name, description, url, lang, tasks, issues, digest, 0::BIGINT AS batch, {_STATUS.format('archived')}, source FROM e
QUALIFY row_number() OVER (PARTITION BY digest ORDER BY doc_id) = 1"""


def oracle_sql() -> dict[str, str]:
    """Name → DuckDB SQL, for inputs that come in one batch."""
    return {"job1_build_catalog": _JOB1, "job2_archive_feeds": _JOB2}
