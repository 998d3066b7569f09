"""Command line: `python -m entityforge.plans.cli --module companies,tools`."""

from __future__ import annotations

import argparse

from entityforge.operators.describe import client_from_env
from entityforge.plans.pipeline import PipelineConfig, run
from entityforge.session import build_session
from entityforge.sources.connectors import PRESETS, check_feeds, chosen_modules, load_env
from entityforge.sources.http import Opener, Poster, open_url, post_url


def parser() -> argparse.ArgumentParser:
    """The options."""
    p = argparse.ArgumentParser(description="Builds the entity catalog; each run overwrites the last.")
    p.add_argument("--module", required=True, help="all, or some of: " + ", ".join(PRESETS))
    p.add_argument("--limit", type=int, default=30, help="most records of a query or feed")
    p.add_argument("--skip-logos", action="store_true")
    p.add_argument("--skip-descriptions", action="store_true")
    p.add_argument("--check-feeds", action="store_true", help="only say which feeds answer")
    p.add_argument("--seed-dir", default="seeds")
    p.add_argument("--out-dir", default="out")
    p.add_argument("--json-lines", action="store_true", help="folders of JSON lines, for large catalogs, instead of JSON arrays")
    p.add_argument("--ledger", help="folder of written descriptions that is kept from run to run")
    p.add_argument("--calls-per-minute", type=float, help="most requests for descriptions a minute")
    return p


def main(argv: list[str] | None = None, opener: Opener = open_url, post: Poster = post_url) -> int:
    """Runs what the options say. Descriptions are written where the environment has the service's key."""
    load_env()
    p = parser()
    args = p.parse_args(argv)
    spark = build_session()
    if args.check_feeds:
        check_feeds(spark).show(truncate=False)
        return 0
    try:
        modules = chosen_modules(args.module)
    except ValueError as error:
        p.error(str(error))
    config = PipelineConfig(
        modules, args.limit, args.seed_dir, args.out_dir, opener, logo_client=None if args.skip_logos else page_client,
        describe_client=None if args.skip_descriptions else client_from_env(post), json_arrays=not args.json_lines,
        describe_ledger=args.ledger, describe_per_minute=args.calls_per_minute,
    )
    result = run(spark, config)
    for step, n in result.counts.items():
        print(f"{step}: {n}")
    result.report.show(vertical=True, truncate=False)
    result.issues.limit(10).show(truncate=False)
    return 0


def page_client():
    """A fetcher of pages and images."""
    from entityforge.sources.http import open_url

    def fetch(url: str):
        try:
            answer = open_url(url, {"User-Agent": "Mozilla/5.0 (compatible; entityforge)"}, 8)
        except OSError:
            return None
        return answer.status, answer.headers, answer.body.decode("utf-8", "replace")

    return fetch


if __name__ == "__main__":
    raise SystemExit(main())
