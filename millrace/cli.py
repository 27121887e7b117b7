"""Commands: run, crawl, clean, status and ingest. Exit codes: 0 done, 1 failed, 130 interrupted."""

from __future__ import annotations

import argparse
import logging
import sys
import time
from datetime import datetime
from pathlib import Path

from pyspark.sql import SparkSession

from . import schemas
from .fixed import SiteProfile
from .lock import run_lock
from .operators.relevance import MODES
from .plans import ingest, report
from .plans.clean import clean_corpus, write_clean
from .sources.fetch import HttpFetcher
from .sources.tables import read_checkpoint, read_csv, read_sitemap_index, read_sitemap_shards, write_csv

log = logging.getLogger("millrace")


class Paths:
    """Everything lies below one folder; raw and clean tables side by side."""

    def __init__(self, root: str):
        self.root = Path(root).resolve()
        self.checkpoint, self.raw, self.clean = f"{root}/raw/threads.jsonl", f"{root}/raw/corpus", f"{root}/clean/corpus"
        self.report, self.lock = f"{root}/clean/report.txt", f"{root}/run.lock"

    def tables(self) -> dict[str, str]:
        return {"raw posts": f"{self.raw}_posts", "raw replies": f"{self.raw}_replies", "clean posts": f"{self.clean}_posts", "clean replies": f"{self.clean}_replies", "links": f"{self.clean}_links"}


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="millrace", description=__doc__)
    p.add_argument("command", choices=("run", "crawl", "clean", "status", "ingest"), nargs="?", default="run")
    p.add_argument("--root", default="data", help="folder of all tables")
    p.add_argument("--site", help="JSON file with the site profile")
    p.add_argument("--group", help="group to crawl, instead of the profile's")
    p.add_argument("--target", type=int, help="stop at this many threads, those of earlier runs included; 0 is no limit")
    p.add_argument("--relevance", choices=MODES, default="terms")
    p.add_argument("--force-clean", action="store_true", help="clean even if nothing is new")
    p.add_argument("--no-resume", action="store_true", help="ingest: don't skip threads of the checkpoint")
    p.add_argument("--json", action="store_true", help="write the threads as one more JSON table")
    p.add_argument("--quiet", action="store_true", help="log to the file only")
    return p


def start_logging(root: str, quiet: bool) -> None:
    Path(root, "logs").mkdir(parents=True, exist_ok=True)
    handlers: list[logging.Handler] = [logging.FileHandler(Path(root, "logs", f"pipeline_{datetime.now():%Y%m%d}.log"), encoding="utf-8")]
    if not quiet:
        handlers.append(logging.StreamHandler(sys.stdout))
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s", handlers=handlers, force=True)


def step_crawl(spark: SparkSession, args: argparse.Namespace, site: SiteProfile, paths: Paths, fetcher=None) -> int:
    """Crawl what is new; the number of threads added."""
    fetcher = fetcher or HttpFetcher()
    began = time.time()
    folder = paths.root / "raw" / "sitemaps"
    folder.mkdir(parents=True, exist_ok=True)
    status, index = fetcher(site.sitemap_index)
    if index is None:
        raise RuntimeError(f"the sitemap index could not be read (status {status})")
    (folder / "index.xml").write_text(index, encoding="utf-8")
    shards = []
    for r in read_sitemap_index(spark, str(folder / "index.xml"), args.group or site.group).orderBy("shard_no").collect():
        _, xml = fetcher(r.loc)
        if xml is None:
            log.warning("shard %s could not be read", r.loc)
            continue
        shards.append(folder / f"shard_{r.shard_no:06d}.xml")
        shards[-1].write_text(xml, encoding="utf-8")
    if not shards:
        log.warning("no shard for this group")
        return 0
    entries = read_sitemap_shards(spark, [str(s) for s in shards])
    done, failed = ingest.crawl(spark, entries, paths.checkpoint, fetcher, site, args.relevance, args.target, resume=not args.no_resume)
    log.info("crawled: %s, %.1f min", ", ".join(f"{n} {k}" for k, n in done.items()), (time.time() - began) / 60)
    for url in failed:
        log.warning("failed: %s", url)
    threads = read_checkpoint(spark, paths.checkpoint) if Path(paths.checkpoint).exists() else None
    if threads is not None:
        for df, name in zip(ingest.flatten(threads), ("posts", "replies")):
            write_csv(df, f"{paths.raw}_{name}")
        if args.json:
            threads.write.mode("overwrite").json(f"{paths.raw}_threads_json")
    return done["kept"]


def step_clean(spark: SparkSession, site: SiteProfile, paths: Paths) -> str:
    posts = read_csv(spark, f"{paths.raw}_posts", schemas.POST_FIELDS)
    replies = read_csv(spark, f"{paths.raw}_replies", schemas.REPLY_FIELDS)
    corpus = clean_corpus(posts, replies, site.salt)
    write_clean(corpus, paths.clean)
    text = report.render_report(corpus)
    Path(paths.report).write_text(text, encoding="utf-8")
    return text


def main(argv: list[str] | None = None, spark: SparkSession | None = None, fetcher=None) -> int:
    args = build_parser().parse_args(argv)
    site = SiteProfile.load(args.site) if args.site else SiteProfile()
    paths = Paths(args.root)
    spark = spark or SparkSession.builder.appName("millrace").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.command == "status":
        print(report.status(spark, paths.checkpoint, paths.tables()))
        if Path(paths.lock).exists():
            print("A run may be going on: its lock is there.")
        return 0
    start_logging(args.root, args.quiet)
    try:
        if args.command == "ingest":
            step_crawl(spark, args, site, paths, fetcher)
            return 0
        with run_lock(paths.lock):
            added = step_crawl(spark, args, site, paths, fetcher) if args.command in ("run", "crawl") else 0
            if args.command == "clean" or args.command == "run" and (added or args.force_clean):
                log.info("\n%s", step_clean(spark, site, paths))
        return 0
    except KeyboardInterrupt:
        log.warning("interrupted; the checkpoint holds what was kept")
        return 130
    except Exception:
        log.exception("failed")
        return 1


if __name__ == "__main__":
    sys.exit(main())
