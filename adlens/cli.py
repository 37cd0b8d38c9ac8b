"""Command line: python -m adlens.cli SUBCOMMAND."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from adlens.plans import export
from adlens.sources.config import Settings
from adlens.sources.seeds import lattice
from adlens.sources.sinks import report
from adlens.streaming.crawl import Crawl, CrawlRules


def numbers(text: str) -> tuple[float, ...]:
    return tuple(float(x) for x in text.split(","))


def parser() -> argparse.ArgumentParser:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--config", default=argparse.SUPPRESS, help="settings file")
    common.add_argument("--log-level", default=argparse.SUPPRESS)
    p = argparse.ArgumentParser(prog="adlens", parents=[common])
    sub = p.add_subparsers(dest="command", required=True)
    a = sub.add_parser("stats", parents=[common], help="advertisements by category")
    a.add_argument("banners")
    a = sub.add_parser("export", parents=[common], help="workbook of advertisements")
    a.add_argument("banners")
    a.add_argument("out")
    a.add_argument("--all", action="store_true", dest="every")
    a.add_argument("--category")
    a.add_argument("--realty", action="store_true")
    a.add_argument("--sure-only", action="store_true")
    a = sub.add_parser("grid", parents=[common], help="seed points of a box")
    a.add_argument("bbox", type=numbers, help="west,south,east,north")
    a.add_argument("out")
    a.add_argument("--step", type=float, default=150.0)
    a = sub.add_parser("crawl", parents=[common], help="walk landed panoramas; continues where it stopped")
    a.add_argument("panoramas")
    a.add_argument("state")
    a.add_argument("start", type=numbers, help="lon,lat")
    a.add_argument("--bbox", type=numbers)
    a.add_argument("--max", type=int)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> str:
    args = parser().parse_args(argv)
    logging.basicConfig(level=getattr(args, "log_level", "INFO"))
    settings = Settings.load(args.config) if getattr(args, "config", None) else Settings()
    spark = spark or SparkSession.builder.appName("adlens").getOrCreate()
    spark.sparkContext.setJobDescription(f"adlens {args.command}")
    if args.command == "stats":
        out = report(export.category_counts(spark.read.parquet(args.banners)))
    elif args.command == "export":
        rows = spark.read.parquet(args.banners)
        if not args.realty:
            rows = export.by_category(rows, args.every, args.category, settings.get("filter.only_category"))
        out = f"{export.export_workbook(rows, args.out, args.realty, not args.sure_only)} rows"
    elif args.command == "grid":
        points = lattice(spark, args.bbox, args.step)
        points.write.mode("overwrite").parquet(args.out)
        out = f"{points.count()} points"
    else:
        rules = CrawlRules(args.bbox, settings.get("crawl.min_distance_m", 75.0), settings.get("crawl.max_failures", 30), args.max)
        crawl = Crawl(spark, args.state, rules)
        done = crawl.run(spark.read.parquet(args.panoramas), *args.start)
        logging.getLogger("adlens").info("crawl state:\n%s", report(crawl.counts()))
        out = f"{done.count()} panoramas, {crawl.last().reason}"
    print(out)
    return out


if __name__ == "__main__":
    main()
