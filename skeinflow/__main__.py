"""Commands: collect, feeds, links, report, curve.  Each prints what it found and ends with its exit code."""

from __future__ import annotations

import argparse
import sys
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.terms import CURVE_DATA, NO_FILE
from .operators import coverage, links, rendering, rules, series
from .plans.collect import collect
from .sources.documents import read_documents
from .sources.feeds import articles_of, feed_table, read_feeds, status_of
from .sources.series import curve, read_series


def _say(lines: DataFrame) -> None:
    for row in lines.toLocalIterator():
        print(row["text"])


def _feeds(spark: SparkSession, path: str, *keys: str) -> list[dict]:
    return [r.asDict() for k in keys for r in feed_table(spark, path, k).collect()]  # a dimension of some dozen rows


def run_collect(spark: SparkSession, args: argparse.Namespace) -> int:
    read = read_feeds(spark, _feeds(spark, args.sources, "feeds")).persist()
    run = collect(articles_of(read), status_of(read), F.lit(datetime.now(timezone.utc)).cast("timestamp"), per_category=args.per_category)
    rendering.write_lines(run.document, f"{args.out}/candidates.json", "part", "event_id", "place")
    rendering.write_lines(run.markdown, f"{args.out}/candidates.md", "ord")
    return 0


def run_feeds(spark: SparkSession, args: argparse.Namespace) -> int:
    keys = ("feeds", "candidate_feeds") if args.all else ("candidate_feeds",) if args.candidates else ("feeds",)
    listed = _feeds(spark, args.sources, *keys)
    read = read_feeds(spark, listed, retries=1).persist()
    blocked = spark.createDataFrame([(f["name"], f.get("blocked_reason")) for f in listed], "name string, blocked_reason string")
    health = coverage.feed_health(status_of(read).join(blocked, "name"), articles_of(read))
    _say(health.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("text")) if args.json else coverage.health_lines(health))
    return coverage.exit_code(health, any_failure=args.json)


def run_links(spark: SparkSession, args: argparse.Namespace) -> int:
    docs = read_documents(spark, [args.report])
    if docs.first()["state"] != "ok":
        print(NO_FILE + args.report, file=sys.stderr)
        return 2
    found = links.extract_links(docs, "report_id", "text")
    verdicts = links.link_verdicts(links.probe_links(found.select("ord", "url"), args.workers)).persist()
    _say(verdicts.orderBy("ord").select(F.to_json(F.struct("url", "status", "verdict", "detail"), {"ignoreNullFields": "false"}).alias("text")) if args.json else links.link_lines(verdicts).orderBy("part", "ord"))
    return links.exit_code(verdicts)


def run_report(spark: SparkSession, args: argparse.Namespace) -> int:
    docs = read_documents(spark, args.reports)
    bad = docs.filter("state <> 'ok'")
    for row in bad.select("path").toLocalIterator():
        print(NO_FILE + row["path"], file=sys.stderr)
    good = docs.filter("state = 'ok'")
    _say(rules.gate_lines(good, strict=args.strict).orderBy("report_id", "line"))
    return rules.exit_code(docs, rules.gate(good, strict=args.strict))


def run_curve(spark: SparkSession, args: argparse.Namespace) -> int:
    read = read_series(spark, args.address, [args.month or datetime.now(timezone.utc).strftime("%Y%m")]).persist()
    found, why = curve(read)
    _say((series.curve_json(found, why).withColumnRenamed("json", "text")) if args.json else series.curve_markdown(found, why))
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="skeinflow")
    sub = parser.add_subparsers(required=True)
    p = sub.add_parser("collect")
    p.add_argument("sources")
    p.add_argument("out")
    p.add_argument("--per-category", type=int, default=35)
    p.set_defaults(run=run_collect)
    p = sub.add_parser("feeds")
    p.add_argument("sources")
    p.add_argument("--json", action="store_true")
    p.add_argument("--candidates", action="store_true")
    p.add_argument("--all", action="store_true")
    p.set_defaults(run=run_feeds)
    p = sub.add_parser("links")
    p.add_argument("report")
    p.add_argument("--json", action="store_true")
    p.add_argument("--workers", type=int, default=10)
    p.set_defaults(run=run_links)
    p = sub.add_parser("report")
    p.add_argument("reports", nargs="+")
    p.add_argument("--strict", action="store_true")
    p.set_defaults(run=run_report)
    p = sub.add_parser("curve")
    p.add_argument("--address", default=CURVE_DATA)
    p.add_argument("--month")
    p.add_argument("--json", action="store_true")
    p.set_defaults(run=run_curve)
    args = parser.parse_args(argv)
    return args.run(SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate(), args)


if __name__ == "__main__":
    sys.exit(main())
