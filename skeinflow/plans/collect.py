"""A whole collection run over read feeds: window, deduplication, ranking, summaries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import window_start, within
from ..functions.terms import CATEGORIES
from ..operators import coverage, dedupe, ranking, rendering


@dataclass
class Run:
    events: DataFrame
    coverage: DataFrame
    meta: DataFrame
    markdown: DataFrame
    document: DataFrame


def collect(articles: DataFrame, status: DataFrame, now: Column, *, since: Column | None = None, per_category: int = 35) -> Run:
    """Events, coverage, meta row, the Markdown digest and the JSON document of one run; ``since`` overrides the window's start."""
    spark = articles.sparkSession
    start = since if since is not None else window_start(now)
    rows = articles.filter((F.col("title") != "") & (F.col("link") != "")).filter(within(F.col("published"), start, now))
    clustered = dedupe.clustered(rows)
    events = ranking.numbered(ranking.events(clustered, now))
    categories = spark.createDataFrame(list(enumerate(CATEGORIES)), "ord long, category string")
    covered = coverage.coverage(categories, status, rows, events)
    meta = coverage.run_meta(status, articles, rows, events, start, now)
    digest = rendering.markdown_document(meta, rendering.markdown(categories, covered, events, per_category))
    return Run(events, covered, meta, digest, rendering.run_document(meta, covered, events, clustered))
