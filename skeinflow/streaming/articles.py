"""Streams of articles: late rows go, repeats of an address within the watermark go, undated rows pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import canonical


def deduplicated(articles: DataFrame, delay: str = "24 hours") -> DataFrame:
    """The first row of each canonical address within ``delay`` of event time; dated rows only."""
    dated = articles.filter("published is not null").withColumn("url", canonical(F.col("link")))
    return dated.withWatermark("published", delay).dropDuplicatesWithinWatermark(["url"])


def undated(articles: DataFrame) -> DataFrame:
    """Rows without a time, which no watermark can judge."""
    return articles.filter("published is null").withColumn("url", canonical(F.col("link")))
