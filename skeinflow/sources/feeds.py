"""Reading many feeds at once: one input partition per feed, errors kept as rows."""

from __future__ import annotations

import gzip
import json
import urllib.request
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.dates import parse_date
from .feed_xml import items

FEED = "category string, tier int, name string, url string, note string"
CANDIDATE = FEED + ", blocked_reason string, detail string"
READ = "feed_ord long, category string, tier int, name string, url string, ok boolean, error string, item long, title string, link string, summary string, published_raw string"


def fetch(url: str, timeout: int = 25, retries: int = 2) -> bytes:
    """The body at an address, unpacked; the last error is raised after all tries."""
    request = urllib.request.Request(url, headers={"User-Agent": "skeinflow/1.0", "Accept": "application/rss+xml, application/atom+xml, application/xml, text/xml, */*", "Accept-Encoding": "gzip, deflate"})
    for left in range(retries, -1, -1):
        try:
            with urllib.request.urlopen(request, timeout=timeout) as got:
                return unpacked(got.read(), (got.headers.get("Content-Encoding") or "").lower())
        except OSError:
            if not left:
                raise
    raise AssertionError


def unpacked(body: bytes, encoding: str) -> bytes:
    """gzip, and deflate with or without its header."""
    if encoding == "gzip":
        return gzip.decompress(body)
    if encoding == "deflate":
        try:
            return zlib.decompress(body)
        except zlib.error:
            return zlib.decompress(body, -zlib.MAX_WBITS)
    return body


class _Feed(InputPartition):
    def __init__(self, ord: int, feed: dict):
        super().__init__(ord)
        self.ord, self.feed = ord, feed


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.feeds = json.loads(options["feeds"])
        self.timeout, self.retries = int(options.get("timeout", 25)), int(options.get("retries", 2))

    def partitions(self) -> list[_Feed]:
        return [_Feed(k, f) for k, f in enumerate(self.feeds)]

    def read(self, partition: _Feed) -> Iterator[tuple]:
        f = partition.feed
        head = (partition.ord, f.get("category"), f.get("tier"), f.get("name"), f.get("url"))
        try:
            rows = list(items(fetch(f["url"], self.timeout, self.retries)))
        except Exception as e:  # noqa: BLE001  one feed never fails the others
            yield (*head, False, f"{type(e).__name__}: {e}"[:200], None, None, None, None, None)
            return
        if not rows:
            yield (*head, True, None, None, None, None, None, None)
        for row in rows:
            yield (*head, True, None, *row)


class FeedSource(DataSource):
    """``spark.read.format("feeds").option("feeds", json).load()``."""

    @classmethod
    def name(cls) -> str:
        return "feeds"

    def schema(self) -> str:
        return READ

    def reader(self, schema: T.StructType) -> _Reader:
        return _Reader(self.options)


def feeds_of(documents: DataFrame, key: str = "feeds") -> DataFrame:
    """Feeds (``key`` feeds) or blocked candidates (``key`` candidate_feeds) of JSON documents in the column ``value``."""
    listed = {"feeds": FEED, "candidate_feeds": CANDIDATE}
    schema = ", ".join(f"{k} array<struct<{v.replace(' ', ':').replace(',:', ',')}>>" for k, v in listed.items())
    return documents.select(F.from_json("value", schema).alias("d")).select(F.inline(f"d.{key}"))


def feed_table(spark: SparkSession, path: str, key: str = "feeds") -> DataFrame:
    """Feeds or blocked candidates of a JSON document in a file."""
    return feeds_of(spark.read.text(path, wholetext=True), key)


def read_feeds(spark: SparkSession, feeds: list[dict], **options: object) -> DataFrame:
    """All feeds with their entries; a failed or empty feed is one row without an item."""
    spark.dataSource.register(FeedSource)
    reader = spark.read.format("feeds").option("feeds", json.dumps(feeds))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def articles_of(read: DataFrame) -> DataFrame:
    """Articles of read feeds, numbered by feed and place."""
    rows = read.filter("item is not null")
    return rows.select((F.col("feed_ord") * 1_000_000 + F.col("item")).alias("seq"), "title", "link", "summary", parse_date(F.col("published_raw")).alias("published"), F.col("name").alias("source_name"), F.col("tier").alias("source_tier"), "category", F.col("url").alias("feed_url"))


def status_of(read: DataFrame) -> DataFrame:
    """One row per feed: ok, fetched, error."""
    return read.groupBy("feed_ord", "category", "name", "url", "tier").agg(F.bool_and("ok").alias("ok"), F.count("item").alias("fetched"), F.max("error").alias("error"))
