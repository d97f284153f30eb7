"""Summaries of a run: feed health, coverage by category, the one-row digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import close_label, seoul
from ..functions.terms import LABEL_DAY, NO_ITEMS


def feed_status(feeds: DataFrame, articles: DataFrame) -> DataFrame:
    """Per feed: whether it could be read and how many rows it gave.  An empty feed counts as read.

    ``feeds`` may have an ``error`` column; a feed with one is not ok.
    """
    error = F.col("error") if "error" in feeds.columns else F.lit(None).cast("string")
    got = articles.groupBy(F.col("source_name").alias("name")).agg(F.count(F.lit(1)).alias("fetched"))
    base = feeds.select("category", "name", "url", "tier", error.alias("error"))
    return base.join(got, "name", "left").select("category", "name", "url", "tier", F.col("error").isNull().alias("ok"), F.coalesce("fetched", F.lit(0)).cast("long").alias("fetched"), F.substring("error", 1, 200).alias("error"))


def feed_health(feeds: DataFrame, articles: DataFrame) -> DataFrame:
    """Per feed: count, latest time and verdict.  Here an empty feed fails."""
    error = F.col("error") if "error" in feeds.columns else F.lit(None).cast("string")
    blocked = F.col("blocked_reason") if "blocked_reason" in feeds.columns else F.lit(None).cast("string")
    got = articles.groupBy(F.col("source_name").alias("name")).agg(F.count(F.lit(1)).alias("n"), F.max("published").alias("latest"))
    base = feeds.select("category", "name", "url", "tier", error.alias("error"), blocked.alias("blocked_reason"))
    n = F.when(F.col("error").isNull(), F.coalesce("n", F.lit(0))).otherwise(0).cast("long")
    return base.join(got, "name", "left").select(
        "category", "name", "url", "tier", F.col("blocked_reason").isNotNull().alias("candidate"), "blocked_reason",
        (F.col("error").isNull() & (n > 0)).alias("ok"), n.alias("articles"), F.when(F.col("error").isNull(), F.col("latest")).alias("latest"),
        F.coalesce(F.col("error"), F.when(n == 0, NO_ITEMS)).alias("error"),
    )


def health_summary(health: DataFrame) -> DataFrame:
    """Counts by (candidate, ok); an active feed that failed fails the run, a candidate that is ok recovered."""
    return health.groupBy("candidate", "ok").agg(F.count(F.lit(1)).alias("feeds"))


def exit_code(health: DataFrame, *, any_failure: bool = False) -> int:
    """1 if an active feed failed (with ``any_failure``: if any feed did), else 0."""
    bad = health.filter(~F.col("ok")) if any_failure else health.filter(~F.col("ok") & ~F.col("candidate"))
    return int(not bad.isEmpty())


def health_lines(health: DataFrame) -> DataFrame:
    """(part, category, name, text): feeds that are ok, then those that fail, each by category and name; the counts last."""
    good, back = F.col("ok"), F.col("ok") & F.col("candidate")
    where = F.concat(F.lit(" ["), "category", F.lit("] "), "name")
    fine = F.concat(F.lit("  "), F.when(F.col("candidate"), "복구!").otherwise("OK   "), where, F.lit("  ("), F.col("articles").cast("string"), F.lit("건, 최신 "), F.coalesce(seoul(F.col("latest")), F.lit("None")), F.lit(")"))
    why = F.when(F.col("blocked_reason").isNotNull(), F.concat(F.lit(" ("), "blocked_reason", F.lit(")"))).otherwise("")
    bad = F.concat(F.lit("  FAIL"), where, why, F.lit("  "), "url", F.lit("\n         → "), "error")
    own = health.select(F.when(good, 0).otherwise(1).alias("part"), "category", "name", F.when(good, fine).otherwise(bad).alias("text"))
    n = health.agg(F.count(F.lit(1)).alias("all"), F.count_if(good).alias("good"), F.array_sort(F.collect_list(F.when(back, F.struct("category", "name")))).alias("back"))
    listed = F.array_join(F.transform("back", lambda r: F.concat(F.lit("  - ["), r["category"], F.lit("] "), r["name"])), "\n")
    total = F.concat(F.lit("\n정상 "), F.col("good").cast("string"), F.lit("/"), F.col("all").cast("string"), F.lit(" · 실패 "), (F.col("all") - F.col("good")).cast("string"))
    recovered = F.when(F.size("back") > 0, F.concat(F.lit("\n\n후보 피드 "), F.size("back").cast("string"), F.lit("개가 이 네트워크에서는 살아납니다. sources.json의 candidate_feeds에서 feeds로 옮기세요:\n"), listed)).otherwise("")
    nothing = F.lit(None).cast("string")
    return own.unionByName(n.select(F.lit(2).alias("part"), nothing.alias("category"), nothing.alias("name"), F.concat(total, recovered).alias("text"))).orderBy("part", "category", "name")


def failed_feeds(status: DataFrame) -> DataFrame:
    """Names of the failed feeds of each category that has any."""
    return status.filter(~F.col("ok")).groupBy("category").agg(F.array_join(F.array_sort(F.collect_list("name")), ", ").alias("failed"))


def coverage(categories: DataFrame, status: DataFrame, articles: DataFrame, events: DataFrame) -> DataFrame:
    """One row per category (``categories``: ord, category), also for those without any row.

    Articles count by their own category, events by their lead's.
    """
    feeds = status.groupBy("category").agg(
        F.count(F.lit(1)).alias("feeds_total"), F.count_if("ok").alias("feeds_ok"), F.count_if(~F.col("ok")).alias("feeds_failed"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("ok"), F.col("name")))), ", ").alias("failed_feeds"),
    )
    own = articles.groupBy("category").agg(F.count(F.lit(1)).alias("articles_in_window"))
    led = events.groupBy(F.col("lead.category").alias("category")).agg(F.count(F.lit(1)).alias("candidate_events"), F.count_if("has_primary").alias("with_primary_source"))
    joined = categories.join(F.broadcast(feeds), "category", "left").join(F.broadcast(own), "category", "left").join(F.broadcast(led), "category", "left")  # one row a category each
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("feeds_total", "feeds_ok", "feeds_failed", "articles_in_window", "candidate_events", "with_primary_source")]
    return joined.select("ord", "category", *zero, F.coalesce("failed_feeds", F.lit("")).alias("failed_feeds"), (F.coalesce("feeds_ok", F.lit(0)) > 0).alias("searched"))


def window_label(start: Column, now: Column) -> Column:
    """Words for a window: a day, or since the market close that it begins at."""
    return F.when(start < now - F.expr("INTERVAL 24 HOURS"), close_label(start)).otherwise(LABEL_DAY)


def run_meta(status: DataFrame, fetched: DataFrame, in_window: DataFrame, events: DataFrame, start: Column, now: Column) -> DataFrame:
    """The one-row digest of a run."""
    feeds = status.agg(F.count(F.lit(1)).alias("feeds_total"), F.count_if("ok").alias("feeds_ok"))
    rows = fetched.agg(F.count(F.lit(1)).alias("articles_fetched"))
    window = in_window.agg(F.count(F.lit(1)).alias("articles_in_window"), F.count_if(F.col("published").isNull()).alias("articles_undated"), F.max("published").alias("latest"))
    clusters = events.agg(F.count(F.lit(1)).alias("clusters"))
    one = feeds.crossJoin(rows).crossJoin(window).crossJoin(clusters)  # four single rows
    label = window_label(start, now)
    return one.select(
        seoul(start).alias("window_start_kst"), seoul(now).alias("window_end_kst"), label.alias("window_label"), "feeds_total", "feeds_ok", "articles_fetched",
        "articles_in_window", "articles_undated", "clusters", seoul(F.col("latest")).alias("latest_article_kst"),
    )
