"""Candidate events: lead, outlets, subject areas, the order of reading."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import terms
from ..plans.storage import remove, written

FAR = "9999-12-31 00:00:00"
#: Which article leads: the best tier, then the earliest (undated last), then arrival.
LEAD_FIELDS = ("title", "link", "summary", "published", "source_name", "source_tier", "category", "feed_url", "seq")


def haystack(title: Column, summary: Column) -> Column:
    return F.lower(F.concat(F.lit(" "), F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(summary, F.lit("")), F.lit(" ")))


def has_term(hay: Column, term: str) -> Column:
    """Containment; a term between spaces is a whole word."""
    if term.startswith(" ") and term.endswith(" "):
        word = term.strip()
        return hay.contains(word) & hay.rlike(rf"(?U)\b{word}\b")  # the expression is dear, and only sees texts that hold the word
    return hay.contains(term)


def _over(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)``, with ``value`` made once a row however often ``f`` names it."""
    return F.transform(F.array(value), f)[0]


def topic_hits(title: Column, summary: Column, topics: dict[str, tuple[str, ...]] | None = None) -> Column:
    """Names of the subject areas of which any term occurs, in order."""

    def hits(hay: Column) -> Column:
        found = [F.when(reduce(or_, [has_term(hay, w) for w in words]), F.lit(name)) for name, words in (topics or terms.TOPICS).items()]
        return F.array_compact(F.array(*found))

    return _over(haystack(title, summary), hits)


def is_noise(title: Column, summary: Column, noise: tuple[str, ...] | None = None) -> Column:
    return _over(haystack(title, summary), lambda hay: reduce(or_, [hay.contains(t) for t in noise or terms.NOISE]))


def tier_points(tier: Column) -> Column:
    points = F.create_map(*[F.lit(x) for kv in terms.TIER_POINTS.items() for x in kv])
    return F.coalesce(F.try_element_at(points, tier), F.lit(terms.OTHER_TIER))


def recency(published: Column, now: Column) -> Column:
    """Falls from two to zero within a day; a future time counts as now; undated costs points."""
    hours = (F.unix_micros(now) - F.unix_micros(published)) / F.lit(3_600_000_000.0)
    return F.when(published.isNull(), terms.UNDATED).otherwise(F.greatest(F.lit(0.0), F.lit(terms.RECENT_POINTS) - F.greatest(hours, F.lit(0.0)) / terms.RECENT_HOURS))


def prescore(tier: Column, outlets: Column, topics: Column, noise: Column, published: Column, now: Column) -> Column:
    """Unrounded points of the order of reading."""
    spread = F.least(outlets - 1, F.lit(terms.OUTLET_CAP)) * terms.OUTLET_POINTS
    subject = F.when(F.size(topics) > 0, F.least(F.size(topics), F.lit(terms.TOPIC_CAP)) * terms.TOPIC_POINTS).otherwise(terms.NO_TOPIC)
    return tier_points(tier) + spread + subject + recency(published, now) + F.when(noise, terms.NOISE_POINTS).otherwise(0.0)


def lead_order() -> Column:
    return F.struct("source_tier", F.coalesce("published", F.lit(FAR).cast("timestamp")), "gid", "seq")


def leads(articles: DataFrame) -> DataFrame:
    """The leading article of each component."""
    return articles.groupBy("component").agg(F.min_by(F.struct(*LEAD_FIELDS), lead_order()).alias("lead"))


def outlets(articles: DataFrame) -> DataFrame:
    """Distinct outlets of each component in order of arrival (by address group, then arrival)."""
    first = articles.groupBy("component", "source_name").agg(F.min(F.struct("gid", "seq")).alias("at"))
    listed = first.groupBy("component").agg(F.array_sort(F.collect_list(F.struct("at", "source_name"))).alias("s"))
    return listed.select("component", F.col("s.source_name").alias("sources"))


def members(articles: DataFrame) -> DataFrame:
    """Lead, outlets, primary flag and count of each component, by outlet first and then over its few outlets."""
    by_outlet = articles.groupBy("component", "source_name").agg(
        F.min(F.struct("gid", "seq")).alias("at"), F.min_by(F.struct(*LEAD_FIELDS), lead_order()).alias("lead"), F.min(lead_order()).alias("place"),
        F.bool_or(F.col("source_tier") == 1).alias("has_primary"), F.count(F.lit(1)).alias("n"),
    )
    found = by_outlet.groupBy("component").agg(
        F.min_by("lead", "place").alias("lead"), F.array_sort(F.collect_list(F.struct("at", "source_name"))).alias("s"),
        F.bool_or("has_primary").alias("has_primary"), F.sum("n").alias("n_articles"),
    )
    return found.select("component", "lead", F.col("s.source_name").alias("sources"), "has_primary", "n_articles")


def events(articles: DataFrame, now: Column, *, topics: dict[str, tuple[str, ...]] | None = None, noise: tuple[str, ...] | None = None) -> DataFrame:
    """One row per component: lead, sources, primary flag, topics, rounded score."""
    found = members(articles).withColumn("topics", topic_hits(F.col("lead.title"), F.col("lead.summary"), topics)).withColumn("noise", is_noise(F.col("lead.title"), F.col("lead.summary"), noise))
    score = prescore(F.col("lead.source_tier"), F.size("sources"), F.col("topics"), F.col("noise"), F.col("lead.published"), now)
    return found.withColumn("score", F.round(score, 2))


def numbered(found: DataFrame) -> DataFrame:
    """Event ids from 1 by falling score, ties by component.

    Events are dealt by ranges of the order and written; ranks within a range are added to the counts of the
    ranges before, so no task sorts all events.
    """
    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged, path = written(found.repartitionByRange(n, F.desc("score"), "component").withColumn("_range", F.spark_partition_id()), "events")
    within = F.row_number().over(Window.partitionBy("_range").orderBy(F.desc("score"), "component"))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))  # one row a range
    named = ranged.withColumn("_within", within).join(F.broadcast(before), "_range").withColumn("event_id", (F.col("_within") + F.col("_before")).cast("long"))
    result, _ = written(named.drop("_range", "_within", "_before"), "numbered")
    remove(found.sparkSession, path)
    return result


def top_per_category(found: DataFrame, n: int = 35) -> DataFrame:
    w = Window.partitionBy(F.col("lead.category")).orderBy("event_id")
    return found.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= n)


def omitted(found: DataFrame, n: int = 35) -> DataFrame:
    return found.groupBy(F.col("lead.category").alias("category")).agg(F.greatest(F.count(F.lit(1)) - n, F.lit(0)).alias("omitted"))
