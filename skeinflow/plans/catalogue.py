"""Queries over the test tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text, urls
from ..operators import coverage as cov
from ..operators import dedupe, links, ranking, rendering, rules
from ..operators import series as ser
from ..sources.feed_xml import ParseFeed, ParseSeries
from ..sources.feeds import feeds_of
from . import articles as bind
from .articles import table
from .storage import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__.removesuffix("_q")] = f
    return f


# scalars


@query
def clean_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.clean_text(F.col("html")).alias("text"))


@query
def collapse_ws(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.sha2(text.collapse_ws(F.col("text")), 256).alias("sha"))


@query
def truncate_ellipsis(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.truncate(F.col("text"), 300).alias("cut"))


@query
def html_unescape_basic(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.sha2(text.html_unescape_basic(F.col("html")), 256).alias("sha"))


@query
def normalize_title(spark, sf):
    return bind.articles(spark, sf).select("seq", text.normalize_title(F.col("title")).alias("norm"))


@query
def title_tokens(spark, sf):
    return bind.articles(spark, sf).select("seq", F.array_join(F.array_sort(text.title_tokens(F.col("title"))), " ").alias("tokens"))


@query
def url_host(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.host(F.col("url")).alias("host"))


@query
def url_params(spark, sf):
    shown = F.transform(urls.params(F.col("link")), lambda p: F.concat(p["name"], F.lit("="), p["value"]))
    return bind.articles(spark, sf).select("seq", F.array_join(shown, "&").alias("params"))


@query
def canonical_url(spark, sf):
    return bind.articles(spark, sf).select("seq", urls.canonical(F.col("link")).alias("url"))


@query
def kst_format(spark, sf):
    return table(spark, sf, "events").select("event_id", dates.seoul(F.col("ts").cast("timestamp")).alias("kst"))


@query
def parse_date_multi(spark, sf):
    ts = F.col("ts").cast("timestamp")

    thursday = F.year(F.date_add(F.to_date(ts), 3 - F.weekday(ts))).cast("string")  # the year of an ISO week

    def shown(hours: int, pattern: str, tail: str):
        return F.concat(F.date_format(ts + F.expr(f"INTERVAL {hours} HOURS"), pattern), F.lit(tail))

    spelled = [
        shown(9, "EEE, dd MMM yyyy HH:mm:ss", " +0900"), shown(0, "yyyy-MM-dd'T'HH:mm:ss", "Z"), shown(0, "yyyy-MM-dd HH:mm:ss", ""), shown(0, "yyyy/MM/dd HH:mm:ss", ""),
        shown(0, "yyyy.MM.dd HH:mm", ""), shown(0, "yyyy-MM-dd", ""), shown(0, "EEE, dd MMM yyyy HH:mm:ss", " GMT"), F.lit("not a date"),
        shown(-5, "EEE, dd MMM yyyy HH:mm:ss", " EST"), shown(9, "yyyy-MM-dd'T'HH:mm:ss", "+0900"), shown(0, "d MMM yy HH:mm:ss", " GMT"), shown(0, "EEE, dd MMM yy HH:mm:ss", " -0000"),
        shown(0, "d MMMM yyyy HH:mm:ss", " UT"), shown(-7, "EEEE, dd-MMM-yy HH:mm:ss", " PDT"), shown(0, "EEE, dd MMM yyyy HH:mm:ss", " +09:00"), shown(0, "yyyyMMdd'T'HHmmss", "Z"),
        shown(0, "yyyy-MM-dd'T'HH", ""), shown(0, "EEE, dd MMM yyyy HH:mm:ss", " GMT+0900"), shown(0, "EEE MMM d HH:mm:ss yyyy", ""), shown(9, "yyyy-MM-dd'T'HH:mm:ss", "+09"),
        shown(9, "EEE, dd MMM yyyy HH:mm:ss", " +0900 (KST)"), F.concat(thursday, F.lit("-W"), F.lpad(F.weekofyear(ts).cast("string"), 2, "0"), F.lit("-"), (F.weekday(ts) + 1).cast("string")),
    ]
    raw = F.element_at(F.array(*spelled), (F.col("event_id") % len(spelled) + 1).cast("int"))
    return table(spark, sf, "events").select("event_id", F.coalesce(F.unix_seconds(dates.parse_date(raw)), F.lit(-1)).alias("epoch"))


@query
def tier_points(spark, sf):
    return bind.articles(spark, sf).select("seq", ranking.tier_points(F.col("source_tier")).alias("points"))


@query
def recency_score(spark, sf):
    return bind.articles(spark, sf).select("seq", F.round(ranking.recency(F.col("published"), bind.now()), 4).alias("points"))


@query
def html_payload_flag(spark, sf):
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("id"), F.lit("page").alias("kind"), F.col("html").alias("payload"))
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.lit("document").alias("kind"), F.col("text").alias("payload"))
    return pages.unionByName(docs).select("id", "kind", text.looks_like_html(F.col("payload")).alias("is_html"))


@query
def parse_pages(spark, sf):
    html = F.col("html")
    title = text.clean_text(F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1), 300)
    heading = text.clean_text(F.regexp_extract(html, "(?is)<h1[^>]*>(.*?)</h1>", 1), 300)
    return table(spark, sf, "pages").select("page_id", title.alias("title"), heading.alias("heading"), F.regexp_count(html, F.lit("<p>")).cast("long").alias("paragraphs"))


def _escaped(c: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


@query
def feed_items(spark, sf):
    """Each article as a feed document of its own, its marked-up text escaped twice, and read back."""
    dated = F.when(F.col("published").isNotNull(), F.concat(F.lit("<pubDate>"), F.date_format("published", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT</pubDate>"))).otherwise("")
    payload = F.concat(
        F.lit("<?xml version='1.0'?><rss><channel><item><title>"), _escaped(_escaped(F.col("title"))), F.lit("</title><link>"), _escaped(F.col("link")),
        F.lit("</link><description>"), _escaped(_escaped(F.col("summary"))), F.lit("</description>"), dated, F.lit("</item></channel></rss>"),
    )
    read = bind.articles(spark, sf).select("seq", payload.cast("binary").alias("payload")).lateralJoin(ParseFeed(F.col("payload").outer()))
    return read.select("seq", "title", "link", "summary", F.coalesce(F.unix_seconds(dates.parse_date(F.col("published_raw"))), F.lit(-1)).alias("epoch"))


# filters and windows


@query
def valid_rows(spark, sf):
    return bind.valid(bind.articles(spark, sf)).select("seq")


@query
def window_filter(spark, sf):
    return bind.in_window(spark, sf).select("seq")


@query
def window_start(spark, sf):
    moments = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("now"))
    return moments.select("event_id", F.unix_micros(dates.window_start(F.col("now"))).alias("start_us"))


@query
def window_label(spark, sf):
    moments = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("now"))
    start = dates.window_start(F.col("now"))
    return moments.select("event_id", cov.window_label(start, F.col("now")).alias("label"))


@query
def undated_count(spark, sf):
    return bind.in_window(spark, sf).agg(F.count_if(F.col("published").isNull()).alias("undated"))


@query
def feeds_dim(spark, sf):
    listed = bind.feeds_document(spark, sf)
    both = feeds_of(listed).unionByName(feeds_of(listed, "candidate_feeds").select("category", "tier", "name", "url", "note"))
    return both.select("category", "tier", "name", "url")


@query
def articles_feeds_join(spark, sf):
    feeds = bind.feeds(spark, sf).select(F.col("name").alias("source_name"), F.col("tier").alias("feed_tier"), "blocked_reason")
    joined = bind.articles(spark, sf).select("seq", "source_name").join(feeds, "source_name")
    return joined.select("seq", "source_name", "feed_tier", F.coalesce("blocked_reason", F.lit("active")).alias("state"))


@query
def union_feeds(spark, sf):
    rows = bind.articles(spark, sf)
    fetched = rows.filter("source_tier <= 2").select("seq", "source_name").unionByName(rows.filter("source_tier > 2").select("seq", "source_name"))
    return fetched.groupBy("source_name").agg(F.count(F.lit(1)).alias("n"), F.sum("seq").alias("seqs"))


@query
def feed_partition(spark, sf):
    feeds = bind.feeds(spark, sf)
    active = feeds.filter("blocked_reason is null").select("name", "category")
    blocked = feeds.filter("blocked_reason is not null").select("name", "category", "blocked_reason")
    return active.unionByName(blocked, allowMissingColumns=True)


# deduplication


@query
def dedupe_by_url(spark, sf):
    keyed = bind.articles(spark, sf).withColumn("url", urls.canonical(F.col("link")))
    listed = keyed.groupBy("url").agg(F.array_sort(F.collect_list("seq")).alias("s"))
    return listed.select("url", F.array_join("s", ",").alias("seqs"), F.size("s").cast("long").alias("members"))


@query
def group_representative(spark, sf):
    return dedupe.url_groups(bind.in_window(spark, sf)).select("gid", "title", "members")


def _classes(spark, sf):
    groups, _ = written(dedupe.url_groups(bind.in_window(spark, sf)), "groups")
    return dedupe.title_classes(groups)


@query
def title_classes(spark, sf):
    return _classes(spark, sf).select("gid", "class_id", F.array_join("tokens", " ").alias("tokens"))


@query
def token_df(spark, sf):
    return dedupe.token_frequency(_classes(spark, sf))


@query
def token_overlap_join(spark, sf):
    return dedupe.shared_tokens(_classes(spark, sf)).select("a", "b", "overlap", "size_a", "size_b")


@query
def title_similar_pairs(spark, sf):
    return dedupe.similar_titles(_classes(spark, sf)).select("a", "b")


@query
def connected_components(spark, sf):
    return dedupe.event_components(_classes(spark, sf)).select("gid", "component")


def _window(spark, sf):
    """Articles of the window as a table, for plans that read them more than once."""
    return written(bind.in_window(spark, sf), "window")[0]


def _clustered(spark, sf):
    return dedupe.clustered(bind.in_window(spark, sf))


def _events(spark, sf):
    return ranking.numbered(ranking.events(_clustered(spark, sf), bind.now(), topics=bind.TEST_TOPICS, noise=bind.TEST_NOISE))


@query
def clusters(spark, sf):
    grouped = _clustered(spark, sf).groupBy("component").agg(F.array_sort(F.collect_list(F.struct("gid", "seq"))).alias("m"))
    return grouped.select("component", F.array_join(F.col("m.seq").cast("array<string>"), ",").alias("seqs"))


# ranking


@query
def cluster_lead(spark, sf):
    return ranking.leads(_clustered(spark, sf)).select("component", F.col("lead.seq").alias("lead_seq"), F.col("lead.source_tier").alias("tier"))


@query
def cluster_sources(spark, sf):
    return ranking.outlets(_clustered(spark, sf)).select("component", F.array_join("sources", ",").alias("sources"))


@query
def outlet_count(spark, sf):
    return _clustered(spark, sf).groupBy("component").agg(F.count_distinct("source_name").alias("outlets"))


@query
def primary_source_flag(spark, sf):
    return _clustered(spark, sf).groupBy("component").agg(F.bool_or(F.col("source_tier") == 1).alias("has_primary"))


@query
def lead_duplicates(spark, sf):
    rows = _clustered(spark, sf)
    both = ranking.leads(rows).join(ranking.outlets(rows), "component")
    return both.select("component", F.array_join(F.array_except("sources", F.array("lead.source_name")), ",").alias("others"))


@query
def topic_hits(spark, sf):
    hits = ranking.topic_hits(F.col("title"), F.col("summary"), bind.TEST_TOPICS)
    return bind.articles(spark, sf).select("seq", F.array_join(hits, ",").alias("topics"))


@query
def market_topic_hits(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.array_join(ranking.topic_hits(F.lit(""), F.col("text")), ",").alias("topics"))


@query
def noise_flag(spark, sf):
    return bind.articles(spark, sf).select("seq", ranking.is_noise(F.col("title"), F.col("summary"), bind.TEST_NOISE).alias("noise"))


@query
def prescore(spark, sf):
    return ranking.events(_clustered(spark, sf), bind.now(), topics=bind.TEST_TOPICS, noise=bind.TEST_NOISE).select("component", "score")


@query
def event_numbering(spark, sf):
    return _events(spark, sf).select("event_id", "component")


@query
def topk_per_category(spark, sf):
    return ranking.top_per_category(_events(spark, sf), 5).select(F.col("lead.category").alias("category"), "place", "event_id")


@query
def omitted_per_category(spark, sf):
    return ranking.omitted(_events(spark, sf), 5)


@query
def events_top(spark, sf):
    return _events(spark, sf).select("event_id", F.col("lead.category").alias("category"), "score", F.col("lead.title").alias("title"), F.col("lead.source_name").alias("source_name"), F.size("sources").cast("long").alias("outlets"))


# summaries


def _status(spark, sf):
    return cov.feed_status(bind.feeds(spark, sf), bind.articles(spark, sf))


@query
def coverage(spark, sf):
    rows = _window(spark, sf)
    found = ranking.events(dedupe.clustered(rows), bind.now(), topics=bind.TEST_TOPICS, noise=bind.TEST_NOISE)
    return cov.coverage(bind.categories(spark), _status(spark, sf), rows, found)


@query
def run_meta(spark, sf):
    rows = _window(spark, sf)
    components = dedupe.event_components(dedupe.title_classes(dedupe.url_groups(rows)))
    return cov.run_meta(_status(spark, sf), bind.articles(spark, sf), rows, components.select("component").distinct(), dates.window_start(bind.now()), bind.now())


@query
def events_by_category(spark, sf):
    return _events(spark, sf).groupBy(F.col("lead.category").alias("category")).agg(F.count(F.lit(1)).alias("events"), F.min("event_id").alias("first_event"))


@query
def feed_status(spark, sf):
    return _status(spark, sf)


@query
def failed_feeds(spark, sf):
    return cov.failed_feeds(_status(spark, sf))


@query
def feed_latest(spark, sf):
    return bind.articles(spark, sf).groupBy("source_name").agg(dates.seoul(F.max("published")).alias("latest"))


def _health(spark, sf):
    return cov.feed_health(bind.feeds(spark, sf), bind.articles(spark, sf))


@query
def feed_health(spark, sf):
    return _health(spark, sf).select("name", "candidate", "ok", "articles", dates.seoul(F.col("latest")).alias("latest"), "error")


@query
def feed_health_summary(spark, sf):
    return cov.health_summary(_health(spark, sf))


@query
def health_lines(spark, sf):
    return cov.health_lines(_health(spark, sf)).select("part", F.coalesce("category", F.lit("")).alias("category"), F.coalesce("name", F.lit("")).alias("name"), "text")


# series


@query
def series_fields(spark, sf):
    """Each day's values as a series document of its own, and read back."""
    field = F.concat(F.lit("<d:"), "name", F.lit(">"), "value", F.lit("</d:"), "name", F.lit(">"))
    days = bind.series(spark, sf).groupBy("as_of").agg(F.array_join(F.collect_list(field), "").alias("fields"))
    payload = F.concat(F.lit("<f><m:properties xmlns:m='m' xmlns:d='d'><d:NEW_DATE>"), F.date_format("as_of", "yyyy-MM-dd"), F.lit("T00:00:00</d:NEW_DATE>"), "fields", F.lit("</m:properties></f>"))
    read = days.select(payload.cast("binary").alias("payload")).lateralJoin(ParseSeries(F.col("payload").outer()))
    return read.select(F.date_format(dates.parse_date(F.col("as_of_raw")), "yyyy-MM-dd").alias("as_of"), "name", "value")


def _series(spark, sf):
    return ser.tenor_project(bind.series(spark, sf), bind.TEST_TENORS)


@query
def tenor_project(spark, sf):
    return _series(spark, sf).select(F.date_format("as_of", "yyyy-MM-dd").alias("as_of"), "tenor", "percent")


@query
def try_cast_filter(spark, sf):
    return bind.series(spark, sf).filter(F.expr("try_cast(value AS double) IS NULL")).select(F.date_format("as_of", "yyyy-MM-dd").alias("as_of"), "name")


def _curve(spark, sf):
    return ser.curve_delta(_series(spark, sf))


@query
def curve_delta(spark, sf):
    return _curve(spark, sf).select("tenor", "percent", "change_bp", F.date_format("as_of", "yyyy-MM-dd").alias("as_of"), F.date_format("compared_with", "yyyy-MM-dd").alias("compared_with"))


@query
def curve_document(spark, sf):
    body = "treasury_curve struct<available boolean, as_of string, compared_with string, yields map<string, struct<percent double, change_bp double>>>"
    read = ser.curve_json(_curve(spark, sf)).select(F.from_json("json", body).alias("d")).select("d.treasury_curve.*")
    return read.select("available", "as_of", "compared_with", F.explode("yields").alias("tenor", "y")).select("available", "as_of", "compared_with", "tenor", "y.percent", "y.change_bp")


@query
def curve_render(spark, sf):
    return ser.curve_lines(_curve(spark, sf))


# links and rules


def _linked(spark, sf):
    title = F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1)
    shown = F.concat(F.lit("see ["), F.replace(title, F.lit("]"), F.lit("")), F.lit("]("), "url", F.lit(") and [again]("), "url", F.lit(".,) or [home](https://home.example.com/"), (F.col("page_id") % 5).cast("string"), F.lit(";)"))
    return table(spark, sf, "pages").select("page_id", shown.alias("text"))


@query
def extract_links(spark, sf):
    return links.extract_links(_linked(spark, sf), "page_id", "text").select("page_id", F.col("ord").cast("long").alias("ord"), "url")


@query
def link_verdict(spark, sf):
    return links.link_verdicts(bind.attempts(spark, sf)).select("url", F.coalesce("status", F.lit(-1)).alias("status"), "verdict")


@query
def link_summary(spark, sf):
    return links.link_summary(links.link_verdicts(bind.attempts(spark, sf)))


@query
def link_lines(spark, sf):
    return links.link_lines(links.link_verdicts(bind.attempts(spark, sf))).select("part", "text")


@query
def event_refs(spark, sf):
    return rules.event_refs(bind.reports(spark, sf)).select("report_id", F.array_join("ids", ",").alias("ids"))


@query
def id_gaps(spark, sf):
    gaps = rules.id_gaps(bind.reports(spark, sf))
    return gaps.select("report_id", F.array_join("adopted", ",").alias("adopted"), F.array_join("missing", ",").alias("missing"), F.array_join("over", ",").alias("over"))


@query
def section_slice(spark, sf):
    return bind.reports(spark, sf).select("report_id", F.sha2(rules.section(F.col("text"), "## 6-6.", "## 6-7."), 256).alias("sha"))


@query
def section_order(spark, sf):
    return rules.section_order(bind.reports(spark, sf))


@query
def event_blocks(spark, sf):
    return rules.event_blocks(bind.reports(spark, sf)).select("report_id", F.col("pos").cast("long").alias("pos"), "event_id", "block")


@query
def missing_sections(spark, sf):
    return rules.missing_sections(bind.reports(spark, sf))


@query
def missing_categories(spark, sf):
    return rules.missing_categories(bind.reports(spark, sf))


@query
def missing_labels(spark, sf):
    docs = bind.reports(spark, sf)
    events = rules.missing_event_labels(docs).select("report_id", F.concat(F.lit("#"), F.col("event_id").cast("string"), F.lit(" "), "missing").alias("missing"))
    return rules.missing_audit_fields(docs).unionByName(rules.missing_header_labels(docs)).unionByName(events)


@query
def enum_domain(spark, sf):
    return rules.market_state(bind.reports(spark, sf))


@query
def forbidden_patterns(spark, sf):
    return rules.forbidden(bind.reports(spark, sf))


@query
def declared_vs_actual(spark, sf):
    return rules.declared_counts(bind.reports(spark, sf)).withColumn("declared", F.coalesce("declared", F.lit(-1)))


@query
def report_gate(spark, sf):
    return rules.gate(bind.reports(spark, sf))


@query
def gate_verdict(spark, sf):
    told = rules.gate_lines(bind.reports(spark, sf))
    return told.filter(F.col("text").startswith("\n")).select("report_id", F.trim(F.replace("text", F.lit("\n"), F.lit(""))).alias("text"))


# sinks


def _run(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Meta row, coverage, events and articles of the run over the test tables."""
    rows, status = _window(spark, sf), _status(spark, sf)
    clustered = dedupe.clustered(rows)
    events = ranking.numbered(ranking.events(clustered, bind.now(), topics=bind.TEST_TOPICS, noise=bind.TEST_NOISE))
    covered = cov.coverage(bind.categories(spark), status, rows, events)
    return cov.run_meta(status, bind.articles(spark, sf), rows, events, dates.window_start(bind.now()), bind.now()), covered, events, clustered


@query
def digest_markdown(spark, sf):
    meta, covered, events, _ = _run(spark, sf)
    return rendering.markdown_document(meta, rendering.markdown(bind.categories(spark), covered, events, 5))


@query
def document_lines(spark, sf):
    lines = rendering.run_document(*_run(spark, sf))
    return lines.groupBy("part", "event_id").agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("text").startswith(",")).alias("continued"))


@query
def render_lines(spark, sf):
    return rendering.event_lines(_events(spark, sf), 5).select("category", "place", "line")


@query
def events_json(spark, sf):
    return rendering.events_json(_events(spark, sf)).select("event_id", "json")


__all__ = ["QUERIES"]
